"""Training data and the three-headed classifier, on Spark ML.

Sources are DataFrames of records (the output record's fields, or gold rows with the same names); synthetic rows are a DataFrame of their own,
given by the caller. Each source gives (text, category, motivator, cuisine, btype, source).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, OneHotEncoder, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import extract, text
from promolens.operators.job import FAILED
from promolens.sources.positions import kept

POSITIVE = ["claude", "ml_model", "ml_model_fallback"]
NEGATIVES, LEAST, PAGE, MOST, WORDS, SEED = 60, 10, 50, 2000, 15000, 42
COLUMNS = ["text", "category", "motivator", "cuisine", "btype", "source"]


def _labels() -> tuple[Column, Column]:
    return extract.broad_category(F.col("Incentive Category")), extract.motivator_class(F.col("Psychological Motivator Type"))


def _rows(d: DataFrame, t: Column, category: Column, motivator: Column, cuisine: str, source: str) -> DataFrame:
    kind = lambda c: extract.venue_type(F.col(f"`{c}`"), training=True)
    return d.select(t.alias("text"), category.alias("category"), motivator.alias("motivator"), kind(cuisine).alias("cuisine"), kind("Business Type").alias("btype"), F.lit(source).alias("source"))


def gold_rows(gold: DataFrame) -> DataFrame:
    """Gold records with known labels; the text is the longer of description and teaser, 10 characters at least."""
    d, t = (text.strip(F.coalesce(F.col(c), F.lit(""))) for c in ("Full Incentive Description", "Incentive Teaser"))
    c, m = _labels()
    return _rows(gold, F.when(F.length(d) >= F.length(t), d).otherwise(t), c, m, "Cuisine / Experience Category", "presplit").where(f"category IS NOT NULL AND motivator IS NOT NULL AND length(text) >= {LEAST}")


def _page() -> Column:
    return F.coalesce("_meta.scraped_text", F.lit(""))


def run_rows(records: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """A run's records: found offers, and at most ``negatives`` pages without one, those with the least hash. Pages whose client failed are neither."""
    d = records.where(F.length(_page()) >= PAGE)
    c, m = _labels()
    found = _rows(d.where(F.col("_meta.extraction_source").isin(POSITIVE)), F.substring(_page(), 1, MOST), c, m, "Cuisine / Experience Category", "pipeline").where("category IS NOT NULL AND motivator IS NOT NULL")
    none = d.where((F.col("_meta.extraction_source") == "no_result") & (F.col("_meta.text_chars") > 200))
    if "Notes" in records.columns:
        none = none.where(~F.coalesce("Notes", F.lit("")).startswith(FAILED))
    none = _rows(none, F.substring(_page(), 1, MOST), F.lit("No Incentive"), F.lit("Value"), "Business Type", "pipeline_neg")
    return found.unionByName(none.orderBy(F.xxhash64("text", F.lit(SEED)), "text").limit(negatives))


def relabelled_rows(records: DataFrame) -> DataFrame:
    """Relabelled records but those without an offer."""
    c, m = _labels()
    return _rows(records.where(F.length(_page()) >= PAGE), F.substring(_page(), 1, MOST), c, m, "Cuisine / Experience Category", "relabeled").where("category <> 'No Incentive' AND motivator IS NOT NULL")


def dataset(*sources: DataFrame) -> DataFrame:
    """All sources together, cleaned; rows without text or labels, of less than 10 characters or with spaced-out letters go."""
    d = reduce(DataFrame.unionByName, [s.select(*COLUMNS) for s in sources]).na.drop(subset=["text", "category", "motivator"])
    # a generator's column: filters over a plain one would clean the text anew wherever they name it
    d = d.withColumn("text", F.explode(F.array(text.ascii_clean(text.strip(F.col("text")))))).withColumn("btype", F.coalesce("btype", F.lit("Other")))
    return d.where((F.length("text") >= LEAST) & ~text.has_spaced_chars(F.col("text")))


def shuffled(d: DataFrame, *keys: str, limit: int | None = None, seed: int = SEED) -> DataFrame:
    """A repeatable order by hash; the limit takes a sample."""
    out = d.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys)
    return out if limit is None else out.limit(limit)


def weighted(train: DataFrame, label: str = "category") -> DataFrame:
    """train with ``weight``: rows / (labels * rows of the label)."""
    n = train.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    totals = n.agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__k"))
    weights = n.crossJoin(totals).select(label, (F.col("__all") / (F.col("__k") * F.col("__n"))).alias("weight"))  # totals is one row
    return train.join(weights, label)


def _split() -> RegexTokenizer:
    return RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[\s!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']+", toLowercase=True)


def features(words: int = WORDS) -> list:
    """Lower-cased words without punctuation, the most frequent ones counted and weighed, and the business type."""
    return [
        _split(), CountVectorizer(inputCol="words", outputCol="counts", vocabSize=words), IDF(inputCol="counts", outputCol="tfidf"),
        StringIndexer(inputCol="btype", outputCol="btype_index", stringOrderType="alphabetAsc", handleInvalid="keep"), OneHotEncoder(inputCol="btype_index", outputCol="btype_vector"),
        VectorAssembler(inputCols=["tfidf", "btype_vector"], outputCol="features"),
    ]


def classifier(words: int = WORDS) -> Pipeline:
    """One logistic regression for each label, over the same features; labels are numbered alphabetically. Needs ``weight`` (see weighted)."""
    heads = []
    for label in ("category", "motivator", "cuisine"):
        heads.append(StringIndexer(inputCol=label, outputCol=f"{label}_index", stringOrderType="alphabetAsc", handleInvalid="keep"))
        heads.append(LogisticRegression(featuresCol="features", labelCol=f"{label}_index", weightCol="weight", predictionCol=f"{label}_predicted", probabilityCol=f"{label}_probability", rawPredictionCol=f"{label}_raw", maxIter=30, regParam=0.01))
    return Pipeline(stages=[*features(words), *heads])


def fitted(train: DataFrame, words: int = WORDS) -> PipelineModel:
    """classifier(words) fitted to train (with ``weight``), for texts in large numbers: they are read to find the words and once more to count them; what the
    later stages learn from, counts and then features, is written, not made anew from the texts by each of their passes."""
    stages = classifier(words).getStages()
    counted = next(k for k, s in enumerate(stages) if isinstance(s, CountVectorizer)) + 1
    assembled = next(k for k, s in enumerate(stages) if isinstance(s, VectorAssembler)) + 1
    d, made = train, []
    for part, columns in ((stages[:counted], ["counts", "btype"]), (stages[counted:assembled], ["features"]), (stages[assembled:], [])):
        model = Pipeline(stages=part).fit(d)
        made += model.stages
        if columns:
            d = kept(model.transform(d).select(*columns, "category", "motivator", "cuisine", "weight"), columns[0])
    return PipelineModel(made)


def labels_of(model: PipelineModel) -> dict[str, list[str]]:
    """Each label's classes in the order of their numbers."""
    return {s.getInputCol(): list(s.labels) for s in model.stages if hasattr(s, "labels") and s.getInputCol() != "btype"}


def predicted(model: PipelineModel, sentences: DataFrame) -> DataFrame:
    """sentences (text, btype, ...) with label, motivator, cuisine and confidence."""
    from pyspark.ml.functions import vector_to_array

    d = sentences
    for label in ("category", "motivator", "cuisine"):
        if label not in d.columns:
            d = d.withColumn(label, F.lit(None).cast("string"))
    d, known = model.transform(d), labels_of(model)
    # a label with one class needs no decision
    name = lambda k: F.get(F.array(*[F.lit(x) for x in known[k]]), F.when(F.lit(len(known[k]) > 1), F.col(f"{k}_predicted").cast("int")).otherwise(0))
    return d.select(*sentences.columns, name("category").alias("label"), name("motivator").alias("motivator"), name("cuisine").alias("cuisine"), F.array_max(vector_to_array("category_probability")).alias("confidence"))
