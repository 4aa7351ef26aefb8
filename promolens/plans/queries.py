"""The registered queries over stored tables, each with the DuckDB SQL it is checked against where SQL can express it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.functions import text, vocab
from promolens.operators import compare, matching, pages
from promolens.sources.positions import picked, positioned, sliced
from promolens.sources.tables import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    def put(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return put


def _either(phrases: list[str]) -> str:
    """An SQL pattern for any of the phrases, in quotes."""
    return "'" + "|".join(re.sub(r"([.$+*?()\[\]{}|^\\/-])", r"\\\1", p) for p in phrases).replace("'", "''") + "'"


def _count(column: str, phrases: list[str]) -> str:
    return "(" + " + ".join("CAST(contains({}, '{}') AS INT)".format(column, p.replace("'", "''")) for p in phrases) + ")"


_SENTENCES = """SELECT doc_id, source, trim(s) AS s FROM (SELECT doc_id, source, unnest(regexp_split_to_array(coalesce(text, ''), '[.!?\\n]')) AS s FROM documents) WHERE length(trim(s)) >= 10"""
_INCENTIVE = f"NOT regexp_matches(lower(s), {_either(vocab.BOILERPLATE)}) AND (regexp_matches(lower(s), {_either(vocab.STRONG)}) OR {_count('lower(s)', vocab.WEAK)} >= 2)"


@query("sentences", f"SELECT doc_id, CAST(count(DISTINCT s) AS BIGINT) AS n_sentences, CAST(count(DISTINCT CASE WHEN {_INCENTIVE} THEN s END) AS BIGINT) AS n_candidates FROM ({_SENTENCES}) GROUP BY doc_id")
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence split, filter and dedup: counts per document with any sentence."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", text.may_have_incentive(F.col("text")).alias("may"))
    n = lambda s: F.struct(F.size(s).cast("long").alias("n_sentences"), F.when(F.col("may"), F.size(F.filter(s, text.has_incentive))).otherwise(0).cast("long").alias("n_candidates"))
    found = F.filter(F.array(text.let(text.sentences(F.col("text")), n)), lambda x: x["n_sentences"] > 0)  # exploded, so that no filter repeats the split
    return d.select("doc_id", F.explode(found).alias("x")).select("doc_id", "x.n_sentences", "x.n_candidates")


@query("top_candidates", f"SELECT source, rank, doc_id, s AS sentence FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY length(s) DESC, doc_id, s) AS INT) AS rank FROM (SELECT DISTINCT doc_id, source, s FROM ({_SENTENCES}) WHERE {_INCENTIVE})) WHERE rank <= 5")
def top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the five longest candidate sentences of each source (a top-k report)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text").where(text.may_have_incentive(F.col("text")))
    d = d.select("doc_id", "source", F.explode(F.filter(text.sentences(F.col("text")), text.has_incentive)).alias("sentence"))
    w = W.partitionBy("source").orderBy(F.length("sentence").desc(), "doc_id", "sentence")
    return d.withColumn("rank", F.row_number().over(w)).where("rank <= 5").select("source", "rank", "doc_id", "sentence")


#: DuckDB has no lookbehind: the words that "free" does not count after are taken away with it first.
_SCORE = _count("t", vocab.PAGE_KEYWORDS) + r" + CAST(regexp_matches(regexp_replace(t, '(gluten|sugar|duty|toll|fat|risk|hassle|free)[- ]free\b', '', 'g'), '\bfree\b') AS INT)"


@query("page_scores", f"SELECT doc_id, {_SCORE} AS score FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)")
def page_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.page_score(F.col("text")).alias("score"))


def _venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's hundred-document runs as venues, with a path for each of its pages."""
    d = table(spark, sf_dir, "documents")
    path = F.element_at(F.array(*[F.lit(p) for p in vocab.PATHS]), (F.col("doc_id") % len(vocab.PATHS) + 1).cast("int"))
    return d.select(F.concat_ws("/", "source", F.floor(F.col("doc_id") / 100).cast("string")).alias("venue"), path.alias("path"), F.col("doc_id").alias("ord"), "text")


_PATH = "[" + ", ".join(f"'{p}'" for p in vocab.PATHS) + f"][doc_id % {len(vocab.PATHS)} + 1]"
_VENUES = f"SELECT source || '/' || CAST(floor(doc_id / 100) AS BIGINT) AS venue, {_PATH} AS path, doc_id AS ord, coalesce(text, '') AS text, (SELECT {_SCORE} FROM (SELECT lower(coalesce(d.text, '')) AS t)) AS score FROM documents d"


@query("chosen_pages", f"""
WITH v AS ({_VENUES}), r AS (SELECT *, row_number() OVER (PARTITION BY venue ORDER BY CASE WHEN text = '' THEN 0 ELSE score / (1 + length(text) / 8000::DOUBLE) END DESC, ord) AS k, count(*) OVER (PARTITION BY venue) AS n FROM v),
c AS (SELECT venue, CASE WHEN max(CASE WHEN k = 1 THEN score END) >= 3 OR max(n) = 1 THEN max(CASE WHEN k = 1 THEN text END) ELSE string_agg(text, ' ' ORDER BY k) FILTER (text <> '') END AS t FROM r WHERE k <= 2 GROUP BY venue)
SELECT venue, CAST(length(left(t, 8000)) AS INT) AS n_chars, md5(left(t, 8000)) AS chosen_md5 FROM c
""")
def chosen_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page text that is chosen for each venue."""
    return pages.choose(_venues(spark, sf_dir), "venue", "text", "ord").select("venue", F.length("chosen").alias("n_chars"), F.md5(F.col("chosen").cast("binary")).alias("chosen_md5"))


@query("labelled", "SELECT l.quality, l.toxic, d.lang, count(*) AS n FROM documents d JOIN labels l USING (doc_id) GROUP BY ALL")
def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id").groupBy("quality", "toxic", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("labelled_semi", "SELECT source, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY source")
def labelled_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("value_counts", "SELECT source, lang, count(*) AS n, count(DISTINCT text) AS n_texts FROM documents GROUP BY ALL")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.md5(F.col("text").cast("binary"))).alias("n_texts"))


@query("class_weights", "SELECT quality, (SELECT count(*) FROM labels) / (count(*) * (SELECT count(DISTINCT quality) FROM labels)::DOUBLE) AS weight FROM labels GROUP BY quality")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    all_ = W.partitionBy(F.lit(1))
    return n.select("quality", (F.sum("n").over(all_) / (F.col("n") * F.count(F.lit(1)).over(all_).cast("double"))).alias("weight"))


@query("report", """
WITH p AS (SELECT quality AS t, toxic AS p FROM labels), s AS (SELECT t AS label, count(*) AS support FROM p GROUP BY t),
x AS (SELECT label, support, (SELECT count(*) FROM p WHERE t = label AND p = label) AS tp, (SELECT count(*) FROM p WHERE p = label) AS said FROM s)
SELECT label, CASE WHEN said > 0 THEN tp / said::DOUBLE ELSE 0 END AS precision, tp / support::DOUBLE AS recall,
    CASE WHEN tp > 0 THEN 2 * (tp / said::DOUBLE) * (tp / support::DOUBLE) / (tp / said::DOUBLE + tp / support::DOUBLE) ELSE 0 END AS f1, support FROM x
""")
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification report of one label column against the other."""
    return compare.classification_report(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("split", """SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) <= floor(0.8 * count(*) OVER (PARTITION BY quality)) AS train FROM labels""")
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.stratified_split(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("confusion", "SELECT quality, toxic, count(*) AS n FROM labels WHERE quality <> toxic GROUP BY ALL")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality <> toxic").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query("urls", r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), ';[^/]*$', ''), '/+$', '') AS clean,
    CASE WHEN p = '' THEN '/' ELSE p END AS path FROM (SELECT *, regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS p FROM pages)""")
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.clean_url(F.col("url")).alias("clean"), text.path_key(F.col("url")).alias("path"))


@query("field_flags", """
WITH g AS (SELECT doc_id, CAST(quality AS VARCHAR) AS a FROM labels), m AS (SELECT doc_id, CAST(toxic AS VARCHAR) AS b FROM labels),
f AS (SELECT CASE WHEN lower(trim(coalesce(a, ''))) IN ('unknown', '') AND lower(trim(coalesce(b, ''))) IN ('unknown', '') THEN '~' WHEN a = b THEN '✓' ELSE '✗' END AS flag FROM g JOIN m USING (doc_id))
SELECT 'label' AS field, count(*) FILTER (flag = '✓') AS agree, count(*) FILTER (flag <> '~') AS counted FROM f
""")
def field_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold against prediction: last row of each id on both sides, inner join, flags and agreement."""
    rows = positioned(table(spark, sf_dir, "labels"))
    gold = compare.last_by(rows.select("doc_id", F.col("quality").cast("string").alias("a"), "row_idx"), "doc_id", "row_idx").drop("row_idx")
    model = compare.last_by(rows.select("doc_id", F.col("toxic").cast("string").alias("b"), "row_idx"), "doc_id", "row_idx").drop("row_idx")
    return compare.agreement(gold.join(model, "doc_id").select(F.lit("label").alias("field"), compare.flag(F.col("a"), F.col("b")).alias("flag")))


@query("row_positions", "SELECT doc_id, row_number() OVER () - 1 AS row_idx FROM documents")
def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's place over all files."""
    return positioned(table(spark, sf_dir, "documents").select("doc_id"))


@query("row_slice", "SELECT doc_id, row_idx FROM (SELECT doc_id, row_number() OVER () - 1 AS row_idx FROM documents) WHERE row_idx >= 150 AND row_idx < 450")
def row_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows from the hundred and fifty-first on, three hundred of them (the slice is the feature)."""
    return sliced(positioned(table(spark, sf_dir, "documents").select("doc_id")), 150, 300)


@query("row_picks", """SELECT p.pos, d.doc_id, d.row_idx FROM (SELECT doc_id, row_number() OVER () - 1 AS row_idx FROM documents) d JOIN (SELECT pos, CASE WHEN i < 0 THEN i + (SELECT count(*) FROM documents) ELSE i END AS i
    FROM (VALUES (0, 5), (1, -1), (2, 5), (3, 1000000000), (4, 0), (5, -150)) v(pos, i)) p ON d.row_idx = p.i""")
def row_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at given places, with repeats, from the end too."""
    return picked(positioned(table(spark, sf_dir, "documents").select("doc_id")), [5, -1, 5, 1_000_000_000, 0, -150])


_STOP = ["the", "and", "of", "to", "in", "la", "le", "les", "de", "et"]


@query("best_chunks", rf"""
WITH d AS (SELECT conv_id AS grp, turn AS chunk_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 2 AND w NOT IN ({", ".join(f"'{w}'" for w in _STOP)})) AS t FROM conversations),
tf AS (SELECT grp, chunk_id, term, count(*) AS tf FROM (SELECT grp, chunk_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda k: t[k] || ' ' || t[k + 1]))) AS term FROM d) GROUP BY ALL),
w AS (SELECT grp, chunk_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN (SELECT grp, term, count(*) AS df FROM tf GROUP BY ALL) USING (grp, term) JOIN (SELECT grp, count(*) AS n FROM d GROUP BY ALL) USING (grp)),
s AS (SELECT c.grp, c.chunk_id, round(sum(c.w * coalesce(g.w, 0)) / sqrt(sum(c.w * c.w) * any_value(o.n)), 12) AS sim FROM w c LEFT JOIN w g ON g.grp = c.grp AND g.term = c.term AND g.chunk_id = 0
    JOIN (SELECT grp, sum(w * w) AS n FROM w WHERE chunk_id = 0 GROUP BY grp) o ON o.grp = c.grp WHERE c.chunk_id <> 0 GROUP BY ALL),
r AS (SELECT d.grp, d.chunk_id, coalesce(sim, 0) AS sim, row_number() OVER (PARTITION BY d.grp ORDER BY coalesce(sim, 0) DESC, d.chunk_id) AS k, count(*) OVER (PARTITION BY d.grp) AS num_chunks FROM d LEFT JOIN s USING (grp, chunk_id) WHERE d.chunk_id <> 0)
SELECT q.grp, r.chunk_id, round(coalesce(sim, 0), 4) AS similarity, coalesce(num_chunks, 0) AS num_chunks FROM (SELECT grp FROM d WHERE chunk_id = 0) q LEFT JOIN r ON r.grp = q.grp AND r.k = 1
""")
def best_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each conversation the later turn that is most like its first one."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("grp"), F.col("turn").alias("chunk_id"), "text")
    return matching.best_chunk(turns.where("chunk_id = 0").select("grp", "text"), turns.where("chunk_id <> 0"), _STOP)
