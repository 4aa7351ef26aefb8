"""The confidence cascade: sentence predictions, hints, priors and a fallback extractor, as array expressions and staged columns.

Predictions come from any model as array<struct<sentence, label, motivator, cuisine, confidence>> in the sentences' order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import chunks, extract, text, vocab
from promolens.operators import job
from promolens.operators.clients import Client, answered

SURE, HINTED, LEAST, BOOST, CEILING = 0.75, 0.50, 0.3, 0.15, 0.95


def gated(predictions: Column) -> Column:
    """Predictions that count, with quality and score (confidence times quality)."""
    with_quality = F.transform(predictions, lambda p: F.struct(p["sentence"].alias("sentence"), p["label"].alias("label"), p["motivator"].alias("motivator"), p["cuisine"].alias("cuisine"), p["confidence"].alias("confidence"), text.quality(p["sentence"]).alias("quality")))
    kept = F.filter(with_quality, lambda p: (p["quality"] > 0) & (p["label"] != "No Incentive") & (p["confidence"] > LEAST))
    return F.transform(kept, lambda p: p.withField("score", p["confidence"] * p["quality"]))


def first_best(items: Column, by: str) -> Column:
    """The first of the items with the largest field, null if there are none."""
    top = F.array_max(F.transform(items, lambda p: p[by]))
    return F.get(F.filter(items, lambda p: p[by] == top), F.lit(0))


def first_known(values: Column) -> Column:
    return F.coalesce(F.get(F.filter(values, lambda v: v != "Unknown"), F.lit(0)), F.lit("Unknown"))


def signal_sentence(predictions: Column, pattern: str, otherwise: Column) -> Column:
    """The best sentence by quality in which the pattern occurs."""
    return F.coalesce(first_best(F.filter(predictions, lambda p: p["sentence"].rlike(pattern)), "quality")["sentence"], otherwise)


def model_result(df: DataFrame, candidates: str = "candidates", predictions: str = "predictions") -> DataFrame:
    """df with ``ml``: the result of the best prediction, null if none counts. Values and times are sought in the best sentence, then in the others, then in all candidates."""
    d = df.withColumn("__all", gated(F.col(predictions))).withColumn("__best", first_best(F.col("__all"), "score"))
    d = d.withColumn("__said", F.array_join(F.transform("__all", lambda p: p["sentence"]), " "))
    times = F.transform(F.array(F.coalesce("__best.sentence", F.lit("")), F.col("__said")), lambda t: extract.timing(t))
    d = d.withColumn("__time", F.explode(F.array(first_known(times))))  # exploded, so that it is found once, however often the result names it
    b = F.col("__best")
    value = first_known(F.concat(F.array(extract.value(b["sentence"])), F.transform("__all", lambda p: extract.value(p["sentence"])), F.transform(F.col(candidates), extract.value)))
    made = job._struct(
        category=b["label"], teaser=text.shorten(b["sentence"]), description=b["sentence"], timing=F.col("__time"), motivator=extract.motivator(b["label"], b["sentence"]), cuisine=b["cuisine"], value=value,
        status=extract.status(F.col("__said")), notes=F.format_string("Model prediction (confidence: %.2f)", b["confidence"]), model_confidence=b["confidence"], source="ml_model")
    return d.withColumn("ml", F.when(b.isNotNull(), made)).withColumn("all_predictions", F.col("__all")).drop("__all", "__best", "__said", "__time")


def with_prior(result: Column, predictions: Column, business_type: Column) -> Column:
    """Happy hours of venues that live on entry or on live music, with a sentence that says so, become that."""
    kind, said = extract.venue_type(business_type), F.when(F.size(predictions) > 0, F.array_join(F.transform(predictions, lambda p: p["sentence"]), " ")).otherwise(result["description"])

    def moved(category: str, pattern: str) -> Column:
        sentence = signal_sentence(predictions, pattern, result["description"])
        new = result.withField("category", F.lit(category)).withField("description", sentence).withField("teaser", text.shorten(sentence)).withField("motivator", extract.motivator(F.lit(category), sentence))
        return new.withField("notes", F.concat(result["notes"], F.lit(f" [btype-prior: {category}]")))

    happy = result["category"] == "Happy Hour"
    return (
        F.when(happy & kind.isin(vocab.NIGHTCLUB_TYPES) & said.rlike(vocab.EARLY_ENTRY_SIGNALS), moved("Early Entry", vocab.EARLY_ENTRY_SIGNALS))
        .when(happy & kind.isin(vocab.LIVE_MUSIC_TYPES) & said.rlike(vocab.LIVE_MUSIC_SIGNALS), moved("Live Music", vocab.LIVE_MUSIC_SIGNALS))
        .otherwise(result)
    )


def boosted(result: Column) -> Column:
    return result.withField("model_confidence", F.least(result["model_confidence"] + BOOST, F.lit(CEILING))).withField("source", F.lit("ml_model_hinted"))


def is_hinted(result: Column) -> Column:
    return F.coalesce(text.category_hint(result["description"]) == result["category"], F.lit(False))


def fallback_prompt(df: DataFrame) -> Column:
    """The first twenty candidates of rows that neither a sure prediction nor a hint settles; null for the others, which no client is asked about."""
    conf = F.coalesce(F.col("ml.model_confidence"), F.lit(0.0))
    member = chunks.is_membership(F.col("ml.description"), F.col("ml.teaser"))
    settled = (conf >= SURE) | ((conf >= HINTED) & (member | is_hinted(F.col("ml"))))
    some = F.array_join(F.slice("candidates", 1, 20), " ")
    return F.when((F.size("candidates") > 0) & ~settled, job.prompt(some, F.col("business_type")))


def run(df: DataFrame, fallback: Callable[[], Client], store: str | None = None) -> DataFrame:
    """df (text, business_type, predictions) with ``result``, and ``client_error`` where the fallback failed, which is not to find nothing. store: where the fallback's answers are kept."""
    d = model_result(df.withColumn("candidates", text.candidates(F.col("text"))))
    d = answered(d.withColumn("prompt", fallback_prompt(d)), "prompt", "raw", fallback, store).withColumn("said", job.parsed_fenced(F.col("raw")))
    ml, said, conf = F.col("ml"), F.col("said"), F.coalesce(F.col("ml.model_confidence"), F.lit(0.0))
    skipped = job.empty_result("Membership-based incentive — skipped")
    unless_member = lambda r, then: F.when(chunks.is_membership(r["description"], r["teaser"]), skipped).otherwise(then)
    asked = job._struct(
        category=said["category"], teaser=F.when(said["teaser"] != "", said["teaser"]).otherwise(text.shorten(said["description"])), description=said["description"], timing=said["timing"],
        motivator=F.coalesce(ml["motivator"], F.lit("Unknown")), cuisine=F.coalesce(ml["cuisine"], F.lit("Unknown")), value=said["value"], status=extract.status(said["description"]), notes="Fallback extraction",
        model_confidence=F.coalesce(ml["model_confidence"], F.lit(1.0)), source="fallback")
    made = (
        F.when(F.coalesce("text", F.lit("")) == "", job.empty_result("Could not scrape source"))
        .when(F.size("candidates") == 0, job.empty_result("No incentive keywords found on page"))
        .when(conf >= SURE, unless_member(ml, with_prior(ml, F.col("all_predictions"), F.col("business_type"))))
        .when((conf >= HINTED) & chunks.is_membership(ml["description"], ml["teaser"]), skipped)
        .when((conf >= HINTED) & is_hinted(ml), boosted(ml))
        .when(F.coalesce(said["category"], F.lit("No Incentive")) != "No Incentive", unless_member(asked, asked))
        .when(ml.isNotNull(), unless_member(ml, ml.withField("source", F.lit("ml_model_fallback"))))
        .otherwise(job.empty_result("No incentive detected"))
    )
    return d.select(*df.columns, made.alias("result"), F.col("raw_error").alias("client_error"))
