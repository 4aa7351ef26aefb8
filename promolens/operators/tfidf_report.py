"""The TF-IDF report: crawled rows grouped by source url, their chunks without repeats, and the chunk most like the gold description."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.chunks import split_chunks
from promolens.functions.text import strip
from promolens.operators.matching import best_chunk


def english() -> list[str]:
    """Spark's own English stop words."""
    return StopWordsRemover.loadDefaultStopWords("english")


def _blank(c: str) -> Column:
    return F.coalesce(strip(F.col(c)), F.lit(""))


def _key(c: Column) -> Column:
    """Lower-cased, white space collapsed: what counts as the same chunk."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def chunk_rows(rows: DataFrame, order: str = "row_idx") -> DataFrame:
    """(source_url, chunk_id, text): each row's top candidate, then its chunks, in the rows' order, the first of the same ones. chunk_id grows with the place."""
    parts = F.concat(F.filter(F.array(_blank("top_candidate_text")), lambda x: x != ""), split_chunks(F.col("all_candidate_chunks")))
    d = rows.select("source_url", order, F.posexplode(parts).alias("pos", "text"))
    first = d.groupBy("source_url", _key(F.col("text")).alias("k")).agg(F.min_by(F.struct(order, "pos", "text"), F.struct(order, "pos")).alias("f"))
    return first.select("source_url", (F.col(f"f.{order}") * F.lit(1 << 20) + F.col("f.pos")).cast("long").alias("chunk_id"), "f.text")


def groups(rows: DataFrame, order: str = "row_idx") -> DataFrame:
    """(source_url, the first row's gold fields, failure_types, best_failure_type); a null url is a group."""
    gold = {"venue_name": "venue_name", "gold_category": "incentive_category_gold", "gold_teaser": "teaser_gold", "gold_description": "description_gold"}
    first = F.min_by(F.struct(*[_blank(v).alias(k) for k, v in gold.items()]), order)
    g = rows.groupBy("source_url").agg(first.alias("f"), F.array_sort(F.collect_set("failure_type")).alias("types"))
    best = F.when(F.array_contains("types", "ok"), "ok").otherwise(F.coalesce(F.get("types", F.lit(0)), F.lit("")))
    return g.select("source_url", "f.*", F.array_join("types", ", ").alias("failure_types"), best.alias("best_failure_type"))


def report(rows: DataFrame, stop: Iterable[str] | None = None, order: str = "row_idx") -> DataFrame:
    """A row for each source url: the best chunk, its similarity (0 and no chunk without gold text or chunks), ordered by failure class and similarity."""
    no_url = F.coalesce("source_url", F.lit("\u0000"))
    g, c = groups(rows, order).withColumn("grp", no_url), chunk_rows(rows, order).withColumn("grp", no_url)
    best = best_chunk(g.select("grp", F.col("gold_description").alias("text")), c.select("grp", "chunk_id", "text"), english() if stop is None else stop)
    d = g.join(best, "grp", "left").join(c.select("grp", "chunk_id", F.col("text").alias("best_chunk")), ["grp", "chunk_id"], "left")
    told = F.col("gold_description") != ""
    return d.select(
        "venue_name", "source_url", "gold_category", "gold_teaser", "gold_description", F.when(told, F.coalesce("best_chunk", F.lit(""))).otherwise("").alias("best_chunk"),
        F.when(told, F.coalesce("similarity", F.lit(0.0))).otherwise(0.0).alias("tfidf_similarity"), F.coalesce("num_chunks", F.lit(0)).alias("num_chunks"), "failure_types", "best_failure_type", F.lit("").alias("manual_label"),
    ).orderBy("best_failure_type", F.desc("tfidf_similarity"), "source_url")
