"""The chunk of each group that is most like the group's gold text, by TF-IDF cosine over the group's own texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.sources.positions import kept


def terms(text: Column, stop: Iterable[str] = ()) -> Column:
    """Lower-case words of two characters or more that are no stop words, then pairs of neighbours among them."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: (F.length(w) >= 2) & ~w.isin(*stop))
    pairs = lambda t: F.zip_with(F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))), F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.element_at(F.transform(F.array(words), lambda t: F.concat(t, pairs(t))), 1)


def best_chunk(gold: DataFrame, chunks: DataFrame, stop: Iterable[str] = ()) -> DataFrame:
    """(grp, chunk_id, similarity, num_chunks) from gold (grp, text), one row a group, and chunks (grp, chunk_id, text).

    Smooth idf and unit length; ties go to the smaller chunk_id, and groups without chunks or gold words get a similarity of 0."""
    texts = gold.select("grp", F.lit(None).cast("long").alias("chunk_id"), "text").unionByName(chunks.select("grp", F.col("chunk_id").cast("long"), "text"))
    tf = texts.select("grp", "chunk_id", F.explode(terms(F.col("text"), stop)).alias("term")).groupBy("grp", "term", "chunk_id").agg(F.count(F.lit(1)).alias("tf"))
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    weighed = tf.join(tf.groupBy("grp", "term").agg(F.count(F.lit(1)).alias("df")), ["grp", "term"]).join(texts.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "grp").select("grp", "term", "chunk_id", (F.col("tf") * idf).alias("w"))
    weighed = kept(weighed, "weighed")  # three joins read it
    query = weighed.where("chunk_id IS NULL").select("grp", "term", F.col("w").alias("g"))
    shared = weighed.where("chunk_id IS NOT NULL").join(query, ["grp", "term"], "left").groupBy("grp", "chunk_id")
    dots = shared.agg(F.sum(F.col("w") * F.coalesce("g", F.lit(0.0))).alias("dot"), F.sum(F.col("w") * F.col("w")).alias("own"))
    dots = dots.join(query.groupBy("grp").agg(F.sum(F.col("g") * F.col("g")).alias("of")), "grp")
    score = dots.select("grp", "chunk_id", F.round(F.col("dot") / F.sqrt(F.col("own") * F.col("of")), 12).alias("sim"))
    every = chunks.select("grp", F.col("chunk_id").cast("long")).join(score, ["grp", "chunk_id"], "left").groupBy("grp")
    best = every.agg(F.count(F.lit(1)).alias("num_chunks"), F.max_by(F.struct("chunk_id", F.coalesce("sim", F.lit(0.0)).alias("sim")), F.struct(F.coalesce("sim", F.lit(0.0)), -F.col("chunk_id"))).alias("b"))
    return gold.select("grp").join(best, "grp", "left").select("grp", "b.chunk_id", F.round(F.coalesce("b.sim", F.lit(0.0)), 4).alias("similarity"), F.coalesce("num_chunks", F.lit(0)).alias("num_chunks"))
