"""Choosing the text of a venue among its pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.functions.text import page_score

MAX_CHARS, GOOD = 8000, 3


def choose(pages: DataFrame, venue: str, text: str, order: str) -> DataFrame:
    """(venue, chosen): the best page if it scores GOOD or is the only one, else the two best joined; at most MAX_CHARS.

    Scores and the first MAX_CHARS characters are computed before the exchange, and each task keeps a venue's two best pages."""
    t = F.coalesce(F.col(text), F.lit(""))
    scored = pages.select(F.col(venue).alias("__v"), F.col(order).alias("__o"), page_score(t).alias("__s"), F.length(t).alias("__n"), F.substring(t, 1, MAX_CHARS).alias("__t"))
    rank = F.when(F.col("__n") > 0, F.col("__s") / (1 + F.col("__n") / MAX_CHARS)).otherwise(0.0)
    ranked = scored.withColumn("__k", F.row_number().over(W.partitionBy("__v").orderBy(rank.desc(), "__o"))).where("__k <= 2")
    first = F.max(F.when(F.col("__k") == 1, F.col("__t")))
    alone = (F.max(F.when(F.col("__k") == 1, F.col("__s"))) >= GOOD) | (F.max("__k") == 1)
    both = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("__t") != "", F.struct("__k", "__t")))), lambda x: x["__t"]), " ")  # two at most
    return ranked.groupBy(F.col("__v").alias(venue)).agg(F.substring(F.when(alone, first).otherwise(both), 1, MAX_CHARS).alias("chosen"))
