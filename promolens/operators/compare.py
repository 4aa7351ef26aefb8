"""Gold against prediction: joins, field flags, agreement, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.functions import vocab


def last_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; rows without a key go."""
    keyed = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return keyed.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("r")).select(key, "r.*")


def flag(a: Column, b: Column) -> Column:
    """~ both unknown, ✓ equal, ✗ different."""
    x, y = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (a, b))
    return F.when(x.isin(vocab.UNKNOWN) & y.isin(vocab.UNKNOWN), "~").when(x == y, "✓").otherwise("✗")


def agreement(flags: DataFrame, field: str = "field", mark: str = "flag") -> DataFrame:
    """Per field: agreeing and counted rows (both unknown don't count)."""
    return flags.groupBy(field).agg(F.count_if(F.col(mark) == "✓").alias("agree"), F.count_if(F.col(mark) != "~").alias("counted"))


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support for each label of the truth; 0 where undefined."""
    pairs = df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    both = pairs.where(F.col(truth) == F.col(predicted)).select(F.col(truth).alias("label"), F.col("n").alias("tp"))
    said = pairs.groupBy(F.col(predicted).alias("label")).agg(F.sum("n").alias("said"))
    out = pairs.groupBy(F.col(truth).alias("label")).agg(F.sum("n").alias("support")).join(said, "label", "left").join(both, "label", "left").fillna(0)
    p, r = F.coalesce(F.try_divide("tp", "said"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    return out.select("label", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), "support")


def stratified_split(df: DataFrame, label: str, key: str, share: float = 0.8, bits: int = 12) -> DataFrame:
    """df with ``train``: the given share of each label's rows, in order of a hash of the key.

    A label's rows are counted by the hash's first ``bits`` bits; the bucket in which the share ends is found from these counts, and
    only within that bucket are rows ordered, so that no task needs all rows of a label. A null label is a label, as a null key is a key."""
    h = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    d = df.withColumn("__h", h).withColumn("__b", F.conv(F.substring("__h", 1, bits // 4), 16, 10).cast("int")).withColumn("__l", F.coalesce(F.col(label).cast("string"), F.lit("\u0000")))
    n = d.groupBy("__l", "__b").agg(F.count(F.lit(1)).alias("__n"))  # at most 2^bits rows a label
    w = W.partitionBy("__l")
    ends = n.withColumn("__to", F.sum("__n").over(w.orderBy("__b"))).withColumn("__most", F.floor(share * F.sum("__n").over(w)))
    ends = ends.select("__l", "__b", (F.col("__most") - (F.col("__to") - F.col("__n"))).alias("__room"), "__n")
    d = d.join(ends, ["__l", "__b"])
    whole = d.where("__room >= __n OR __room <= 0").withColumn("train", F.col("__room") > 0)
    cut = d.where("__room > 0 AND __room < __n").withColumn("train", F.row_number().over(W.partitionBy("__l", "__b").orderBy("__h", key)) <= F.col("__room"))
    return whole.unionByName(cut).select(*df.columns, "train")
