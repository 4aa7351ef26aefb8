"""Exact positions of rows over many files and splits.

Rows stand in the order of their files' paths, then of their places in the file. A file's splits are counted where they are read, the counts are
added up over splits (a small table), and each row's place is its split's offset and its place in the split. No row is sorted or moved.

Parquet tells a row's place in its file. Other formats don't: there the rows are written once, with the number that the reading task gave them, so
that counting and numbering see the same rows even if a lost executor reads a split again. ``written`` names the folder (shared by all executors).
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Up to this many splits their offsets are broadcast (some 100 bytes each).
FEW = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the cluster names it; a local one under a local master alone."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="promolens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session is gone already; the folder's owner clears it
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again; the folder is removed when the driver's Python ends."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_drop, df.sparkSession, path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def offsets(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """(keys, offset) of (keys, n): the sum of what stands before, by keys. The first key's sums are made first, so that a task sees the splits of one file, or the files."""
    if len(keys) == 1:
        before = F.sum(n).over(W.orderBy(*keys).rowsBetween(W.unboundedPreceding, -1))
        return counts.select(*keys, F.coalesce(before, F.lit(0)).alias("offset"))
    whole = offsets(counts.groupBy(keys[0]).agg(F.sum(n).alias(n)), keys[:1], n).withColumnRenamed("offset", "__first")
    before = F.sum(n).over(W.partitionBy(keys[0]).orderBy(*keys[1:]).rowsBetween(W.unboundedPreceding, -1))
    inner = counts.select(*keys, F.coalesce(before, F.lit(0)).alias("__in"))
    return inner.join(whole, keys[0]).select(*keys, (F.col("__first") + F.col("__in")).alias("offset"))


def _with_offsets(df: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    small = offsets(counts, keys)
    return df.join(F.broadcast(small) if counts.count() <= FEW else small, keys)


def positioned(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """df, read from files, with each row's position from 0 on. Filters belong behind it: before it, they would close the gaps."""
    if name in df.columns:
        raise ValueError(f"{name} is there already")
    path = F.col("_metadata.file_path").alias("__path")
    try:
        d = df.select("*", path, F.col("_metadata.row_index").alias("__at"))
    except AnalysisException:
        d = df.select("*", path, F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
        d = kept(d, "numbered")
        counts = d.groupBy("__path", "__block").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("__least"))
        least = F.col("__id") - F.col("__least")
        keys = ["__path", "__block"]
        small = offsets(counts, keys).join(counts, keys).select(*keys, "offset", "__least")
        d = d.join(F.broadcast(small) if counts.count() <= FEW else small, keys)
        return d.select(*df.columns, (F.col("offset") + least).alias(name))
    counts = d.groupBy("__path").agg(F.count(F.lit(1)).alias("n"))
    return _with_offsets(d, counts, ["__path"]).select(*df.columns, (F.col("offset") + F.col("__at")).alias(name))


def sliced(df: DataFrame, offset: int = 0, limit: int | None = None, name: str = "row_idx") -> DataFrame:
    """The rows of a slice [offset:offset + limit] of positioned rows; negative offsets count from the end, as Python's do."""
    if offset < 0:
        offset = max(0, offset + df.count())
    at = F.col(name)
    return df.where(at >= offset) if limit is None else df.where((at >= offset) & (at < offset + limit))


def picked(df: DataFrame, indices: list[int], name: str = "row_idx") -> DataFrame:
    """(pos, columns): positioned rows at the given positions, with repeats; pos is their order. Negative ones count from the end, others beyond it are left out."""
    n = df.count() if any(i < 0 for i in indices) else None
    wanted = [(k, i + n if i < 0 else i) for k, i in enumerate(indices)]
    want = df.sparkSession.createDataFrame([w for w in wanted if w[1] >= 0], f"pos int, `{name}` long")
    return F.broadcast(want).join(df, name).select("pos", *df.columns)  # as long as the list of indices
