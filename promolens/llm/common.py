"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else, so that Spark, Python and SQL agree."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one under a local master only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="promolens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm.org.apache.hadoop.fs.Path(path), True)
    except Exception:  # the session is gone already; the folder's owner clears it
        pass


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_drop, spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lost executors cost no recomputation of what lies before."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
