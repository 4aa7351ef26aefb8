"""Writers: JSON arrays, JSON lines, CSV, files that never overwrite, models with their labels."""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from promolens.functions.text import strip
from promolens.sources.positions import kept


def _plain(value, keep: tuple[str, ...]):
    """Structs and maps without their null fields, but for those to keep."""
    if isinstance(value, dict):
        return {k: _plain(v, keep) for k, v in value.items() if v is not None or k in keep}
    if isinstance(value, (list, tuple)):
        return [_plain(v, keep) for v in value]
    return value


def json_array(df: DataFrame, path: str, order: str | None = None, indent: int = 4, keep: tuple[str, ...] = ("priority",), ascii_only: bool = True) -> int:
    """One file with one JSON array, on any store Spark writes to; returns how many records it has. Nested fields that are null are left out but for ``keep``;
    top-level ones stay. The text is that of json.dump with the indent, and a line's end.

    Records become text where they are, are written once (so that what makes them, a model's answers say, runs once) and sorted by range; one task then writes the ranges one after the other, a batch at a time. No row passes
    through the driver, which renames the committed file alone: a task that fails or is killed leaves nothing at ``path``, and a file that is there stays
    until the new one is whole. ``order`` may be any column; without it records stand in the order of df's partitions."""
    names, spark = df.columns, df.sparkSession
    d = df.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in names]).alias("r"), (F.col(f"`{order}`") if order else F.monotonically_increasing_id()).alias("o"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for r in b.column(0).to_pylist(maps_as_pydicts="strict"):
                record = {c: _plain(r[c], keep) for c in names}
                texts.append(" " * indent + json.dumps(record, indent=indent, ensure_ascii=ascii_only, default=str).replace("\n", "\n" + " " * indent))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column(1)], ["value", "o"])

    kind = d.schema["o"].dataType
    texts = kept(d.mapInArrow(told, f"value string, o {kind.simpleString()}"), "json-records").withColumn("k", F.lit(1))
    begin = spark.range(1).select(F.lit(None).cast("string").alias("value"), F.lit(None).cast(kind).alias("o"), F.lit(0).alias("k"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Commas between records, brackets around them; the last record is held until it is known to be the last."""
        held, n = None, 0
        for b in batches:
            out = []
            for text in b.column(0).to_pylist():
                if text is not None:
                    out.append("[" if held is None else held + ",")
                    held, n = text, n + 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([held, "]"] if n else ["[]"], pa.string())], ["value"])

    work = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        lines = texts.unionByName(begin).orderBy("k", "o").select("value").coalesce(1).observe(seen := Observation(), F.count("value").alias("n"))
        lines.mapInArrow(joined, "value string").write.text(work)
        fs, at = _store(spark, work)
        part = next(s.getPath() for s in fs.globStatus(at(f"{work}/part-*")) if s.getLen())
        fs.delete(at(path), False)
        if not fs.rename(part, at(path)):
            raise OSError(f"{path} can't be written")
    finally:
        fs, at = _store(spark, work)
        fs.delete(at(work), True)
    return seen.get["n"]


def _store(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and what makes its paths."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def timestamped(df: DataFrame, base: str, ext: str = "json", now: datetime | None = None, **of) -> str:
    """df as a JSON array (UTF-8, indent 2) named base_YYYYmmdd_HHMMSS.ext, or with the first number behind that is free; returns the path."""
    spark, stem = df.sparkSession, f"{base}_{(now or datetime.now()):%Y%m%d_%H%M%S}"
    path = _unused(spark, stem, ext)
    json_array(df, path, **({"indent": 2, "ascii_only": False} | of))
    return path


def json_lines(df: DataFrame, path: str, nulls: bool = False) -> None:
    df.write.option("ignoreNullFields", str(not nulls).lower()).json(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def _unused(spark: SparkSession, base: str, ext: str) -> str:
    """base.ext, or the first of base_1.ext, base_2.ext, ... that does not exist, on the path's own store."""
    fs, at = _store(spark, base)
    return next(n for n in (f"{base}{f'_{k}' if k else ''}.{ext}" for k in itertools.count()) if not fs.exists(at(n)))


def unique_csv(df: DataFrame, base: str, ext: str = "csv") -> str:
    path = _unused(df.sparkSession, base, ext)
    csv(df, path)
    return path


def collapsed(df: DataFrame) -> DataFrame:
    """White-space runs of every text column as one space, stripped."""
    return df.select(*[strip(F.regexp_replace(F.col(f"`{c}`"), r"(?U)\s+", " ")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def model(fitted, path: str) -> None:
    """A fitted pipeline, its label lists in the order of their numbers, and the sorted business types."""
    from promolens.operators.training import labels_of

    fitted.write().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    lists = labels_of(fitted) | {"btype": sorted(next(s for s in fitted.stages if hasattr(s, "labels") and s.getInputCol() == "btype").labels)}
    for name, labels in lists.items():
        spark.createDataFrame([(x,) for x in labels], "value string").coalesce(1).write.text(f"{path}/labels_{name}")


def is_saved(spark, path: str) -> bool:
    """Whether all parts of a saved model are there."""
    jvm = spark.sparkContext._jvm
    where = lambda p: jvm.org.apache.hadoop.fs.Path(f"{path}/{p}")
    fs = where("model").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return all(fs.exists(where(p)) for p in ("model", "labels_category", "labels_motivator", "labels_cuisine", "labels_btype"))
