"""Readers of gold lists, label files and record files, and slices of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.operators.evaluate import gold_reasons
from promolens.operators.training import shuffled
from promolens.sources.json_values import read
from promolens.sources.positions import positioned


def csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header (a byte-order mark is dropped), fields over several lines, quotes doubled; row_idx is the rows' position, over all files in the order of their paths."""
    d = positioned(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))
    return d.toDF(*[c.lstrip("\ufeff") for c in d.columns])


def gold(spark: SparkSession, path: str, limit: int | None = None, seed: int = 42) -> DataFrame:
    """Gold rows with all required fields and a good url, the first of each url, in a repeatable random order."""
    d = gold_reasons(csv(spark, path)).where("reason IS NULL").drop("reason")
    return shuffled(d, "Source URL", limit=limit, seed=seed)


def sampled(df: DataFrame, required: list[str], url: str, n: int = 10, seed: int = 42) -> DataFrame:
    """n rows with the required fields and a url without white space, chosen by hash."""
    u = F.col(f"`{url}`")
    return shuffled(df.na.drop(subset=required).where(u.startswith("http") & ~u.rlike(r"(?U)\s")), url, limit=n, seed=seed)


def labels(spark: SparkSession, path: str) -> DataFrame:
    """(index, label) of a file with a label a line; blank lines are left out. For one small file."""
    d = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(F.transform(F.split("value", "\r?\n"), F.trim), lambda x: x != "")).alias("index", "label"))
    return d


def records(spark: SparkSession, *paths: str, schema: str | None = None, relabelled: bool = True) -> DataFrame:
    """The records of JSON files (an array a file, or a record a line); files that are not whole are skipped, relabelled ones too if asked. ``quarantined`` tells which and why."""
    good, faults = read(spark, list(paths))
    good = good.join(faults.select("path").distinct(), "path", "left_anti")
    if not relabelled:
        good = good.where(~F.element_at(F.split("path", "/"), -1).contains("_relabeled"))
    if schema is None:
        schema = spark.read.json(good.select("value").rdd.map(lambda r: r[0])).schema if good.limit(1).count() else "value string"
    return good.select(F.from_json("value", schema).alias("r")).select("r.*")


def quarantined(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, block, reason): a row for each JSON file that ``records`` skips, the byte range of its first fault, and what is wrong there."""
    return read(spark, list(paths))[1]


def known_first(venues: DataFrame, category: str = "Incentive Category", limit: int = 5, order: str = "row_idx") -> DataFrame:
    """Venues with a known category first, then the others, each in their order."""
    unknown = F.coalesce(F.col(f"`{category}`"), F.lit("Unknown")) == "Unknown"
    return venues.orderBy(unknown, order).limit(limit)


def projected(df: DataFrame, columns: list[str]) -> DataFrame | None:
    """The columns; none if the list is empty. A column that is missing raises."""
    return df.select(*[f"`{c}`" for c in columns]) if columns else None
