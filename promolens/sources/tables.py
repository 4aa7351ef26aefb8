"""Readers: Parquet tables and venue lists as JSON."""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from promolens.sources.json_values import objects


def table(spark: SparkSession, sf_dir: str, name: str, options: dict[str, str] | None = None) -> DataFrame:
    return spark.read.options(**options or {}).parquet(f"{sf_dir}/{name}.parquet")


def json_values(raw: bytes) -> Iterator[dict]:
    """The objects of an array, of one object, or of concatenated values; what follows the first bad value is left out."""
    text, decode, at = raw.removeprefix(codecs.BOM_UTF8).decode("utf-8", "replace"), json.JSONDecoder().raw_decode, 0
    while True:
        while at < len(text) and text[at].isspace():
            at += 1
        try:
            value, at = decode(text, at)
        except ValueError:
            return
        yield from (x for x in (value if isinstance(value, list) else [value]) if isinstance(x, dict))


def venues(spark: SparkSession, path: str, fields: list[str], url: str | None = "Source URL") -> DataFrame:
    """(row_idx, fields as text) of all files under a path; rows without the url field's value go. row_idx is the object's position over all files."""

    def work(frames):
        import pandas as pd

        for pdf in frames:
            rows = []
            for k, value in zip(pdf["row_idx"], pdf["value"], strict=True):
                v = json.loads(value)
                if url is None or v.get(url):
                    rows.append([k, *[x if (x := v.get(f)) is None or isinstance(x, str) else json.dumps(x) for f in fields]])
            yield pd.DataFrame(rows, columns=["row_idx", *fields])

    schema = "row_idx long, " + ", ".join(f"`{f}` string" for f in fields)
    return objects(spark, path).select("row_idx", "value").mapInPandas(work, schema)
