"""The JSON array sink against json.dump, and what failed tasks leave."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from promolens.sources import sinks

SCHEMA = "k long, s string, x double, b boolean, t array<struct<a:string, priority:string, n:struct<q:int>>>, m map<string,string>, o struct<priority:string, z:string>"
ROWS = [
    (k, None if k % 5 == 0 else f'é "{k}"\n\\', k / 3, k % 2 == 0, [("a", None, (None,)), (None, "p", None)] if k % 3 else [], {"u": None, "v": "w"} if k % 4 else None, (None, None) if k % 7 else None)
    for k in range(500)
]


def plain(k, s, x, b, t, m, o):
    """Nested nulls go, but for priority; top-level ones stay."""
    one = lambda a, p, n: ({"a": a} if a is not None else {}) | {"priority": p} | ({"n": {}} if n is not None else {})
    return {"k": k, "s": s, "x": x, "b": b, "t": [one(*y) for y in t], "m": None if m is None else {i: j for i, j in m.items() if j is not None}, "o": None if o is None else {"priority": None}}


def test_json_array(spark, tmp_path):
    d, path = spark.createDataFrame(ROWS, SCHEMA).repartition(7), f"{tmp_path}/out.json"
    for indent, ascii_only in ((4, True), (2, False)):
        assert sinks.json_array(d, path, "k", indent=indent, ascii_only=ascii_only) == 500  # written over
        assert open(path, encoding="utf-8").read() == json.dumps([plain(*r) for r in ROWS], indent=indent, ensure_ascii=ascii_only) + "\n"
    assert sinks.json_array(d.limit(0), path) == 0 and open(path).read() == "[]\n"
    assert sinks.json_array(d.where("k = 3"), path) == 1 and json.load(open(path)) == [plain(*ROWS[3])]
    assert [x for x in os.listdir(tmp_path) if not x.endswith(".crc")] == ["out.json"]


def test_failed_tasks_leave_nothing(spark, tmp_path):
    path = f"{tmp_path}/out.json"
    (tmp_path / "out.json").write_text("before")
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="stop"):
        sinks.json_array(bad, path)
    assert open(path).read() == "before" and [x for x in os.listdir(tmp_path) if not x.endswith(".crc")] == ["out.json"]


def test_timestamped_names(spark, tmp_path):
    d, at = spark.createDataFrame([("é",)], "v string"), datetime(2026, 1, 2, 3, 4, 5)
    first, second = (sinks.timestamped(d, f"{tmp_path}/inspect", now=at) for _ in range(2))
    assert (first, second) == (f"{tmp_path}/inspect_20260102_030405.json", f"{tmp_path}/inspect_20260102_030405_1.json")
    assert open(first, encoding="utf-8").read() == '[\n  {\n    "v": "é"\n  }\n]\n'
