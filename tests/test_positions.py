"""Positions of rows over many files and splits."""

import random

import pytest
from pyspark.sql import functions as F

from promolens.sources import lists
from promolens.sources.positions import offsets, picked, positioned, sliced


@pytest.fixture
def small_splits(spark):
    for k, v in {"spark.sql.files.maxPartitionBytes": "3k", "spark.sql.files.openCostInBytes": "1"}.items():
        spark.conf.set(k, v)
    yield
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k)


def lines(tmp_path, sizes):
    """Text files of many splits each; what the rows say, in the order of paths."""
    r, out = random.Random(3), []
    for k, n in enumerate(sizes):
        rows = [f"{k}-{i}-" + "x" * r.randint(0, 60) for i in range(n)]
        (tmp_path / f"f{k}.txt").write_text("".join(x + "\n" for x in rows))
        out += rows
    return out


def test_positions_of_text(spark, tmp_path, small_splits):
    want = lines(tmp_path, [1, 700, 0, 333, 1200])
    d = spark.read.text(str(tmp_path))
    assert d.rdd.getNumPartitions() > 10
    got = positioned(d).collect()
    assert sorted((x.row_idx, x.value) for x in got) == list(enumerate(want))
    assert positioned(d.where("value = 'no'")).count() == 0
    with pytest.raises(ValueError):
        positioned(d.withColumn("row_idx", F.lit(1)))


def test_positions_of_parquet(spark, tmp_path, small_splits):
    for k, n in enumerate([500, 3, 2000]):
        spark.range(n).select(F.col("id"), F.lit(k).alias("f"), F.sha2(F.col("id").cast("string"), 512).alias("pad")).coalesce(1).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/p/k{k}")
    d = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/p")
    assert d.rdd.getNumPartitions() > 3
    got = sorted((x.row_idx, x.f, x.id) for x in positioned(d.select("f", "id")).collect())
    assert got == [(k, *x) for k, x in enumerate((f, i) for f, n in enumerate([500, 3, 2000]) for i in range(n))]


def test_slices_and_picks(spark, tmp_path, small_splits):
    want = lines(tmp_path, [400, 300])
    d = positioned(spark.read.text(str(tmp_path))).cache()
    for offset, limit in ((0, 5), (390, 20), (650, None), (-7, None), (-9999, 3), (5000, 2), (3, 0)):
        got = [x.value for x in sliced(d, offset, limit).orderBy("row_idx").collect()]
        start = offset if offset >= 0 else max(0, len(want) + offset)
        assert got == want[start : None if limit is None else start + limit]
    got = [(x.pos, x.value) for x in picked(d, [3, -700, 3, 9999, -701, 699, -1]).orderBy("pos").collect()]
    assert got == [(0, want[3]), (1, want[0]), (2, want[3]), (5, want[699]), (6, want[699])]
    assert picked(d, []).count() == 0


def test_offsets(spark):
    d = spark.createDataFrame([("b", 0, 5), ("a", 10, 2), ("a", 2, 3), ("c", 0, 1)], "p string, q int, n int")
    assert sorted(tuple(x) for x in offsets(d, ["p", "q"]).collect()) == [("a", 2, 0), ("a", 10, 3), ("b", 0, 5), ("c", 0, 10)]


def test_csv_rows_of_many_files(spark, tmp_path):
    """Quoted line breaks are no rows; the first row of a url is the first over all files."""
    for k in range(3):
        (tmp_path / f"g{k}.csv").write_text("﻿Source URL,v\n" + "".join(f'http://a/{i % 4},"{k} ""{i}""\nmore"\n' for i in range(5)))
    got = sorted((x.row_idx, x["Source URL"], x.v) for x in lists.csv(spark, str(tmp_path)).collect())
    assert got == [(5 * k + i, f"http://a/{i % 4}", f'{k} "{i}"\nmore') for k in range(3) for i in range(5)]
