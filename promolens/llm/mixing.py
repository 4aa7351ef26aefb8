"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents, shuffled by the md5 of their ids, served twice at most. A document's virtual finish
time is the number of its source's words up to its end, divided by the source's target; a fair server, which
gives each source words in proportion to its target, finishes the documents in just that order. Truncating that
order at the total budget is truncating it at virtual time 1, where each source has had exactly its target.

The running sums never gather a source in one task: documents are summed within blocks of the shuffle key, blocks
within superblocks, and superblocks within a source, so that a source with a third of all rows is spread as well.

Defined results: a null text has size 0; a null source is a source of its own, after the others; a null doc_id
shuffles as the empty text; repeated rows are documents of their own, ordered by size, then by their texts' hash; an empty
table gives an empty mix. Columns of other names are carried along; names starting with ``__mix`` are reserved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.llm.common import WORD, table, written

WEIGHTS, BUDGET, REPEATS = (3, 1, 2), 1.5, 2
#: Documents that a block holds on average.
BLOCK = 1024


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target): budget times all words, shared by weight; a source gets ``repeats`` times its size
    at most and the excess is shared again. Sources in ascending order of that bound per weight are the ones that stop,
    so one pass in this order finds them. The table has a row per source."""
    by_name, by_ratio, all_ = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("__r", F.col("source").asc_nulls_last()), W.partitionBy(F.lit(1))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    s = sizes.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("__cap", (repeats * F.col("source_size")).cast("double")).withColumn("__r", F.col("__cap") / F.col("__w"))
    s = s.withColumn("__b", F.lit(float(budget)) * F.sum("source_size").over(all_)).withColumn("__wt", F.sum("__w").over(all_))
    left = (F.col("__b") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / (F.col("__wt") - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
    s = s.withColumn("__stop", left >= F.col("__r"))
    taken = lambda c: F.sum(F.when(F.col("__stop"), F.col(c)).otherwise(0.0)).over(all_)
    share = F.try_divide(F.col("__b") - taken("__cap"), F.col("__wt") - taken("__w"))
    return s.select("source", "source_size", F.when(F.col("__stop"), F.col("__cap")).otherwise(share * F.col("__w")).alias("target"))


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def tie(docs: DataFrame) -> list[Column]:
    """The order of rows of equal id and size, where they have texts to tell them apart."""
    return [F.xxhash64("text")] if "text" in docs.columns else []


def mix(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS, rows: int | None = None) -> DataFrame:
    """docs with __mix_size, __mix_source_size, __mix_target, __mix_before (words of its source before it) and
    __mix_finish (virtual finish time of its first service)."""
    n = docs.count() if rows is None else rows
    digits = max(2, math.ceil(math.log(max(n / BLOCK, 1), 16)))
    upper = max(1, digits // 2)
    d = docs if "__mix_size" in docs.columns else docs.withColumn("__mix_size", size(F.col("text")))
    d = d.withColumn("__mix_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    # rows without an id share a key: they are blocks of their own by size, between the smaller and the larger keys
    part = F.when(F.col("doc_id").isNull(), F.concat(F.lit("1"), F.lpad(F.hex("__mix_size"), 16, "0"))).when(F.col("__mix_key") > F.md5(F.lit("").cast("binary")), F.lit("2")).otherwise(F.lit("0"))
    d = d.withColumn("__mix_block", F.concat(F.substring("__mix_key", 1, digits), part)).withColumn("__mix_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    block = d.groupBy("__mix_s", "__mix_block").agg(F.sum("__mix_size").alias("__bs"), F.first("source").alias("source"))
    block = written(block, "blocks")
    over = block.groupBy("__mix_s", F.substring("__mix_block", 1, upper).alias("__mix_over")).agg(F.sum("__bs").alias("__os"), F.first("source").alias("source"))
    whole = targets(over.groupBy("__mix_s").agg(F.sum("__os").alias("source_size"), F.first("source").alias("source")).select("source", "source_size"), weights, budget, repeats)
    ahead = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    over = over.select("__mix_s", "__mix_over", ahead("__os", W.partitionBy("__mix_s").orderBy("__mix_over")).alias("__oa"))
    whole = whole.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("__mix_s"), F.col("source_size").alias("__mix_source_size"), F.col("target").alias("__mix_target"))
    block = block.withColumn("__mix_over", F.substring("__mix_block", 1, upper)).withColumn("__ba", ahead("__bs", W.partitionBy("__mix_s", "__mix_over").orderBy("__mix_block")))
    starts = block.join(over, ["__mix_s", "__mix_over"]).join(whole, "__mix_s").select("__mix_s", "__mix_block", (F.col("__oa") + F.col("__ba")).alias("__start"), "__mix_source_size", "__mix_target")
    within = W.partitionBy("__mix_s", "__mix_block").orderBy("__mix_key", "doc_id", "__mix_size", *tie(d))
    d = d.withColumn("__in", ahead("__mix_size", within)).join(starts, ["__mix_s", "__mix_block"])
    d = d.withColumn("__mix_before", F.col("__start") + F.col("__in")).withColumn("__mix_finish", F.try_divide(F.col("__mix_before") + F.col("__mix_size"), F.col("__mix_target")))
    return d.drop("__start", "__in", "__mix_s", "__mix_block", "__mix_key")


def served(before, size, source_size, target, k: int):
    """Words that the k-th service of a document gives before virtual time 1."""
    return F.greatest(F.lit(0), F.least(size, F.floor(target + 0.5).cast("long") - before - k * source_size))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document; the crossing document of each source is cut where the budget ends."""
    sized = written(table(spark, sf_dir, "documents").select("doc_id", "source", size(F.col("text")).alias("__mix_size")), "sizes")
    m = mix(sized)
    c = [F.col(f"__mix_{x}") for x in ("before", "size", "source_size", "target")]
    m = m.select("doc_id", c[1].alias("size"), c[2].alias("source_size"), c[3].alias("target"), sum((served(*c, k) for k in range(1, REPEATS)), served(*c, 0)).alias("taken"), F.col("__mix_finish"))
    return m.orderBy("__mix_finish", "doc_id").drop("__mix_finish")


def sequence(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: whole documents (a document that the budget cuts stays if at least half of it fits), as often as
    they are taken, range-sorted by virtual finish time, with the columns of docs. A document without words is kept once."""
    repeats = options.get("repeats", REPEATS)
    m, c = mix(docs, **options), [F.col(f"__mix_{x}") for x in ("before", "size", "source_size", "target")]
    whole = lambda k: (c[1] > 0) & (2 * served(*c, k) >= c[1])
    times = F.array_compact(F.array(F.when((c[1] == 0) | whole(0), F.lit(0)), *[F.when(whole(k), F.lit(k)) for k in range(1, repeats)]))
    m = m.withColumn("__mix_k", F.explode(times)).withColumn("__mix_at", F.col("__mix_finish") + F.coalesce(F.try_divide(F.col("__mix_k") * c[2], c[3]), F.lit(0.0)))
    return m.orderBy("__mix_at", "doc_id", *tie(m)).select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS DOUBLE) AS w,
    1.5::DOUBLE * sum(source_size) OVER () AS b FROM s0),
s2 AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, CAST(2 * source_size AS DOUBLE) / w AS r, sum(w) OVER () AS wt FROM s1),
s3 AS (SELECT *, (b - coalesce(sum(cap) OVER p, 0)) / (wt - coalesce(sum(w) OVER p, 0)) >= r AS stop FROM s2
    WINDOW p AS (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT source, source_size, CASE WHEN stop THEN cap ELSE (b - sum(CASE WHEN stop THEN cap ELSE 0 END) OVER ())
    / (wt - sum(CASE WHEN stop THEN w ELSE 0 END) OVER ()) * w END AS target FROM s3),
m AS (SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS t,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
    FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, size, source_size, target,
    greatest(0, least(size, t - a)) + greatest(0, least(size, t - a - source_size)) AS taken FROM m
"""

QUERIES, ORACLES = {"op5_mixing": query}, {"op5_mixing": ORACLE}
