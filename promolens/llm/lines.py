"""Line dedup with a log-template tree, in SQL functions only.

A line's path in the tree has a fixed depth: its token count, then its first three tokens. Tokens with a digit are variable
fields from the start. Behind the path the line's other tokens fall into four runs; a line of at least LONG tokens has five templates,
the line itself and the lines that leave one run variable, so that lines that differ within one run share a template.
A template that two or more documents hold recurs. All its lines are dropped but those of the document with the smallest id,
so that a passage that many documents share stays once.

Templates are hashed and written once. Their documents' least and greatest ids are found with map-side combination, and only
recurring templates are joined back to the lines: the few that very many lines hold by broadcast, the others by shuffle. Texts
meet nothing but the list of their own dropped lines.

Defined results: a null text counts as empty; blank lines stay; a null id counts as the smallest; rows with the same
id are one document and don't make a line recur; extra columns stay as they are, names starting with ``__l`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import let, table, words, written

LEAD, RUNS, LONG = 3, 4, 12
#: Templates broadcast at most, of 16 bytes each.
HOT = 4096


def templates(line: Column) -> Column:
    """The hashes of a line's templates; none for a blank line."""
    masked = F.transform(words(line), lambda t: F.when(t.rlike("[0-9]"), F.lit("<*>")).otherwise(t))

    def runs(w):
        n = F.size(w)
        cut = [LEAD + F.floor(F.lit(s) * F.greatest(n - LEAD, F.lit(0)) / RUNS).cast("int") for s in range(RUNS + 1)]
        run = lambda a, b: F.xxhash64(F.array_join(F.slice(w, a + 1, F.greatest(b - a, F.lit(0))), " "))
        return F.struct(n.alias("n"), F.xxhash64(n, F.array_join(F.slice(w, 1, LEAD), " ")).alias("path"), *[run(cut[s], cut[s + 1]).alias(f"r{s}") for s in range(RUNS)])

    def keys(x):
        one = lambda s: F.xxhash64(x["path"], F.lit(s), *[x[f"r{k}"] for k in range(RUNS) if k != s])
        return F.when(x["n"] >= LONG, F.array(*[one(s) for s in range(-1, RUNS)])).when(x["n"] > 0, F.array(one(-1))).otherwise(F.array().cast("array<bigint>"))

    return let(let(masked, runs), keys)


def dropped(docs: DataFrame) -> DataFrame:
    """(__l_id, __l_hash, __l_drop): of each document (its id and its text's hash) the numbers of the lines to drop, from 0."""
    lines = docs.select("__l_id", "__l_hash", F.posexplode(F.split("__l_text", "\n")).alias("__l_no", "__l_line"))
    made = written(lines.select("__l_id", "__l_hash", "__l_no", templates(F.col("__l_line")).alias("__l_keys")), "templates")
    keys = made.select("__l_id", "__l_hash", "__l_no", F.explode("__l_keys").alias("__l_key"))
    held = keys.groupBy("__l_key").agg(F.min("__l_id").alias("__l_first"), F.max("__l_id").alias("__l_last"), F.count(F.lit(1)).alias("__l_n"))
    recurring = written(held.where("__l_first < __l_last").drop("__l_last"), "recurring")
    # templates that hold more than a HOT-th of all keys are fewer than HOT, and their lines stay where they are
    total = recurring.agg(F.sum("__l_n")).first()[0] or 0
    is_hot = F.col("__l_n") > F.lit(total // HOT)
    hot, cold = (recurring.where(x).drop("__l_n") for x in (is_hot, ~is_hot))
    hot = F.broadcast(hot)
    hit = keys.join(hot, "__l_key").unionByName(keys.join(hot.select("__l_key"), "__l_key", "left_anti").join(cold, "__l_key"))
    return hit.where("__l_id > __l_first").groupBy("__l_id", "__l_hash").agg(F.collect_set("__l_no").alias("__l_drop"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with __l_lines (all), __l_dropped (counts) and __l_kept (the text without the dropped lines)."""
    d = docs.withColumn("__l_text", F.coalesce(F.col("text"), F.lit(""))).withColumn("__l_id", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("long")).withColumn("__l_hash", F.xxhash64("__l_text"))
    d = d.join(dropped(d.select("__l_id", "__l_hash", "__l_text")), ["__l_id", "__l_hash"], "left")
    lines = F.split("__l_text", "\n")
    rest = let(lines, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("__l_drop")), lambda i: F.get(x, i)), "\n"))
    d = d.withColumn("__l_kept", F.when(F.col("__l_drop").isNull(), F.col("__l_text")).otherwise(rest))
    return d.withColumn("__l_lines", F.size(lines)).withColumn("__l_dropped", F.coalesce(F.size("__l_drop"), F.lit(0))).drop("__l_drop", "__l_text", "__l_id", "__l_hash")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.col("__l_lines").cast("long").alias("n_lines"), F.col("__l_dropped").cast("long").alias("n_dropped"), F.sha2(F.col("__l_kept").cast("binary"), 256).alias("kept_sha256"))


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents without their dropped lines, columns as before, n_chars renewed; documents of which only blank lines would stay go."""
    d = deduplicated(docs).where((F.col("__l_dropped") == 0) | F.col("__l_kept").rlike(r"[^\x20\x09-\x0D]"))
    text = F.when(F.col("__l_dropped") == 0, F.col("text")).otherwise(F.col("__l_kept"))
    d = d.withColumn("text", text)
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col("__l_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return d.select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, id, unnest(range(len(lines))) AS no, unnest(lines) AS line FROM d),
m AS (SELECT r, id, no, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS w FROM l),
c AS (SELECT *, len(w) AS n, list_transform(range(5), lambda s: 3 + s * greatest(len(w) - 3, 0) // 4) AS cut FROM m WHERE len(w) > 0),
k AS (SELECT r, id, no, n, w, cut, unnest(CASE WHEN n >= 12 THEN [-1, 0, 1, 2, 3] ELSE [-1] END) AS s FROM c),
t AS (SELECT r, id, no, concat_ws(' ', s, n, CASE WHEN s < 0 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[1:cut[s + 1]], ' ') || ' <**> ' || array_to_string(w[cut[s + 2] + 1:n], ' ') END) AS key FROM k),
f AS (SELECT key, min(id) AS first FROM t GROUP BY key HAVING min(id) < max(id)),
x AS (SELECT r, list_sort(list(DISTINCT no)) AS gone FROM t JOIN f USING (key) WHERE id > first GROUP BY r)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_dropped,
    sha256(array_to_string(CASE WHEN gone IS NULL THEN lines ELSE list_filter(lines, lambda y, i: NOT list_contains(gone, i - 1)) END, chr(10))) AS kept_sha256
FROM d LEFT JOIN x USING (r)
"""

QUERIES, ORACLES = {"op7_lines": query}, {"op7_lines": ORACLE}
