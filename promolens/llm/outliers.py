"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates for each language and source.

Every whole text gives counts, and the counts a vector of four transformed statistics in units of 1/SCALE, whole numbers: the logarithm of the
mean word length, the logarithm of 1 + 20 symbols a word, the share of repeated lines and the share of words in repeated 3-word windows.
Length itself is no fault and takes no part. A language and source with at least LEAST documents is a group; smaller ones share a group of their
language, and those of languages that still have fewer are judged by the estimate of all documents; fewer than LEAST documents in all get no
verdict (kept).

A group's estimate is found from two starts (medians and median deviations; means and covariances of all) by concentration steps: distances
are counted in steps of 1/FINE, the nearest buckets that hold SHARE of the group give the next mean and covariance, until no group changes
(STEPS at most); the start with the smaller determinant wins, and documents within the 97.5 % distance give the reweighted estimate. FLOORS are
added to the variances, as statistics that most documents don't show (symbols, say) have none. A document is rejected if its squared Mahalanobis
distance exceeds the chi-square quantile CUTOFF. Sums are of whole numbers, so that results don't depend on the order of rows.

A concentration step is one pass over the written statistics that gathers at most 64 * FINE + 1 rows for each group, start and task;
no group meets in one task. Estimates meet the documents by broadcast if they are at most FEW, which is counted, else by a join that adaptive
execution may split.

Defined results: a null text is empty and fails the base rules (fewer than 50 words); null languages and sources are values of their own; repeated
rows and ids are documents each; extra columns are ignored; an empty table gives no rows. Lines and words are compared as they are; 3-word
windows by a 64-bit hash within their text.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.llm.common import let, table, words, written

SCALE, FINE, FAR, STEPS, SHARE, LEAST, CUTOFF, FEW = 1024, 64, 64, 10, 0.75, 100, 0.9999, 100_000
#: Least standard deviations of the four statistics: a fifth of a word's length, a symbol a hundred words, an eighth of the lines, a tenth of the words.
FLOORS = (0.2, 0.2, 0.125, 0.1)
D = len(FLOORS)
MIN_WORDS, MAX_REPEATED = 50, 50
X = [f"x{i}" for i in range(D)]
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def _chi2(x: float, d: int) -> float:
    """The chi-square distribution function of an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))


def quantile(p: float, d: int = D) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, d) < p else (low, mid)
    return low


def consistency(p: float) -> float:
    """What the covariance of the nearest share p of a normal sample is to be multiplied by."""
    return p / _chi2(quantile(p), D + 2)


def repeated_words(w: Column) -> Column:
    """How many words of an array stand in 3-word windows that occur twice or more in it, the first included."""
    n = F.size(w)
    windows = F.transform(F.slice(w, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"])), lambda i: i.isNotNull())
        new = lambda p: F.aggregate(F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))), F.lit(0).cast("long"), lambda a, b: a + b)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(F.sort_array(let(at, twice)), new))

    return let(windows, covered)


def counts(text: Column) -> Column:
    """struct<n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words>, all long."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = lambda c: c.cast("long")

    def made(w: Column) -> Column:
        without = lambda chars: F.length(F.translate(t, chars, ""))
        line = let(lines, lambda x: F.struct(n(F.size(x)).alias("n"), n(F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
        return let(line, lambda x: F.struct(
            n(F.size(w)).alias("n_words"), n(without(" \t\n\x0b\f\r")).alias("word_chars"), n(F.length(t) - without("#*$%&|<>")).alias("n_symbols"),
            x["n"].alias("n_lines"), x["dup"].alias("n_dup_lines"), repeated_words(w).alias("n_repeat_words")))

    return let(words(t), made)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, the counts, base_failed, x0..x3); the statistics of documents that fail the base rules are null."""
    one = docs.select("doc_id", "lang", "source", F.explode(F.array(counts(F.col("text")))).alias("c")).select("doc_id", "lang", "source", "c.*")
    one = one.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    n = F.col("n_words")
    raw = [F.log(F.col("word_chars") / n), F.log1p(20 * F.col("n_symbols") / n), F.col("n_dup_lines") / F.col("n_lines"), F.col("n_repeat_words") / n]
    return one.select(*one.columns, *[F.when(~F.col("base_failed"), F.floor(SCALE * x + 0.5)).alias(k) for k, x in zip(X, raw, strict=True)])


ALL = '{"level":2}'


def groups(stats: DataFrame) -> DataFrame:
    """(lang, source, gid, size): by which group's estimate each language and source is judged, and how many documents that group has."""
    n = stats.where("NOT base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("small", F.col("n") < LEAST)
    by_lang = n.where("small").groupBy("lang").agg(F.sum("n").alias("pooled")).withColumnRenamed("lang", "l")
    n = n.join(by_lang, F.col("small") & F.col("lang").eqNullSafe(F.col("l")), "left").drop("l")
    n = n.withColumn("level", F.when(~F.col("small"), 0).when(F.col("pooled") >= LEAST, 1).otherwise(2))
    n = n.withColumn("gid", F.to_json(F.struct("level", F.when(F.col("level") < 2, F.col("lang")).alias("lang"), F.when(F.col("level") < 1, F.col("source")).alias("source"))))
    every = n.agg(F.sum("n").alias("every"))  # one row
    size = n.groupBy("gid").agg(F.sum("n").alias("own")).crossJoin(F.broadcast(every)).withColumn("size", F.when(F.col("gid") == ALL, F.col("every")).otherwise(F.col("own")))
    return n.select("lang", "source", "gid").join(size.where(F.col("size") >= LEAST).select("gid", "size"), "gid")


def _met(own: DataFrame, model: DataFrame, few: bool) -> DataFrame:
    """The statistics with the columns that ``model`` has for their group."""
    return own.join(F.broadcast(model) if few else model, "gid")


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("c"), *[F.sum(x).alias(f"s_{x}") for x in X], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s_{i}{j}") for i, j in PAIRS]]


SUMS = ["c", *[f"s_{x}" for x in X], *[f"s_{i}{j}" for i, j in PAIRS]]


def _moments(sums: DataFrame, factor: float) -> DataFrame:
    """Means m_i and covariances c_ij of sums, the floors added."""
    c = F.col("c").cast("double")
    cov = lambda i, j: (F.col(f"s_{i}{j}") - F.col(f"s_x{i}") * (F.col(f"s_x{j}") / c)) / c * factor + ((FLOORS[i] * SCALE) ** 2 if i == j else 0.0)
    return sums.withColumns({f"m_{i}": F.col(f"s_x{i}") / c for i in range(D)} | {f"c_{i}{j}": cov(i, j) for i, j in PAIRS})


def _whitened(m: DataFrame) -> DataFrame:
    """w_ij, the inverse of the covariance's lower Cholesky factor, and logdet."""
    for i in range(D):
        for j in range(i + 1):
            rest = reduce(lambda a, b: a - b, [F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j)], F.col(f"c_{i}{j}"))
            m = m.withColumn(f"l_{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}{j}"))
    for j in range(D):
        m = m.withColumn(f"w_{j}{j}", 1 / F.col(f"l_{j}{j}"))
        for i in range(j + 1, D):
            m = m.withColumn(f"w_{i}{j}", -reduce(lambda a, b: a + b, [F.col(f"l_{i}{k}") * F.col(f"w_{k}{j}") for k in range(j, i)]) / F.col(f"l_{i}{i}"))
    logdet = 2 * reduce(lambda a, b: a + b, [F.log(f"l_{i}{i}") for i in range(D)])
    return m.withColumn("logdet", logdet).drop(*[f"l_{i}{j}" for i, j in PAIRS], *[f"c_{i}{j}" for i, j in PAIRS])


def _distance2() -> Column:
    z = lambda i: reduce(lambda a, b: a + b, [F.col(f"w_{i}{j}") * (F.col(f"x{j}") - F.col(f"m_{j}")) for j in range(i + 1)])
    return reduce(lambda a, b: a + b, [F.pow(z(i), F.lit(2.0)) for i in range(D)])


MODEL = [*[f"m_{i}" for i in range(D)], *[f"w_{i}{j}" for i, j in PAIRS], "logdet"]


def estimates(own: DataFrame, few: bool) -> DataFrame:
    """(gid, the model's columns): the reweighted estimate of each group of ``own`` (gid, size, x0..x3). few: whether models are broadcast."""
    middle = written(own.groupBy("gid", "size").agg(*[F.percentile(x, F.lit(0.5)).alias(f"m_{i}") for i, x in enumerate(X)]), "medians")
    off = _met(own.drop("size"), middle, few)
    spread = off.groupBy("gid", "size", *[f"m_{i}" for i in range(D)]).agg(*[F.percentile(F.abs(F.col(x) - F.col(f"m_{i}")), F.lit(0.5)).alias(f"a_{i}") for i, x in enumerate(X)])
    diagonal = {f"c_{i}{j}": F.pow(1.4826 * F.col(f"a_{i}"), F.lit(2.0)) + (FLOORS[i] * SCALE) ** 2 if i == j else F.lit(0.0) for i, j in PAIRS}
    nothing = {k: F.lit(0).cast("long") for k in SUMS}
    robust = spread.withColumns(diagonal).withColumns(nothing).withColumn("start", F.lit(0))
    plain = _moments(own.groupBy("gid", "size").agg(*_sums()), 1.0).withColumn("start", F.lit(1))
    keys = ["gid", "size", "start", *SUMS, *MODEL]
    one = lambda df: df.repartition(1) if few else df  # noqa: E731  a small table is one file
    model = written(one(_whitened(robust).select(*keys).unionByName(_whitened(plain).select(*keys))), "starts")

    ordered = W.partitionBy("gid", "start").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    was = F.xxhash64(*SUMS)
    for _ in range(STEPS):
        met = _met(own.drop("size"), model.select("gid", "size", "start", was.alias("was"), *MODEL), few)
        bucket = F.least(F.floor(FINE * F.sqrt(_distance2())), F.lit(FAR * FINE))
        counted = met.withColumn("bucket", bucket).groupBy("gid", "start", "bucket").agg(F.first("size").alias("size"), F.first("was").alias("was"), *_sums())
        near = counted.withColumn("before", F.coalesce(F.sum("c").over(ordered), F.lit(0))).where(F.col("before") < F.ceil(SHARE * F.col("size")))
        sums = near.groupBy("gid", "start").agg(F.first("size").alias("size"), F.first("was").alias("was"), *[F.sum(k).alias(k) for k in SUMS])
        new = _whitened(_moments(sums.withColumn("same", F.col("was") == was), consistency(SHARE)))
        model = written(one(new.select(*keys, "same")), "concentrated")
        if not model.where("NOT same").limit(1).count():
            break

    first = W.partitionBy("gid").orderBy("logdet", "start")
    best = model.withColumn("k", F.row_number().over(first)).where("k = 1").select("gid", *MODEL)
    inner = _met(own.drop("size"), best, few).where(_distance2() <= quantile(0.975))
    return written(one(_whitened(_moments(inner.groupBy("gid").agg(*_sums()), consistency(0.975))).select("gid", *MODEL)), "estimates")


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, the counts, base_failed, gid, distance2, kept) of every document; distance2 is null without a group's estimate."""
    stats = written(statistics(docs), "statistics")
    g = written(groups(stats).withColumnsRenamed({"lang": "g_lang", "source": "g_source"}), "groups")
    few = g.count() <= FEW
    same = lambda small: stats["lang"].eqNullSafe(small["g_lang"]) & stats["source"].eqNullSafe(small["g_source"])
    small = F.broadcast(g) if few else g
    good = stats.where("NOT base_failed")
    own = good.join(small, same(small)).where(F.col("gid") != ALL).select("gid", "size", *X)
    if (rest := g.where(F.col("gid") == ALL).select("size").head()) is not None:
        own = own.unionByName(good.select(F.lit(ALL).alias("gid"), F.lit(rest["size"]).alias("size"), *X))
    own = written(own, "grouped")
    m = g.drop("size").join(estimates(own, few), "gid")
    m = F.broadcast(m) if few else m
    met = stats.join(m, ~stats["base_failed"] & same(m), "left").withColumn("distance2", _distance2())
    return met.withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= quantile(CUTOFF))).drop("g_lang", "g_source", *MODEL, *X)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# --- the same in SQL, precisions by cofactors -----------------------------------------------------------------------


def _det(rows: list[int], cols: list[int]) -> str:
    """The determinant of the covariance's rows and columns."""
    entry = lambda i, j: f"c_{max(i, j)}{min(i, j)}"
    if len(rows) == 1:
        return entry(rows[0], cols[0])
    return "(" + " ".join(f"{'-' if k % 2 else '+'} {entry(rows[0], c)} * {_det(rows[1:], cols[:k] + cols[k + 1:])}" for k, c in enumerate(cols)) + ")"


def _sql() -> str:
    n = range(D)
    others = lambda i: [k for k in n if k != i]
    sums = "count(*)::BIGINT AS c, " + ", ".join(f"sum(x{i})::BIGINT AS s_{i}" for i in n) + ", " + ", ".join(f"sum(x{i} * x{j})::BIGINT AS s_{i}{j}" for i, j in PAIRS)
    again = "sum(c)::BIGINT AS c, " + ", ".join(f"sum(s_{i})::BIGINT AS s_{i}" for i in n) + ", " + ", ".join(f"sum(s_{i}{j})::BIGINT AS s_{i}{j}" for i, j in PAIRS)
    moments = lambda factor: ", ".join(f"s_{i} / c::DOUBLE AS m_{i}" for i in n) + ", " + ", ".join(f"(s_{i}{j} - s_{i} * (s_{j} / c::DOUBLE)) / c * {factor!r} + {(FLOORS[i] * SCALE) ** 2 if i == j else 0.0!r} AS c_{i}{j}" for i, j in PAIRS)
    keep = ", ".join(f"m_{i}" for i in n)
    precise = f"{keep}, ln(det) AS logdet, " + ", ".join(f"{'-' if (i + j) % 2 else ''}{_det(others(i), others(j))} / det AS p_{i}{j}" for i, j in PAIRS)
    model = lambda inner: f"(SELECT * EXCLUDE (det), {precise} FROM (SELECT *, {_det([*n], [*n])} AS det FROM ({inner})))".replace("* EXCLUDE (det), " + keep, "gid, start, " + keep)
    far = " + ".join(f"{1 if i == j else 2} * p_{i}{j} * (x{i} - m_{i}) * (x{j} - m_{j})" for i, j in PAIRS)
    q = f"""WITH RECURSIVE t AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l, row_number() OVER () AS r FROM t),
g AS (SELECT r, k, count(*) OVER (PARTITION BY r, w[k], w[k + 1], w[k + 2]) AS n FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM w)),
h AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([k, k + 1, k + 2]) AS p FROM g WHERE n > 1) GROUP BY r),
b AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN h USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM b),
s AS (SELECT *, floor({SCALE} * ln(word_chars / n_words) + 0.5)::BIGINT AS x0, floor({SCALE} * ln(1 + 20 * n_symbols / n_words) + 0.5)::BIGINT AS x1, floor({SCALE} * (n_dup_lines / n_lines) + 0.5)::BIGINT AS x2, floor({SCALE} * (n_repeat_words / n_words) + 0.5)::BIGINT AS x3 FROM f WHERE NOT base_failed),
n1 AS (SELECT lang, source, count(*) AS n FROM s GROUP BY ALL),
n2 AS (SELECT *, CASE WHEN n >= {LEAST} THEN 0 WHEN sum(CASE WHEN n < {LEAST} THEN n ELSE 0 END) OVER (PARTITION BY lang) >= {LEAST} THEN 1 ELSE 2 END AS level FROM n1),
n3 AS (SELECT lang, source, n, {{'level': level, 'lang': CASE WHEN level < 2 THEN lang END, 'source': CASE WHEN level < 1 THEN source END}} AS gid FROM n2),
sizes AS (SELECT gid, CASE WHEN gid.level = 2 THEN (SELECT count(*) FROM s) ELSE sum(n) END AS size FROM n3 GROUP BY gid),
d AS (SELECT s.*, gid, size FROM s JOIN n3 ON s.lang IS NOT DISTINCT FROM n3.lang AND s.source IS NOT DISTINCT FROM n3.source JOIN sizes USING (gid) WHERE gid.level < 2
    UNION ALL SELECT s.*, gid, size FROM s, sizes WHERE gid.level = 2 AND size >= {LEAST}),
mid AS (SELECT gid, {", ".join(f"quantile_cont(x{i}, 0.5) AS m_{i}" for i in n)} FROM d GROUP BY gid),
mad AS (SELECT gid, {keep}, {", ".join(f"quantile_cont(abs(x{i} - m_{i}), 0.5) AS a_{i}" for i in n)} FROM d JOIN mid USING (gid) GROUP BY ALL),
e0 AS ({model("SELECT gid, 0 AS start, " + keep + ", " + ", ".join((f"pow(1.4826 * a_{i}, 2) + {(FLOORS[i] * SCALE) ** 2!r}" if i == j else "0.0::DOUBLE") + f" AS c_{i}{j}" for i, j in PAIRS) + " FROM mad")}
    UNION ALL {model("SELECT gid, 1 AS start, " + moments(1.0) + f" FROM (SELECT gid, {sums} FROM d GROUP BY gid)")}),
"""
    for k in range(1, STEPS + 1):
        q += f"""k{k} AS (SELECT gid, start, bucket, any_value(size) AS size, {sums} FROM (SELECT d.*, start, least(floor({FINE} * sqrt({far})), {FAR * FINE}) AS bucket FROM d JOIN e{k - 1} USING (gid)) GROUP BY gid, start, bucket),
e{k} AS MATERIALIZED ({model("SELECT gid, start, " + moments(consistency(SHARE)) + f" FROM (SELECT gid, start, {again} FROM (SELECT *, coalesce(sum(c) OVER (PARTITION BY gid, start ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM k{k}) WHERE earlier < ceil({SHARE} * size) GROUP BY gid, start)")}),
"""
    return q + f"""best AS (SELECT * FROM e{STEPS} QUALIFY row_number() OVER (PARTITION BY gid ORDER BY logdet, start) = 1),
final AS ({model("SELECT gid, 0 AS start, " + moments(consistency(0.975)) + f" FROM (SELECT gid, {sums} FROM d JOIN best USING (gid) WHERE {far} <= {quantile(0.975)!r} GROUP BY gid)")}),
own AS (SELECT s.*, gid FROM s JOIN n3 ON s.lang IS NOT DISTINCT FROM n3.lang AND s.source IS NOT DISTINCT FROM n3.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, false AS base_failed, coalesce({far} <= {quantile(CUTOFF)!r}, true) AS kept FROM own LEFT JOIN final USING (gid)
UNION ALL SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, false FROM f WHERE base_failed"""


QUERIES, ORACLES = {"op13_outliers": query}, {"op13_outliers": _sql()}
