"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark columns.

Small gradient-boosted trees are grown on a bounded sample of labelled rows; every path from a root to a node is a
candidate rule, a conjunction of comparisons. An L1-penalised logistic regression over the rules keeps a few of them,
and the kept ones become one Spark expression, so that scoring is a projection without Python, shuffle or state.

The labels are learnt from rows of folds 0 and 2 (crc32 of the id modulo 3) only. SAMPLE bounds the rows of either class that
reach the driver; the statistics are JVM expressions over whole texts, and neither label, language, source nor id is among them.

Defined results: a null text scores as an empty one; a null id is in fold 0; null labels are not learnt from; of repeated
label rows each counts. Without labels of both classes the score is the share of label 1 (0.5 without any). Extra columns
are ignored; names starting with ``__q_`` are reserved.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import LOWER, UPPER, fold, table, words

#: Rows of either label that the classifier is fitted on, at most.
SAMPLE = 8000
TREES, DEPTH, RATE, BINS = 24, 3, 0.3, 32
PENALTY, STEPS = 0.002, 400

MARKS = "!#$%&*+/<=>@[\\]^_`{|}~"


def statistics(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with a column of each statistic of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("__q_text", text).withColumn("__q_words", words(text)).withColumn("__q_lines", F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""))
    n, nw, nl = F.length("__q_text"), F.size("__q_words"), F.size("__q_lines")
    per = lambda count, of: F.when(of > 0, count / of).otherwise(0.0)
    held = lambda chars: n - F.length(F.translate("__q_text", chars, ""))
    made = {
        "log_chars": F.log1p(n.cast("double")),
        "upper": per(held(UPPER), n),
        "lower": per(held(LOWER), n),
        "digits": per(held("0123456789"), n),
        "marks": per(held(MARKS), n),
        "stops": per(held(".,;:"), n),
        "blank": per(held(" \t\n\r"), n),
        "wide": per(F.octet_length("__q_text") - n, n),
        "chars_a_word": per(n, nw),
        "words_a_line": per(nw, nl),
        "new_words": per(F.size(F.array_distinct("__q_words")), nw),
        "new_lines": per(F.size(F.array_distinct("__q_lines")), nl),
        "bars": per(F.size(F.filter("__q_words", lambda w: (w == "|") | (w == "-") | (w == "*"))), nw),
    }
    d = d.select(*[c for c in docs.columns], *[v.cast("double").alias(f"__q_{k}") for k, v in made.items()])
    return d, [f"__q_{k}" for k in made]


def _tree(x: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, path: tuple, out: list, pred: np.ndarray) -> None:
    """Grow one regression tree over binned columns; each node's path goes to out, leaf values to pred."""
    if path:
        out.append(path)
    best = (1e-6, None, None)
    if len(path) < DEPTH and len(rows) >= 20:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        for j, e in enumerate(edges):
            if not len(e):
                continue
            b = x[rows, j]
            cg, ch, cn = (np.bincount(b, weights=v, minlength=len(e) + 1).cumsum()[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
            gain = cg**2 / (ch + 1) + (total_g - cg) ** 2 / (total_h - ch + 1) - total_g**2 / (total_h + 1)
            gain[(cn < 5) | (len(rows) - cn < 5)] = 0
            if (k := int(gain.argmax())) >= 0 and gain[k] > best[0]:
                best = (gain[k], j, k)
    if best[1] is None:
        pred[rows] = RATE * g[rows].sum() / (h[rows].sum() + 1)
        return
    _, j, k = best
    low = x[rows, j] <= k
    _tree(x, edges, g, h, rows[low], (*path, (j, "<=", float(edges[j][k]))), out, pred)
    _tree(x, edges, g, h, rows[~low], (*path, (j, ">", float(edges[j][k]))), out, pred)


def holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, op, t in rule:
        out &= x[:, j] <= t if op == "<=" else x[:, j] > t
    return out


def simplified(rule: tuple) -> tuple:
    """The same conjunction with one bound of each kind for each statistic, in fixed order."""
    kept: dict = {}
    for j, op, t in rule:
        kept[j, op] = t if (j, op) not in kept else (min if op == "<=" else max)(kept[j, op], t)
    return tuple(sorted((j, op, t) for (j, op), t in kept.items()))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[tuple, float]]]:
    """Intercept and (rule, weight) pairs."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return base, []
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T, strict=True)]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    z, paths = np.full(len(y), base), []
    for _ in range(TREES):
        p, add = 1 / (1 + np.exp(-z)), np.zeros(len(y))
        _tree(binned, edges, y - p, p * (1 - p), np.arange(len(y)), (), paths, add)
        z += add
    seen, rules, columns = set(), [], []
    for r in dict.fromkeys(map(simplified, paths)):
        c = holds(r, x)
        if 0 < c.sum() < len(y) and (key := c.tobytes()) not in seen:
            seen.add(key)
            rules.append(r)
            columns.append(c)
    a = np.column_stack(columns).astype(np.float64)
    # accelerated proximal gradient; the intercept goes unpenalised
    one = np.hstack([np.ones((len(y), 1)), a])
    step = 4 * len(y) / np.linalg.norm(one, 2) ** 2
    w = v = np.zeros(one.shape[1])
    w[0] = v[0] = base
    t = 1.0
    for _ in range(STEPS):
        new = v - step * (one.T @ (1 / (1 + np.exp(-(one @ v))) - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * PENALTY, 0)
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        w, v = new, new + (last - 1) / t * (new - w)
    return float(w[0]), [(r, float(c)) for r, c in zip(rules, w[1:], strict=True) if abs(c) > 1e-9]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, list[tuple[tuple, float]]]:
    """Fit on at most ``sample`` labelled rows of each label, those with the least hash of their id."""
    known = labels.select(F.col("doc_id").alias("__q_id"), F.col("quality").cast("int").alias("__q_y")).where("__q_id IS NOT NULL AND __q_y IN (0, 1)").where(fold(F.col("__q_id"), 3) != 1)
    picked = None
    for y in (0, 1):
        part = known.where(F.col("__q_y") == y).orderBy(F.xxhash64("__q_id"), "__q_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    # the sample is bounded by its limit, whatever the tables hold
    hit = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__q_id"))
    stats, names = statistics(hit)
    got = stats.select("__q_id", "__q_y", *names).toPandas().sort_values(["__q_id", "__q_y", *names], kind="stable")
    return fit(got[names].to_numpy(float), got["__q_y"].to_numpy(float))


def compiled(names: list[str], model: tuple[float, list[tuple[tuple, float]]]) -> Column:
    z = F.lit(model[0])
    for rule, weight in model[1]:
        test = F.lit(True)
        for j, op, t in rule:
            test &= F.col(names[j]) <= t if op == "<=" else F.col(names[j]) > t
        z += F.when(test, F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, model: tuple[float, list[tuple[tuple, float]]], name: str = "score") -> DataFrame:
    """docs and the probability of label 1."""
    stats, names = statistics(docs)
    return stats.withColumn(name, compiled(names, model)).drop(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier takes for label 1; their columns unchanged.

    An array of the score, if it is high enough, is exploded: a filter would take the whole ensemble in and compute its statistics once for each use."""
    found = score(docs, learn(docs, labels), "__q_score")
    return found.select(*[f"`{c}`" for c in docs.columns], F.explode(F.filter(F.array("__q_score"), lambda s: s >= 0.5)).alias("__q_score")).drop("__q_score")


QUERIES, ORACLES = {"op6_quality": query}, {}
