"""Approximate nearest neighbours: a robust-pruned directed graph for each shard, searched by beams.

Vectors are dealt into shards of about SHARD by the hash of their ids and coordinates, each shard's graph is built in one task of bounded
memory, and every shard is searched by all queries, which are broadcast in blocks of bounded size. Points are inserted in a seeded order, a batch at a
time: a greedy beam search from the medoid proposes neighbours, and robust pruning keeps the nearest, drops the
candidates that lie ALPHA times nearer to it than to the point, and goes on, so that kept edges point in different
directions. Edges are also made backwards, pruned where they are too many. Equal vectors of a shard are one graph
node with the k + 1 smallest of its ids: others of its ids can't be among the k nearest, as ties go to the smaller.

The index is a table with a row for each shard; distances of what a beam finds are computed again in double precision.

Defined results: null, empty or zero vectors and those with null or non-finite components take no part, nor do null ids; vectors
of another length than the query's are no candidates; rows that share an id are one candidate, the nearest of them.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.llm.common import table, written

SHARD, DEGREE, BEAM, ALPHA, BATCH = 4096, 32, 64, 1.2, 256
#: Bytes of the queries that are broadcast at a time.
ASKED = 1 << 26
K, EVERY = 10, 100


def squared(x: np.ndarray, a: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row of a to its ids' rows of x; infinite where the id is negative."""
    d = np.empty(ids.shape, x.dtype)
    step = max(1, (1 << 22) // max(1, ids.shape[1] * x.shape[1]))  # rows of a at a time: 16 MB of coordinates
    for at in range(0, len(ids), step):
        v, b = x[np.maximum(ids[at : at + step], 0)], a[at : at + step]
        d[at : at + step] = np.einsum("qkd,qkd->qk", v, v) - 2 * np.einsum("qkd,qd->qk", v, b) + np.einsum("qd,qd->q", b, b)[:, None]
    return np.where(ids < 0, np.inf, np.maximum(d, 0))


def search(x: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The beams (ids, squared distances), nearest first; -1 fills them up. All queries step together, ``width`` nodes a step."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    ids = np.full((n, beam), -1)
    ids[:, 0] = start
    dist, done = squared(x, queries, ids), np.zeros((n, beam), bool)
    seen = np.zeros((n, len(x) + 1), bool)  # the last column takes the fillers
    seen[:, start] = True
    active = np.arange(n)
    while len(active):
        open_ = np.where(done[active] | (ids[active] < 0), np.inf, dist[active])
        pick = np.argsort(open_, axis=1, kind="stable")[:, :width]
        chosen = np.take_along_axis(open_, pick, 1) < np.inf
        live = chosen.any(1)
        active, pick, chosen = active[live], pick[live], chosen[live]
        if not len(active):
            break
        at = rows[: len(active)]
        done[active[:, None], pick] |= chosen
        new = edges[np.where(chosen, ids[active[:, None], pick], 0)]
        new = np.where(chosen[:, :, None], new, -1).reshape(len(active), -1)
        new = np.where(seen[active[:, None], new], -1, new)
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        seen[active[:, None], new] = True
        seen[:, -1] = False
        all_ids = np.hstack([ids[active], new])
        all_dist = np.hstack([dist[active], squared(x, queries[active], new)])
        all_done = np.hstack([done[active], np.zeros(new.shape, bool)])
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[active], dist[active], done[active] = all_ids[at, best], all_dist[at, best], all_done[at, best]
    return ids, dist


def pruned(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of each point's candidates (-1: none) to ``degree`` edges."""
    cand = np.where(cand == points[:, None], -1, cand)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    dist = squared(x, x[points], cand)
    out, rows = np.full((len(points), degree), -1), np.arange(len(points))
    for k in range(degree):
        best = dist.argmin(1)
        ok = dist[rows, best] < np.inf
        if not ok.any():
            break
        kept = np.where(ok, cand[rows, best], -1)
        out[:, k] = kept
        near = squared(x, x[np.maximum(kept, 0)], cand)
        dist[(alpha * alpha * near <= dist) & ok[:, None]] = np.inf
        dist[rows, best] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 7) -> tuple[np.ndarray, int]:
    """(edges, medoid) of the graph over the rows of x."""
    n = len(x)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, degree), -1)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 0
    while at < n:
        batch = order[at : at + min(BATCH, max(1, at))]
        at += len(batch)
        found, _ = search(x, edges, start, x[batch], beam)
        # points of a batch don't see each other in the graph; they are candidates of each other all the same
        near = np.argsort(squared(x, x[batch], np.broadcast_to(batch, (len(batch), len(batch)))), axis=1, kind="stable")[:, : 1 + degree // 2]
        edges[batch] = pruned(x, batch, np.hstack([found, edges[batch], batch[near]]), degree, alpha)
        to, from_ = edges[batch].ravel(), np.repeat(batch, degree)
        to, from_ = to[keep := to >= 0], from_[keep]
        by = np.argsort(to, kind="stable")
        to, from_ = to[by], from_[by]
        ends, first, count = np.unique(to, return_index=True, return_counts=True)
        back = np.full((len(ends), count.max() if len(ends) else 0), -1)
        back[np.repeat(np.arange(len(ends)), count), np.arange(len(to)) - np.repeat(first, count)] = from_
        for k in range(0, len(ends), 512):
            e = ends[k : k + 512]
            edges[e] = pruned(x, e, np.hstack([edges[e], back[k : k + 512]]), degree, alpha)
    return edges, start


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, in double precision."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.coalesce(~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False)) & F.exists(v, lambda c: c != 0)
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine).select("vec_id", v.alias("v"))


def centred(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """In single precision, which far from the origin would not tell neighbours apart."""
    return (x - middle).astype(np.float32)


def index(vectors: DataFrame, k: int = K, shard: int = SHARD) -> DataFrame:
    """(shard, dim, start, x, edges, ids, counts): the graphs, one row each: distinct vectors in double precision, edges and ids laid flat in bytes."""
    vectors = written(vectors.distinct(), "vectors")  # rows that repeat an id and a vector are one
    n = vectors.count()
    # dealt by id and vector, so that rows that share an id are not one shard's
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, -(-n // shard)))).cast("int")).withColumn("dim", F.size("v"))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        x, node = np.unique(np.stack(pdf["v"].to_numpy()), axis=0, return_inverse=True)
        node, ids = node.ravel(), pdf["vec_id"].to_numpy()
        by = np.lexsort((ids, node))
        groups = [np.unique(g)[: k + 1] for g in np.split(ids[by], np.flatnonzero(np.diff(node[by])) + 1)]
        edges, start = build(centred(x, x.mean(0)))
        flat = np.concatenate(groups).astype(np.int64), np.array([len(g) for g in groups], np.int32)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "dim": [x.shape[1]], "start": [start], "x": [x.tobytes()], "edges": [edges.astype(np.int32).tobytes()], "ids": [flat[0].tobytes()], "counts": [flat[1].tobytes()]})

    return dealt.groupBy("shard", "dim").applyInPandas(work, "shard int, dim int, start int, x binary, edges binary, ids binary, counts binary")


def nearest(graphs: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM, asked: int = ASKED) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest that the shards' beams find. graphs: a written index.

    Queries are broadcast in blocks of at most ``asked`` bytes of coordinates; each block meets the graphs where they are stored, so no graph is shuffled."""
    spark, found = graphs.sparkSession, []
    q = written(queries.select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim")), "queries")
    sizes = q.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each length of vectors
    for dim, n in sorted((r.dim, r.n) for r in sizes):
        blocks = max(1, -(-n * dim * 8 // asked))
        for block in range(blocks):
            part = q.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)).select("query_id", "v").toPandas()
            if len(part):
                sent = spark.sparkContext.broadcast((part["query_id"].to_numpy(np.int64), np.stack(part["v"].to_numpy())))
                hits = graphs.where(F.col("dim") == dim).mapInPandas(_searcher(sent, k, beam), "query_id long, vec_id long, score double")
                found.append(written(_best(hits, k), "hits"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return _best(reduce(DataFrame.unionByName, [f.drop("rank") for f in found]), k)


def _best(hits: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy("score", "vec_id")
    hits = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(sent, k: int, beam: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owners, asked = sent.value
        for pdf in frames:
            for g in pdf.itertuples():
                x = np.frombuffer(g.x).reshape(-1, g.dim)
                edges = np.frombuffer(g.edges, np.int32).reshape(len(x), -1)
                ids = np.split(np.frombuffer(g.ids, np.int64), np.cumsum(np.frombuffer(g.counts, np.int32))[:-1])
                middle = x.mean(0)
                small = centred(x, middle)
                for at in range(0, len(asked), BATCH):
                    hits, _ = search(small, edges, g.start, centred(asked[at : at + BATCH], middle), beam)
                    out = []
                    for i, h in enumerate(hits, at):
                        h = h[h >= 0]
                        d = np.sqrt(((x[h] - asked[i]) ** 2).sum(1))
                        out += [(owners[i], v, s) for s, v in sorted((s, v) for s, j in zip(d, h, strict=True) for v in ids[j] if v != owners[i])[:k]]
                    yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return work


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(written(index(vectors), "graphs"), vectors.where(F.col("vec_id") % EVERY == 0)).orderBy("query_id", "rank")


QUERIES, ORACLES = {"op9_graph": query}, {}
