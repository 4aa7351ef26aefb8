"""N-gram Jaccard join with a token-group matrix.

A document is the set of its distinct word shingles. Documents link when their sets' Jaccard likeness reaches a bound;
the join returns each document's component. Every pair that links is covered, without comparing all pairs:

1. Sketches. Documents with equal sets become one node, the smallest id. Shingles are ordered by how frequent they are (an estimate
   from all documents; any order is right), then by hash; two sets that link share s(n) shingles, n being the smaller
   size, among the first n - ceil(bound * n) + s(n) of each, the prefix; s(n) = 1 + ceil(bound * n) / STRIDE, rounded down.
2. Groups. Nodes are partitioned by several min-hashes, large parts in chunks, and each chunk gives a spanning forest of its
   links, verified on whole sets; their components are clusters. So a family of near copies, however large, becomes one or
   a few clusters. Groups are a cluster's nodes, or nodes with equal min-hashes that link with nothing, in chunks.
3. Matrix. Each group stores the union of its prefixes; the matrix has a row for a token and a group. Groups of
   other clusters that share enough tokens are candidates; the others can't overlap as a link needs.
4. Opening. The nodes of the smaller cluster's group query the group: if a query's overlap with the union of the group's whole sets is below
   what a link needs, the group stays closed; else the query is compared with each of its members. A link joins the two clusters.

No step gathers a token's, a family's or a component's documents in one task: chunks are bounded, the rest are sums.
Texts are sent only for nodes that have company (a broadcast of their ids if they are few, a shuffle join otherwise).

Defined results: null, empty or blank texts have no shingles and link with nothing; a text with fewer words than a shingle is one
shingle; a null id counts as the smallest id and comes back as null; rows with the same id are one vertex, each with its own
n_shingles. Shingles are compared by 64-bit hash. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import LOWER, UPPER, table, written

NULL_ID = -(1 << 63)
#: Rounds of grouping; nodes in a group; queries that open a group in one task.
ROUNDS, GROUP, OPENERS = 2, 256, 1024
#: The bits of a group's key that tell how large its cluster is.
LEVELS = 63
#: A set's prefix is longer by one shingle for so many that a link needs; linked sets share as many more.
STRIDE = 40
#: Shingles that are ordered last for being frequent, at most (1 MB); they only shape the order.
FREQUENT = 1 << 17
#: Ids that are broadcast at most (about 16 MB); beyond, texts are shuffled to them.
IDS = 400_000
#: Hashed shingles that a task counts at a time.
COUNTED = 1 << 22

#: Bytes of text that are hashed at a time; the base of the hash, any odd number.
BLOCK, BASE = 1 << 20, 0xD1342543DE82EF95

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_INSIDE = np.array([not _SPACE.match(bytes([x])) for x in range(256)])
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([x])) for x in range(256)], np.uint64)


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit hashes for each seed."""
    x = h ^ np.uint64(int(_MIX[seed % 4]) * (seed + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(32))) * _MIX[(seed + 1) % 4]
    x = (x ^ (x >> np.uint64(29))) * _MIX[(seed + 2) % 4]
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as many as were asked for so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            some = np.full(max(n, 1 << 16), BASE, np.uint64), np.full(max(n, 1 << 16), pow(BASE, -1, 1 << 64), np.uint64)
            for x in some:
                x[0] = 1
                np.multiply.accumulate(x, out=x)
            cls.up, cls.down = some
        return cls.up[:n], cls.down


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order: sums of random numbers for its bytes, times powers for their places.

    Taken from running sums over a block of text, which ends at white space, so that memory is bounded but for longer words."""
    out, at = [], 0
    with np.errstate(over="ignore"):
        while at < len(text):
            end = at + BLOCK
            if end < len(text):
                end = found.start() if (found := _SPACE.search(text, end)) else len(text)
            block = np.frombuffer(text, np.uint8, min(end, len(text)) - at, at)
            inside = np.concatenate(([False], _INSIDE[block], [False]))
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            start, stop = edges[::2], edges[1::2]
            up, down = Powers.of(len(block))
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(_BYTES[block] * up, out=sums[1:])
            out.append(mixed((sums[stop] - sums[start]) * down[start], 0))
            at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; its words lie between the six ASCII white-space characters."""
    h = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not len(h):
        return h
    n, out = max(1, len(h) - width + 1), np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(h))):
            out = out * _MIX[1] + h[k : k + n]
    return np.unique(mixed(out + np.uint64(min(width, len(h))), 0))


def need(n, percent: int):
    """The least overlap of a link for the larger set's size."""
    return -(-percent * n // 100)


def shared(n: int, percent: int) -> int:
    """How many shingles the prefixes of linked sets share, n being the smaller set's size."""
    return 1 + need(n, percent) // STRIDE


def linked(a: int, b, both, percent: int):
    return 100 * both >= percent * (a + b - both)


def frequent(docs: DataFrame, width: int, most: int = FREQUENT) -> np.ndarray:
    """The most frequent shingles of all documents, the rarer first; a task reports those that it meets three times in a few thousand documents."""

    def work(batches: Iterator[pa.RecordBatch]):
        held, size = [], 0

        def out():
            u, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            keep = n >= 3
            yield pa.RecordBatch.from_arrays([pa.array(u[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["token", "n"])

        for b in batches:
            for text in b.column(0):
                s = shingles(text.as_py(), width)
                held.append(s)
                size += len(s)
                if size > COUNTED:
                    yield from out()
                    held, size = [], 0
        yield from out()

    seen = docs.select("text").mapInArrow(work, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return np.array([r.token for r in seen.orderBy(F.desc("n"), "token").limit(most).collect()][::-1], np.int64).view(np.uint64)


def sketches(docs: DataFrame, width: int, percent: int, common) -> DataFrame:
    """(id, n, k1, k2, marks, prefix): the set's size, its hash in two longs, a min-hash for each round, and the prefix."""

    def work(batches: Iterator[pa.RecordBatch]):
        order = np.argsort(common.value, kind="stable")
        known = common.value[order]
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                rows: list[list] = [[], [], [], [], []]
                for text in b.column(1):
                    s = shingles(text.as_py(), width)
                    digest = xxhash.xxh3_128_digest(s.tobytes())
                    rank = np.full(len(s), -1)
                    if len(known) and len(s):
                        at_ = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        rank = np.where(known[at_] == s, order[at_], -1)
                    first = len(s) - need(len(s), percent) + shared(len(s), percent) if len(s) else 0
                    marks = [int(mixed(s, r).min()) - (1 << 63) for r in range(1, ROUNDS + 1)] if len(s) else None
                    for column, value in zip(rows, (len(s), int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), marks, s[np.lexsort((s, rank))[:first]].view(np.int64)), strict=True):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(rows, kinds, strict=True)]], ["id", "n", "k1", "k2", "marks", "prefix"])

    return docs.select("id", "text").mapInArrow(work, "id long, n long, k1 long, k2 long, marks array<long>, prefix array<long>")


def overlaps(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets' tokens in ascending order with the numbers of their sets, and the sets' sizes."""
    tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes := np.array([len(s) for s in sets]))
    order = np.argsort(tokens, kind="stable")
    return tokens[order], owners[order], sizes


def counted(q: np.ndarray, tokens: np.ndarray, owners: np.ndarray, sets: int) -> np.ndarray:
    """How much each set overlaps with q."""
    lo, hi = np.searchsorted(tokens, q, "left"), np.searchsorted(tokens, q, "right")
    n = hi - lo
    hit, n, lo = n > 0, n[n > 0], lo[n > 0]
    if not hit.any():
        return np.zeros(sets, np.int64)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return np.bincount(owners[at], minlength=sets)


def with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (with an id) and the texts of its ids."""
    if wanted.count() <= IDS:
        wanted = F.broadcast(wanted)  # its size has just been checked
    return docs.select("id", "text").join(wanted, "id")


def partition_links(docs: DataFrame, first: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) among nodes (id, marks) that share a mark: chunks of a mark's nodes, each with the mark's first node as well.

    A chunk gives the edges of a spanning forest of its links, so never more edges than nodes."""
    marked = first.select("id", F.posexplode("marks").alias("round", "mark"))
    marks = marked.groupBy("round", "mark").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("top")).where("size > 1")
    placed = marked.join(marks, ["round", "mark"]).withColumn("chunks", F.ceil(F.col("size") / GROUP).cast("int"))
    own = placed.where("id <> top").select("id", "round", "mark", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"))
    top = placed.where("id = top").select("id", "round", "mark", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    rows = with_texts(docs, written(own.unionByName(top), "chunks"))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        ids, sets = pdf["id"].to_numpy(), [shingles(t, width) for t in pdf["text"]]
        tokens, owners, sizes = overlaps(sets)
        free, out = sizes > 0, []
        for seed in range(len(ids)):
            reached = [seed] if free[seed] else []
            free[seed] = False
            while reached and free.any():
                k = reached.pop()
                both = counted(sets[k], tokens, owners, len(ids))
                new = np.flatnonzero(free & (both > 0) & linked(sizes[k], sizes, both, percent))
                out += [(ids[k], x) for x in ids[new]]
                free[new] = False
                reached += new.tolist()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("round", "mark", "chunk").applyInPandas(work, "a long, b long").where("a <> b")


def grouped(nodes: DataFrame, first: DataFrame) -> DataFrame:
    """(id, n, k1, k2, key, chunk): a node's set and group. A cluster's nodes, in chunks; those alone, by their first two marks, in
    the first mark's chunks of partition_links, which has found all links within them. The key's low bits tell how large the
    cluster is, as a power of two; 0 for nodes alone."""
    clusters = nodes.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    large = first.groupBy(F.get("marks", F.lit(0)).alias("mark")).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > GROUP)
    of = nodes.join(clusters, "cluster", "left").join(large, "mark", "left")
    key = F.when(F.col("size").isNull(), F.col("family")).otherwise(F.xxhash64("cluster"))
    key = key.bitwiseAND(F.lit(~LEVELS)).bitwiseOR(F.coalesce(F.ceil(F.log2("size")), F.lit(0)).cast("long"))
    of = of.select("id", key.alias("key"), F.pmod(F.xxhash64("id"), F.ceil(F.coalesce("size", "held", F.lit(1)) / GROUP)).cast("int").alias("chunk"))
    return written(of.join(first.select("id", "n", "k1", "k2"), "id"), "groups")


def opening_links(docs: DataFrame, nodes: DataFrame, first: DataFrame, sketch: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between nodes (id, cluster, mark, family) of different groups and clusters, by the token-group matrix."""
    groups = grouped(nodes, first)
    of = F.broadcast(groups) if groups.count() <= IDS else groups  # its size has just been checked
    tokens = sketch.select("id", "n", "k1", "k2", "prefix").join(of, ["id", "n", "k1", "k2"]).select(F.explode("prefix").alias("token"), "key", "chunk", F.col("n").cast("int").alias("n"))
    # dealt once by token: the sums and both sides of the join, which are identical, need no other exchange
    matrix = tokens.repartition("token").groupBy("token", "key", "chunk").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    q, g = matrix.alias("q"), matrix.alias("g")
    c = F.col
    level = lambda side: c(f"{side}.key").bitwiseAND(F.lit(LEVELS))
    later = (c("q.key") < c("g.key")) | ((level("q") == 0) & (c("q.key") == c("g.key")) & (c("q.chunk") < c("g.chunk")))
    smaller = (level("q") < level("g")) | ((level("q") == level("g")) & later)
    fits = (F.lit(100).cast("long") * c("q.most") >= percent * c("g.least").cast("long")) & (F.lit(100).cast("long") * c("g.most") >= percent * c("q.least").cast("long"))
    pairs = q.join(g, (c("q.token") == c("g.token")) & smaller & fits)
    asking, asked = ["qkey", "qchunk"], ["key", "chunk"]
    pairs = pairs.groupBy(*[c(f"q.{x}").alias(f"q{x}") for x in asked], *[c(f"g.{x}").alias(x) for x in asked]).agg(F.count(F.lit(1)).alias("shared"), F.least(F.min("q.least"), F.min("g.least")).cast("long").alias("least"))
    pairs = pairs.where(F.col("shared") >= F.floor(F.floor((percent * F.col("least") + 99) / 100) / STRIDE) + 1).select(*asking, *asked)
    member = groups.select("id", *asked)
    asks = written(pairs.join(member.select("id", *[F.col(x).alias(f"q{x}") for x in asked]), asking).select("id", *asked), "asks")
    salts = asks.groupBy(*asked).agg(F.ceil(F.count(F.lit(1)) / OPENERS).cast("int").alias("salts"))
    dealt = asks.join(salts, asked).select("id", *asked, F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("asks"))
    held = member.join(salts, asked).select("id", *asked, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("asks"))
    rows = with_texts(docs, written(dealt.unionByName(held), "opened"))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        group, ask = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        ids, sets = group["id"].to_numpy(), [shingles(t, width) for t in group["text"]]
        some = 1 if (group["key"] & LEVELS).any() else len(ids)  # one link joins a query to a whole cluster
        tokens, owners, sizes = overlaps(sets)
        union, out = np.unique(tokens), []
        for i, text in zip(ask["id"], ask["text"], strict=True):
            s = shingles(text, width)
            if not len(s) or len(np.intersect1d(s, union, assume_unique=True)) < need(len(s), percent):
                continue  # the group stays closed
            both = counted(s, tokens, owners, len(ids))
            out += [(i, x) for x in ids[(both > 0) & linked(len(s), sizes, both, percent)][:some]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("key", "chunk", "salt").applyInPandas(work, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that links reach, for all ids in links (a, b).

    Labels are exchanged along links and then shortened to the label's label; both shrink, and the loop ends when no label does."""
    both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("to"))).distinct()
    both = written(both, "links")
    labels = written(both.groupBy("id").agg(F.least("id", F.min("to")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("to"), F.col("label").alias("other")), "to").groupBy("id").agg(F.min("other").alias("other"))
        new = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        short = new.join(labels.select(F.col("id").alias("label"), F.col("label").alias("further")), "label", "left")
        new = written(short.select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = new.select("id", "label")
        if not new.where("label < old").limit(1).count():
            return labels


def relabelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes with their clusters joined along links between nodes."""
    lead = lambda c: nodes.select(F.col("id").alias(c), F.col("cluster").alias(f"c{c}"))
    links = written(links, "found")
    if not links.limit(1).count():
        return nodes
    between = links.join(lead("a"), "a").join(lead("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b")
    labels = components(between).withColumnRenamed("id", "cluster")
    return written(nodes.join(labels, "cluster", "left").select("id", "mark", "family", F.coalesce("label", "cluster").alias("cluster")), "nodes")


def join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, links) for each row of docs: links tells whether it links with another row."""
    docs = docs.select(F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).cast("long").alias("id"), "text")
    common = docs.sparkSession.sparkContext.broadcast(frequent(docs, width))
    sketch = written(sketches(docs, width, percent, common), "sketch")
    sets = written(sketch.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "sets")
    full = sketch.where("n > 0").select("id", "n", "k1", "k2", "marks")
    first = full.join(sets.select("n", "k1", "k2", F.col("node").alias("id")), ["n", "k1", "k2", "id"]).dropDuplicates(["n", "k1", "k2"])
    first = written(first.select("id", "n", "k1", "k2", "marks"), "first")
    nodes = written(first.groupBy("id").agg(F.min("marks").alias("marks")).select("id", F.get("marks", F.lit(0)).alias("mark"), F.xxhash64(F.get("marks", F.lit(0)), F.get("marks", F.lit(1))).alias("family"), F.col("id").alias("cluster")), "nodes")
    # rows of one id with different texts: the id joins their nodes
    repeated = sketch.where("n > 0").groupBy("id").agg(F.count_distinct("n", "k1", "k2").alias("sets")).where("sets > 1").select("id")
    repeated = full.select("id", "n", "k1", "k2").join(repeated, "id").join(sets, ["n", "k1", "k2"]).select(F.col("id").alias("a"), F.col("node").alias("b"))
    top = repeated.groupBy("a").agg(F.min("b").alias("top"))
    repeated = repeated.join(top, "a").select(F.col("top").alias("a"), "b")
    nodes = relabelled(nodes, partition_links(docs, first, width, percent).unionByName(repeated))
    nodes = relabelled(nodes, opening_links(docs, nodes, first, sketch, width, percent))
    whole = sets.join(nodes.select(F.col("id").alias("node"), "cluster"), "node")
    size = whole.groupBy("cluster").agg(F.sum("copies").alias("size"))
    whole = whole.join(size, "cluster").select("n", "k1", "k2", "cluster", "size")
    out = sketch.select("id", "n", "k1", "k2").join(whole, ["n", "k1", "k2"], "left")
    back = lambda c: F.when(c != NULL_ID, c)
    return out.select(back(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), back(F.coalesce("cluster", "id")).alias("component_id"), (F.coalesce("size", F.lit(1)) > 1).alias("linked"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component stays, that with the smallest id (null first; of rows that share it, any one), and all that link with nothing.

    Rows are vertices of their own, by a key: texts link them, a null or repeated id does not."""
    keyed = written(docs.withColumn("__key", F.monotonically_increasing_id()), "keyed")
    found = written(join(keyed.select(F.col("__key").alias("doc_id"), "text"), width, percent).where("linked").select(F.col("doc_id").alias("__key"), "component_id"), "linked")
    found = found.join(keyed.select("__key", F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.col("__key").alias("key")).alias("rank")), "__key")
    stays = found.groupBy("component_id").agg(F.min("rank").getField("key").alias("__key"))
    gone = written(found.join(stays, ["component_id", "__key"], "left_anti").select("__key"), "gone")
    return keyed.join(gone, "__key", "left_anti").select(*docs.columns)


QUERIES, ORACLES = {"op10_jaccard": query}, {}
