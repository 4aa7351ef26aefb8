"""Spelling variant grouping: Aho-Corasick automata over the halves of words find words one edit apart.

Runs of letters are counted over all documents by Spark. A word of m code points is cut after m // 2: of two words one edit apart, the one's
first half begins the other or its second half ends it. Entries (a word's halves) are dealt to shards by side, length and the half's outer three
letters; every word asks the shards of its own outer letters and of its length and those one off, so that each shard's automaton scans the words
that can fit alone. A match counts if it stands at the word's begin or end and the lengths fit; then the rest is compared whole. Pairs that both
halves find count on the first half's side, so shards add up without pairs leaving them: each gives a word's number of near words and the best.

Letters between U+0000 and U+00FF only, so that a word is as many bytes in Latin-1 as it has code points, and candidates are compared as
byte matrices, at most BLOCK pairs at once. A key with more than SEGMENTS entries, or whose words ask more than SEGMENTS times, is dealt as a
grid of parts of entries and parts of askers: no shard holds more than the mean, a few parts' worth of rows and hash luck.

Roots: a form has at least ten times the occurrences of its word, so chains are shorter than the digits of the largest count; pointers are
doubled (root of the root) until none moves.

Defined results: a null text has no runs; a null id counts as the empty text before the colon; equal rows count each; n counts occurrences, not
documents; extra columns are ignored; no words give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import ascii_lower, table, written

RUN, LEAST_CHARS, LEAST_N, FACTOR, TYPO = "[A-Za-zÀ-ÿ]", 7, 2, 10, 31
#: Letters of a half that name its shard; entries of a shard at the mean, and of a key's part at most; pairs that are compared at once; large keys that are broadcast.
OUTER, SEGMENTS, BLOCK, FEW = 3, 20_000, 1 << 22, 100_000


def words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_n: int = LEAST_N, typo: int | None = TYPO) -> DataFrame:
    """(word, n): the runs of at least ``least_chars`` letters that occur ``least_n`` times or more. typo: of runs whose hash it divides a letter goes first."""
    runs = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(f"{RUN}{{{least_chars},}}"), F.lit(0))
    d = docs.select("doc_id", F.explode(runs).alias("word"))
    if typo:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        d = d.withColumn("h", h).select(F.when(F.col("h") % typo == 0, cut).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least_chars)
    return d.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)


class Shard:
    """The automaton of a shard's entries: each half leads to the groups (side, length) of words that have it."""

    def __init__(self, words: list[str], ns: np.ndarray, sides: np.ndarray):
        import ahocorasick

        groups: dict[str, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, (w, side) in enumerate(zip(words, sides.tolist(), strict=True)):
            h = len(w) // 2
            groups[w[h:] if side else w[:h]][side, len(w)].append(k)
        self.words, self.ns = words, ns
        self.automaton = ahocorasick.Automaton()
        self.members = []
        for half, by in groups.items():
            found = []
            for (side, m), ks in by.items():
                ks = np.array(sorted(ks, key=lambda k: (-ns[k], words[k])))  # the best first
                found.append((side, m, len(self.members)))
                self.members.append((side, m, ks, _matrix([words[k] for k in ks], m)))
            self.automaton.add_word(half, (len(half), found))
        self.automaton.make_automaton()

    def asked(self, asks: list[str]) -> dict[int, list[str]]:
        """The words to compare with each group: a half found where it must stand, lengths at most one apart."""
        out = defaultdict(list)
        for w in asks:
            size = len(w)
            for end, (length, found) in self.automaton.iter(w):
                first, last = end + 1 == length, end + 1 == size
                if first or last:
                    for side, m, group in found:
                        if -1 <= size - m <= 1 and (last if side else first):
                            out[group].append(w)
        return out


def _matrix(words: list[str], m: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), m)


def _agreeing(x: np.ndarray, y: np.ndarray, columns) -> np.ndarray:
    """In how many of the paired columns, from the first on, each row of x agrees with each of y without a break."""
    going, n = np.ones((len(x), len(y)), bool), np.zeros((len(x), len(y)), np.uint8)
    for i, j in columns:
        going &= x[:, i, None] == y[None, :, j]
        n += going
    return n


def near(a: np.ndarray, e: np.ndarray, side: int) -> np.ndarray:
    """Which words of a (rows) are one edit from which of e (columns), that share e's first half at the begin (side 0) or its second at the end; none on side 1 that side 0 has."""
    size, m = a.shape[1], e.shape[1]
    h = m // 2
    x, y = (a[:, h:], e[:, h:]) if side == 0 else (a[:, : size - m + h], e[:, :h])
    p, q = x.shape[1], y.shape[1]
    if p == q:
        off = np.zeros((len(x), len(y)), np.uint8)
        for i in range(p):
            off += x[:, i, None] != y[None, :, i]
        return off == 1
    n = min(p, q)
    out = _agreeing(x, y, [(i, i) for i in range(n)]) + _agreeing(x, y, [(p - 1 - i, q - 1 - i) for i in range(n)]) >= n
    if side:
        out &= _agreeing(a, e, [(i, i) for i in range(h)]) < h
    return out


def compared(entries: pa.Table, asks: pa.Table) -> pa.Table:
    """(word, n_near, neg_n, form) of a shard's askers that have near words in it."""
    count: dict[str, int] = defaultdict(int)
    best: dict[str, tuple[int, str]] = {}
    if entries.num_rows and asks.num_rows:
        shard = Shard(entries["word"].to_pylist(), entries["n"].to_numpy(), entries["side"].to_numpy())
        for group, ws in shard.asked(list(dict.fromkeys(asks["asker"].to_pylist()))).items():
            side, m, ks, e = shard.members[group]
            for size in (m - 1, m, m + 1):
                own = [w for w in ws if len(w) == size]
                wide = max(1, min(len(e), BLOCK))
                high = max(1, BLOCK // wide)
                for i in range(0, len(own), high):
                    some = own[i : i + high]
                    a = _matrix(some, size)
                    for j in range(0, len(e), wide):
                        hit = near(a, e[j : j + wide], side)
                        for k in np.flatnonzero(hit.any(1)).tolist():
                            w, top = some[k], ks[j + int(hit[k].argmax())]
                            count[w] += int(hit[k].sum())
                            best[w] = min(best.get(w, (0, "")), (-int(shard.ns[top]), shard.words[top]))
    found = list(count)
    return pa.table({"word": pa.array(found, pa.string()), "n_near": pa.array([count[w] for w in found], pa.int64()), "neg_n": pa.array([best[w][0] for w in found], pa.int64()), "form": pa.array([best[w][1] for w in found], pa.string())})


def _keyed(words_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (word, n, side, key) and askers (word, key): key is side, the entry's length and the outer letters."""
    w, m = F.col("word"), F.length("word")
    outer = lambda side: F.substring(w, 1, OUTER) if side == 0 else F.substring(w, -OUTER, OUTER)
    key = lambda side, m: F.concat_ws(":", F.lit(side).cast("string"), m.cast("string"), outer(side))
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), key(s, m).alias("key")) for s in (0, 1)]))
    entries = words_.select("word", "n", sides.alias("x")).select("word", "n", "x.side", "x.key")
    asks = words_.select("word", F.explode(F.array(*[key(s, m + k) for s in (0, 1) for k in (-1, 0, 1)])).alias("key"))
    return entries, asks


def neighbours(words_: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """(word, n_near, neg_n, form) of (word, n), of words that have near ones: their number, the most frequent one and its count, negative."""
    entries, asks = _keyed(words_)
    shards = max(1, math.ceil(2 * words_.count() / segments))
    parts = lambda df, name: df.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / segments).cast("int").alias(name)).where(F.col(name) > 1)
    large = parts(entries, "rows").join(parts(asks, "cols"), "key", "full").select("key", F.coalesce("rows", F.lit(1)).alias("rows"), F.coalesce("cols", F.lit(1)).alias("cols"))
    large = written(large, "large")
    large = F.broadcast(large) if large.count() <= FEW else large

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """A large key's rows, each in its part and with every part of the other side, in shards of their own; other keys by hash."""
        d = df.join(large, "key", "left").withColumn(own, F.pmod(F.xxhash64("word"), F.col(own)))
        d = d.withColumn(other, F.explode(F.when(F.col(other).isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), F.col(other) - 1))))
        cell = F.concat_ws("#", "key", F.col("rows").cast("string"), F.col("cols").cast("string"))
        return d.withColumn("shard", F.when(F.col("rows").isNull(), F.pmod(F.xxhash64("key"), F.lit(shards)).cast("string")).otherwise(cell))

    e = dealt(entries, "rows", "cols").select("shard", "word", "n", "side").repartition(shards, "shard")
    a = dealt(asks, "cols", "rows").select(F.col("shard").alias("shard"), F.col("word").alias("asker")).repartition(shards, "shard")
    found = e.groupBy("shard").cogroup(a.groupBy("shard")).applyInArrow(compared, "word string, n_near long, neg_n long, form string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("neg_n", "form")).alias("best")).select("word", "n_near", "best.neg_n", "best.form")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), form null at the end of a chain: pointers are doubled until none moves."""
    at = written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = written(at.join(on, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        if not at.where("moved").limit(1).count():
            return at.select("word", "root")
        at = at.select("word", "root")


def grouped(docs: DataFrame, factor: int = FACTOR, segments: int = SEGMENTS, **of) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of documents."""
    w = written(words(docs, **of), "words")
    d = w.join(neighbours(w, segments), "word", "left")
    good = -F.col("neg_n") >= factor * F.col("n")
    d = written(d.select("word", F.when(good, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, -F.col("neg_n")).alias("form_n")), "forms")
    linked = d.where("form IS NOT NULL")
    ends = linked.select(F.col("form").alias("word")).distinct().join(linked.select("word"), "word", "left_anti").select("word", F.lit(None).cast("string").alias("form"))
    return d.join(rooted(linked.select("word", "form").unionByName(ends)), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents"))


#: SQL finds near words otherwise: words that are equal after a letter is deleted from one or both, at the same place if from both. crc32 is made of its polynomial.
ORACLE = r"""
WITH RECURSIVE bits AS (SELECT b, b::BIGINT AS c, 0 AS k FROM range(256) r(b) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{7,}')) AS w FROM documents),
o AS (SELECT doc_id, w, count(*) AS k FROM r GROUP BY ALL),
x AS (SELECT w, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(hex(encode(s))) // 2), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
    FROM (SELECT w, k, coalesce(doc_id::VARCHAR, '') || ':' || w AS s FROM o), crc),
y AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM x),
v AS (SELECT word, sum(k)::BIGINT AS n FROM y WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS s FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)),
p AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN v b ON a.s = b.word UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN v b ON a.s = b.word),
f AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS form, max(m) AS form_n FROM p GROUP BY word),
g AS (SELECT v.word, CASE WHEN form_n >= 10 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM v LEFT JOIN f USING (word)),
c AS (SELECT word, word AS root, form AS next FROM g UNION ALL SELECT c.word, c.next, g.form FROM c JOIN g ON g.word = c.next)
SELECT g.word, g.form, c.root, g.n, g.n_near, g.form_n FROM g JOIN c ON c.word = g.word AND c.next IS NULL
"""

QUERIES, ORACLES = {"op11_variants": query}, {"op11_variants": ORACLE}
