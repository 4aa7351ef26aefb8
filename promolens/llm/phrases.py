"""Phrase collocation mining with pivot partitioning, as in MG-FSM.

Words are counted per language; those with at least LEAST occurrences are numbered from the most frequent on. Texts are rewritten as these
numbers, 0 for rarer words and for piece borders. Each occurrence of a word is the pivot of a fragment: the up to four words before it that are
strictly more frequent and the up to four after it that are no rarer, without a break. So a phrase's occurrence is in one fragment
alone, that of its rarest word's leftmost occurrence. First pairs are counted at their pivots; then fragments are rewritten, broken where two words
are no frequent pair, counted where they are equal, and sent to the shard of their pivot, which mines phrases of three to five words locally and
emits those that hold the pivot. Pivots with more than FRAGMENTS distinct fragments are dealt over several shards by fragment, and their counts are added
up afterwards; of others a shard emits the frequent phrases alone.

Numbers come from a broadcast dictionary while there are at most VOCAB frequent words of VOCAB_BYTES in all, which is counted; beyond it words meet their numbers
in a join. Pairs break fragments while there are at most PAIRS frequent ones; beyond it fragments are just longer.

A candidate's parts are candidates or frequent words themselves, so scores join the counts with themselves. One that stands inside a
longer one as frequent as itself stands inside one that is a word longer, so only those are looked up.

Defined results: a null text is empty, a null language is ``und``; repeated rows and ids count each; words are compared as they are after A-Z are
lower-cased; extra columns are ignored; a table without frequent phrases gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.llm.common import ascii_lower, table, written

LEAST, LONGEST, TOP = 100, 5, 2000
VOCAB, VOCAB_BYTES, PAIRS, FRAGMENTS, FEW = 1_000_000, 1 << 25, 4_000_000, 1 << 18, 100_000
#: Tokens that a task rewrites at a time.
TOKENS = 1 << 21
REACH = LONGEST - 1
BREAK = r".,;:!?\n\x0b\x0c\r"
TOKEN = re.compile(rf"[^ \t{BREAK}]+|[{BREAK}]")


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))


def _pieces(text: Column) -> Column:
    """The words of each piece, as arrays."""
    return F.transform(F.split(text, r"[.,;:!?\x0A-\x0D]"), lambda p: F.filter(F.split(p, r"[\x20\x09]+"), lambda w: w != ""))


def vocabulary(t: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, f, id) of the frequent words, ids from 1 on, the most frequent first; (lang, n) of all words."""
    f = t.select("lang", F.explode(F.split("text", r"[\x20\x09.,;:!?\x0A-\x0D]+")).alias("word")).where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f"))
    # rarer words only add to their language's total
    f = written(f.groupBy("lang", F.when(F.col("f") >= least, F.col("word")).alias("word")).agg(F.sum("f").alias("f")), "word-counts")
    totals = f.groupBy("lang").agg(F.sum("f").alias("n"))
    return written(_numbered(f.where("word IS NOT NULL")), "vocabulary"), totals


def _numbered(f: DataFrame) -> DataFrame:
    """id: the word's place by falling f, then code points, over all languages together, from 1 on; ranges of f are numbered apart and offset by what stands before them."""
    d = f.withColumn("range", F.floor(64 * F.log2("f")))
    before = F.sum("n").over(W.orderBy(F.col("range").desc()).rowsBetween(W.unboundedPreceding, -1))  # at most 64 ranges for each doubling
    ranges = d.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("first"))
    within = F.row_number().over(W.partitionBy("range").orderBy(F.col("f").desc(), "word", "lang"))
    return d.withColumn("k", within).join(F.broadcast(ranges), "range").select("lang", "word", "f", (F.col("first") + F.col("k")).cast("int").alias("id"))


def rewritten(spark: SparkSession, t: DataFrame, vocab: DataFrame, most: int) -> tuple[DataFrame, Callable]:
    """The texts as rows, and what makes arrays of word numbers of their Arrow batches: 0 between pieces, texts and for rarer words, at the begin and the end too."""
    size = vocab.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("b")).head()
    if size["n"] > most or size["b"] > VOCAB_BYTES:
        p = t.select(F.monotonically_increasing_id().alias("doc"), "lang", F.posexplode(_pieces(F.col("text"))).alias("piece", "words"))
        w = p.select("doc", "piece", "lang", F.posexplode("words").alias("at", "word")).join(vocab.select("lang", "word", "id"), ["lang", "word"], "left")
        ids = F.sort_array(F.collect_list(F.struct("at", F.coalesce("id", F.lit(0)).alias("id"))))["id"]
        return written(w.groupBy("doc", "piece").agg(F.concat(ids, F.array(F.lit(0))).alias("ids")).select("ids"), "numbered"), lambda batches: _gathered(np.asarray(b.column(0).flatten()) for b in batches)
    ids = {}
    for r in vocab.select("lang", "word", "id").toLocalIterator():  # no more than ``most``
        ids.setdefault(r["lang"], {})[r["word"]] = r["id"]
    known = spark.sparkContext.broadcast(ids)

    def decoded(batches):
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                get = known.value.get(lang, {}).get
                yield np.array([*[get(x, 0) for x in TOKEN.findall(text.as_py())], 0], np.int32)

    return t.select("lang", "text"), lambda batches: _gathered(decoded(batches))


def _gathered(arrays: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Arrays joined until they hold TOKENS numbers, zeros before and behind as far as a phrase reaches."""
    edge, some, size = np.zeros(REACH, np.int32), [], 0
    for x in arrays:
        some.append(x)
        size += len(x)
        if size >= TOKENS:
            yield np.concatenate([edge, *some, edge])
            some, size = [], 0
    if some:
        yield np.concatenate([edge, *some, edge])


def _keys(x: np.ndarray) -> np.ndarray:
    """Neighbours as one number; 0 where one of them is none."""
    return np.where((x[:-1] > 0) & (x[1:] > 0), (x[:-1].astype(np.int64) << 32) | x[1:], 0)


def pairs(rows: DataFrame, decode: Callable, least: int) -> DataFrame:
    """(a, b, f) of the frequent pairs."""

    def work(batches):
        for x in decode(batches):
            keys = _keys(x)
            key, n = np.unique(keys[keys > 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["key", "n"])

    counted = rows.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return written(counted.select(F.shiftright("key", 32).cast("int").alias("a"), F.expr("CAST(key & 4294967295 AS INT)").alias("b"), "f"), "pairs")


def fragments_of(x: np.ndarray, frequent: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct fragments of three words and more (rows of 2 * REACH + 1 numbers, the pivot amid, 0 beyond the ends) and how often each occurs."""
    keys = _keys(x)
    if frequent is None:
        linked = keys > 0
    else:
        at = np.searchsorted(frequent, keys)
        at[at == len(frequent)] = 0
        linked = (keys > 0) & (frequent[at] == keys) if len(frequent) else np.zeros(len(keys), bool)
    lone = np.concatenate([[False], linked[:-1] & linked[1:], [False]])  # amid three linked words
    could = lone.copy()
    could[:-1] |= lone[1:]
    could[1:] |= lone[:-1]
    i = np.flatnonzero(could)
    i = i[(i >= REACH) & (i < len(x) - REACH)]
    out = np.zeros((len(i), 2 * REACH + 1), "<i4")
    out[:, REACH] = x[i]
    left, right = np.ones(len(i), bool), np.ones(len(i), bool)
    for k in range(1, REACH + 1):
        left &= linked[i - k] & (x[i - k] < x[i])
        right &= linked[i + k - 1] & (x[i + k] <= x[i])
        out[:, REACH - k] = np.where(left, x[i - k], 0)
        out[:, REACH + k] = np.where(right, x[i + k], 0)
    out = out[(out > 0).sum(1) >= 3]
    return _distinct(out, np.ones(len(out), np.int64))


def _distinct(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their counts."""
    if not len(rows):
        return rows, n
    order = np.lexsort(rows.T)
    rows, n = rows[order], n[order]
    first = np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])
    return rows[first], np.add.reduceat(n, np.flatnonzero(first))


def mined(fragments: np.ndarray, n: np.ndarray, whole: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of three words and more that hold their fragment's pivot (rows, 0 behind the end) and their counts; of pivots that are here as a whole the frequent ones alone."""
    some, ns, wholes = [], [], []
    for left in range(REACH + 1):
        for right in range(max(0, 2 - left), REACH + 1 - left):
            has = (fragments[:, REACH - left] > 0) & (fragments[:, REACH + right] > 0)
            gram = np.zeros((int(has.sum()), LONGEST + 1), "<i4")
            gram[:, : left + right + 1] = fragments[has, REACH - left : REACH + right + 1]
            gram[:, LONGEST] = whole[has]
            some.append(gram)
            ns.append(n[has])
    rows, n = _distinct(np.concatenate(some), np.concatenate(ns))
    good = (n >= least) | (rows[:, LONGEST] == 0)
    return rows[good, :LONGEST], n[good]


def phrases(rows: DataFrame, decode: Callable, vocab: DataFrame, pairs_: DataFrame, least: int, most_pairs: int, most: int) -> DataFrame:
    """(g, f): the frequent phrases of three words and more, as arrays of word numbers."""
    spark, frequent = rows.sparkSession, None
    if pairs_.count() <= most_pairs:
        got = pairs_.select((F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b"))).alias("key")).toArrow()["key"].to_numpy()
        frequent = spark.sparkContext.broadcast(np.sort(got))

    def work(batches):
        for x in decode(batches):
            found, n = fragments_of(x, frequent and frequent.value)
            data = found.tobytes()
            size = found.shape[1] * 4
            binary = pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(np.arange(0, len(data) + 1, size, dtype=np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array(found[:, REACH], pa.int32()), binary, pa.array(n, pa.int64())], ["pivot", "fragment", "n"])

    f = rows.mapInArrow(work, "pivot int, fragment binary, n long")
    parts = vocab.where(F.col("f") > most).select(F.col("id").alias("pivot"), F.ceil(F.col("f") / most).alias("parts"))
    total = vocab.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("f")).head()["f"]
    shards = max(1, math.ceil(total / (4 * most)))
    part = F.coalesce(F.pmod(F.xxhash64("fragment"), F.col("parts")), F.lit(0))
    f = f.join(F.broadcast(parts) if parts.count() <= FEW else parts, "pivot", "left")
    f = f.select(F.pmod(F.xxhash64("pivot", part), F.lit(shards)).alias("shard"), "fragment", "n", F.col("parts").isNull().cast("int").alias("whole")).repartition(shards, "shard")

    def mine(group: pa.Table) -> pa.Table:
        fragment = group["fragment"].combine_chunks()
        data = np.frombuffer(b"".join(fragment.to_pylist()), "<i4").reshape(-1, 2 * REACH + 1)
        grams, n = mined(data, group["n"].to_numpy(), group["whole"].to_numpy(), least)
        size = (grams > 0).sum(1)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(grams[grams > 0], pa.int32()))
        return pa.table({"g": lists, "n": pa.array(n, pa.int64())})

    got = f.groupBy("shard").applyInArrow(mine, "g array<int>, n long")
    return got.groupBy("g").agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, most_words: int = VOCAB, most_pairs: int = PAIRS, most_fragments: int = FRAGMENTS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases."""
    spark, t = docs.sparkSession, texts(docs)
    vocab, totals = vocabulary(t, least)
    rows, decode = rewritten(spark, t, vocab, most_words)
    two = pairs(rows, decode, least)
    more = phrases(rows, decode, vocab, two, least, most_pairs, most_fragments)
    ids = F.array("id").alias("g")
    all_ = written(vocab.select(ids, "f").unionByName(two.select(F.array("a", "b").alias("g"), "f")).unionByName(more), "phrases")
    size = F.size("g")

    longer = all_.where(size > 2).select(F.explode(F.array(F.slice("g", F.lit(1), size - 1), F.slice("g", F.lit(2), size - 1))).alias("g"), "f").distinct()
    left = all_.where(size > 1).join(longer, ["g", "f"], "left_anti").withColumn("lang_id", F.element_at("g", 1))
    left = left.join(vocab.select(F.col("id").alias("lang_id"), "lang"), "lang_id").join(totals, "lang").select("lang", "g", F.col("f").alias("a"), "n")
    cut = left.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).withColumns({"x": F.slice("g", F.lit(1), F.col("k")), "y": F.slice("g", F.col("k") + 1, size)})
    cut = cut.join(all_.select(F.col("g").alias("x"), F.col("f").alias("l")), "x").join(all_.select(F.col("g").alias("y"), F.col("f").alias("r")), "y")
    cut = cut.withColumn("score", F.expr("CAST(1000 * CAST(a AS DECIMAL(18,0)) * CAST(n AS DECIMAL(18,0)) AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"))
    best = cut.groupBy("lang", "g", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "g", "a", "n", "c.score", "c.l", "c.r")

    order = [F.col("score").desc(), F.col("a").desc()]
    some = written(best.withColumn("rank", F.rank().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top).drop("rank"), "best")
    word = some.select("g", F.posexplode("g").alias("at", "id")).join(vocab.select("id", "word"), "id").groupBy("g").agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order, "phrase"))
    return some.join(word, "g").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    return rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS p FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ 	]+'), lambda x: x <> '') AS w, count(*) AS k FROM t GROUP BY ALL),
c AS (SELECT lang, m, w[i:i + m - 1] AS g, sum(k)::HUGEINT AS f FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM p, range(1, {LONGEST + 1}) s(m) WHERE len(w) >= m) GROUP BY ALL HAVING m = 1 OR sum(k) >= {LEAST}),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM c WHERE m = 1 GROUP BY lang),
a AS (SELECT * FROM c WHERE m > 1),
d AS (SELECT DISTINCT x.lang, x.g FROM a x JOIN (SELECT lang, f, g, m, unnest(range(1, m + 1)) AS i FROM a) y ON x.lang = y.lang AND x.m < y.m AND x.g = y.g[i:i + x.m - 1] AND i + x.m - 1 <= y.m AND 100 * y.f >= 100 * x.f),
s AS (SELECT a.lang, a.g, a.f AS a, x.f AS l, y.f AS r, n, k, 1000 * a.f * n // (x.f * y.f) AS score FROM (SELECT *, unnest(range(1, m)) AS k FROM a ANTI JOIN d USING (lang, g)) a JOIN n USING (lang)
    JOIN c x ON x.lang = a.lang AND x.g = a.g[:k] JOIN c y ON y.lang = a.lang AND y.g = a.g[k + 1:]),
b AS (SELECT *, array_to_string(g, ' ') AS phrase FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b) WHERE rank <= {TOP}
"""


QUERIES, ORACLES = {"op12_phrases": query}, {"op12_phrases": _oracle()}
