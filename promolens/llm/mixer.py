"""Language-model scoring by online logistic context mixing.

A text (A-Z lower-cased) is coded token by token, white space, words and an end, each by binary decisions:

1. Spelling. A word's bytes and their end mark go through binary decisions: for each previous byte there is a Huffman tree over the bytes
   that may follow, built from the words' byte pairs. Three bit predictors, for the hashed contexts of the last two bytes, the last
   four and the word so far, hold a bit's counts in tables sized by an estimate of the distinct pairs of context and byte; their logits are
   mixed by weights that a gate (place in the word, how sure the predictors are) chooses, and an adaptive map from the mixed logit to
   what it really meant, per gate, ends the chain.
2. Whole words. A word's count in the corpus, less a discount, and the discounts' sum times its spelling: every distinct word of all training
   documents keeps its exact count, in a table that grows with the input and is joined by the word's hash.
3. The document so far. A gate, whose rate follows the share of tokens that were repeats up to this place, mixes in the words of the document itself.
4. Spans. Some places (by a hash of the last ANCHOR tokens) predict the whole span up to the next such place: the one that most other training
   documents have there. Whether it follows is one decision, by counts over the training documents for each gate (how many hold the span, how
   alone it is). Copies of a text cost next to nothing but for their first span. Anchors and spans of all training documents are kept, again joined by hash.

5. Openings (context_score only). Five bits tell what a token begins with (a letter, a digit, ...). Three bit predictors across words, for the contexts of the gap
   before it, what the word before it ends with, and that word's hash, are mixed and refined as in spelling; the rest of the token has its
   probability under 1 and 2 given its beginning. So context_score is score with every token's first bits predicted from the word before.

So a text's score depends on nothing but the text and the corpus; weights and map are fitted to all distinct words of the training documents
(those whose fold, crc32 of the id modulo 10, is not 0), each half of the folds being predicted from the other half's tables: tasks sum up
every decision by its gate and the logits' levels (how many, how many ones, the logits' sums) and the driver fits to these sums. A training
document's own spans don't predict themselves: one document less is counted for it.

Broadcast: the tables (2^CAP bytes each at most, slots bear no check of their context), what context_score adds for each of 2^16 contexts and 32 openings (8 MB) and the HEAD most frequent words (24 bytes each), chosen by levels of their counts.
Texts are read in blocks of a quarter of a megabyte, so memory is about a tenth of a text's size beyond that.

The base score is the add-0.1 unigram model over words, from the same counts.

Defined results: a null text is the empty one; a null id counts as the empty text, which is held out; rows with equal ids are scored
each; extra columns are ignored; an empty table gives none; without training texts spelling is even and the base score is that of an empty vocabulary (V = 0).
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import LOWER, UPPER, fold, table, written
from promolens.llm.jaccard import Powers, mixed

#: Slots of a block that tasks report, and of the smallest table, and of the largest (2 to this power); slots for each byte of the distinct words.
BLOCK_BITS, CAP, SPARE = 16, 23, 2
#: Folds of the first half; levels of a logit.
FIRST, LEVELS = 4, 32
#: Words that are broadcast with their counts, at most.
HEAD = 1 << 20
#: Bytes of words, and of texts, that are worked on at once; a word's bytes that are spelled together (longer ones are spelled in pieces).
CHUNK, BLOCK, PIECE = 1 << 15, 1 << 18, 1 << 12
#: Bytes of texts whose words are counted together; a quarter of them is coded together.
TOGETHER = 1 << 21
#: Tokens whose hash tells where a span starts, and how many tokens a span has on average.
ANCHOR, SPAN = 3, 32
#: Where a task's 16-bit counts are carried over: a chunk adds CHUNK to a count at most, as all decisions of a byte have slots of their own.
FULL = (1 << 16) - CHUNK
ORDERS, GATES, CELLS = 3, 32, 33
END = 255  # no byte of UTF-8
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[ord(c) for c in UPPER]] = [ord(c) for c in LOWER]
_LOW = bytes(_FOLD)
_WHITE = [32, 9, 10, 11, 12, 13]
_SPACE = np.isin(np.arange(256), _WHITE)
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: What tokens begin and end with: the end, a letter, a digit, beyond ASCII, an opening mark, another mark, another byte.
_KIND = np.full(256, 31, np.uint8)
_KIND[33:127], _KIND[128:], _KIND[48:58], _KIND[97:123] = 30, 28, 27, np.arange(1, 27)
_KIND[[ord(c) for c in "\"'([{<"]] = 29
_KIND[END] = 0
#: Contexts across words: whether the gap is one space, the kind of byte that the word before ends with, and bits of that word's hash.
KINDS, KIND_BITS, BEFORE = 32, 5, 10
SLOTS = 1 << 1 + KIND_BITS + BEFORE
_HASHED = mixed(np.arange(1, 257, dtype=np.uint64), 3)


class Codes:
    """The decisions of each byte behind each previous byte: nodes and bits, laid out flat."""

    def __init__(self, pairs: np.ndarray, bits: list[int]):
        self.sizes = bits  # of the predictors' tables, as powers of two
        self.first, self.length = np.zeros(65536, np.int32), np.zeros(65536, np.uint8)
        nodes, bits, at, plain = [], [], 0, pairs.sum(0) + 1
        trees: dict[bytes, list] = {}
        for prev in range(256):
            weight = pairs[prev] * 256 + plain
            key = weight.tobytes()
            if key not in trees:
                trees[key] = self._tree(weight)
            for byte, path in enumerate(trees[key]):
                self.first[prev * 256 + byte], self.length[prev * 256 + byte] = at, len(path)
                nodes += [n for n, _ in path]
                bits += [b for _, b in path]
                at += len(path)
        self.nodes, self.bits = np.array(nodes, np.uint32) * np.uint32(0x3D4D51CB >> 8), np.array(bits, np.uint8)

    @staticmethod
    def _tree(weight: np.ndarray) -> list[list[tuple[int, int]]]:
        heap = [(int(w), k) for k, w in enumerate(weight)]
        heapq.heapify(heap)
        up, new = {}, 256
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            up[x], up[y] = (new, 0), (new, 1)
            heapq.heappush(heap, (a + b, new))
            new += 1
        out = []
        for k in range(256):
            path = []
            while k in up:
                k, bit = up[k]
                path.append((new - 1 - k, bit))  # the root is node 0
            out.append(path[::-1])
        return out


def laid(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes, each word with its end mark, and where each word starts (one more at the end)."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], np.int32, n + 1, 4 * words.offset).astype(np.int64) if n else np.zeros(1, np.int64)
    own = offsets[1:] - offsets[:-1]
    starts = offsets - offsets[0] + np.arange(n + 1)
    data = np.full(starts[-1], END, np.uint8)
    if offsets[-1] > offsets[0]:
        data[np.arange(offsets[-1] - offsets[0]) + np.repeat(np.arange(n), own)] = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, starts


def contexts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """At each byte: the byte before it in the word, hashes of the last two bytes, of the last four and of the word so far, and the place (up to 3)."""
    n = len(data)
    begin = np.repeat(starts[:-1], np.diff(starts))
    place = np.minimum(np.arange(n) - begin, 4).astype(np.uint8)
    wide = data.astype(np.uint32)
    back = []
    for k in range(1, 5):
        x = np.zeros(n, np.uint32)
        x[k:] = wide[:-k]
        x[place < k] = 0
        back.append(x)
    two = back[0] | back[1] << np.uint32(8)
    four = two | back[2] << np.uint32(16) | back[3] << np.uint32(24)
    up, down = Powers.of(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_HASHED[data] * up[:n], out=sums[1:])
    word = ((sums[:-1] - sums[begin]) * down[begin] >> np.uint64(32)).astype(np.uint32) ^ place
    mix = lambda h, by: ((h := h * np.uint32(by)) ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return back[0], [mix(two, 0x9E3779B1), mix(four, 0x85EBCA77), mix(word, 0xC2B2AE3D)], np.minimum(place, 3)


def decisions(words: pa.BinaryArray, codes: Codes) -> tuple:
    """For each decision: its bit, its byte's place in the word and its slot in each table; and where each word's decisions start."""
    data, starts = laid(words)
    prev, hashes, place = contexts(data, starts)
    at = (prev << np.uint32(8) | data).astype(np.int64)
    length = codes.length[at]
    ends = np.cumsum(length, dtype=np.int64)
    where = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(codes.first[at] - (ends - length), length)
    node = codes.nodes[where]
    slots = [(np.repeat(h >> np.uint32(32 - b), length) + node) & np.uint32((1 << b) - 1) for h, b in zip(hashes, codes.sizes, strict=True)]
    return codes.bits[where], np.repeat(place, length), slots, np.concatenate([[0], ends])[starts]


class Model:
    """Tables of levels (of logits), and what each cell (a gate and the predictors' levels) means."""

    def __init__(self, codes: Codes, tables: list[np.ndarray]):
        self.codes, self.tables = codes, tables
        self.weights = np.full((GATES, ORDERS), 0.45, np.float32)
        self.map = np.tile(np.linspace(-8, 8, CELLS, dtype=np.float32), (GATES, 1))
        self.settle()

    def settle(self) -> None:
        """log10 of the probability of a zero and of a one in each cell: the mixed logit, half refined by the map. Gate by gate, as every worker holds what it takes."""
        x = logits(np.arange(LEVELS**ORDERS))
        self.meant = np.empty((GATES, LEVELS**ORDERS, 2), np.float32)
        for meant, weights, points in zip(self.meant, self.weights, self.map, strict=True):
            z = (x * weights).sum(1)
            low, part = knot(z)
            end = (0.5 * z + 0.5 * (points[low] * (1 - part) + points[low + 1] * part)).astype(float)
            meant[:] = np.log10(np.clip(1 / (1 + np.exp(np.stack([end, -end], 1))), 1 / 4096, 1 - 1 / 4096))
        self.meant = self.meant.ravel()

    def __getstate__(self) -> dict:
        """Tables are sent compressed, a good part of their slots being empty."""
        return self.__dict__ | {"tables": [zlib.compress(t.tobytes(), 1) for t in self.tables], "meant": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"tables": [np.frombuffer(zlib.decompress(t), np.uint8) for t in state["tables"]]}
        self.settle()

    def cells(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each decision's bit and cell, and where each word's decisions start."""
        bit, place, slots, first = decisions(words, self.codes)
        two, four, word = (t[s] for t, s in zip(self.tables, slots, strict=True))
        gate = place * np.uint8(8) + _SURE[word] + _FAIRLY[four]
        return bit, ((gate.astype(np.int32) * LEVELS + two) * LEVELS + four) * LEVELS + word, first

    def costs(self, words: pa.BinaryArray) -> np.ndarray:
        """log10 probability of each word's spelling, its end mark included."""
        if not len(words):
            return np.zeros(0)
        bit, cell, first = self.cells(words)
        return np.add.reduceat(self.meant[cell * 2 + bit], first[:-1], dtype=np.float64)


def logits(cells: np.ndarray) -> np.ndarray:
    """The middles of the levels of each predictor in these cells."""
    return np.stack([_MIDDLE[cells // LEVELS**k % LEVELS] for k in range(ORDERS)[::-1]], 1)


def knot(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cell = (np.clip(z, -7.99, 7.99) + 8) * 2
    low = cell.astype(np.int32)
    return low, cell - low


def level(ones: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """The level of a slot's logit by its counts."""
    return np.clip(np.floor((np.log((ones + 0.3) / (all_ - ones + 0.3)) + 10) * (LEVELS / 20)), 0, LEVELS - 1).astype(np.uint8)


_MIDDLE = ((np.arange(LEVELS) + 0.5) * (20 / LEVELS) - 10).astype(np.float32)
_SURE = (sum((np.abs(_MIDDLE) > x).astype(np.uint8) for x in (0.5, 1.7, 3.4)) * 2).astype(np.uint8)
_FAIRLY = (np.abs(_MIDDLE) > 2).astype(np.uint8)


def _chunks(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.BinaryArray, np.ndarray]]:
    """The words of a batch in arrays of about CHUNK bytes, words of more than PIECE bytes in pieces, and the row of each."""
    for b in batches:
        words = b.column(column)
        size = pa.compute.binary_length(words).to_numpy(zero_copy_only=False)
        rows = np.arange(len(words))
        if len(size) and size.max() > PIECE:
            cut = [[w[k : k + PIECE] for k in range(0, max(len(w), 1), PIECE)] for w in words.to_pylist()]
            rows = np.repeat(rows, [len(c) for c in cut])
            words = pa.array([p for c in cut for p in c], pa.binary())
            size = pa.compute.binary_length(words).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size + 1)
        at = 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
            yield words.slice(at, to - at), rows[at:to]
            at = to


def byte_pairs(words: DataFrame) -> tuple[np.ndarray, list[int]]:
    """How often each byte follows each other one (after 0: at a word's start), and the tables' sizes as powers of two.

    There are no more pairs of a context and a byte than bytes in the distinct words, nor more than 2^16 contexts of two bytes."""

    def work(batches):
        total = np.zeros(65536, np.int64)
        for part, _ in _chunks(batches):
            data, starts = laid(part)
            prev = np.zeros(len(data), np.int64)
            prev[1:] = data[:-1]
            prev[starts[:-1]] = 0
            total += np.bincount(prev << 8 | data, minlength=65536)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["at", "n"])

    at, n = [c.to_numpy() for c in words.select("word").mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow().columns]
    out = np.zeros(65536, np.int64)
    out[at] = n
    bits = min(CAP, max(BLOCK_BITS, math.ceil(math.log2(SPARE * n.sum() + 1))))
    return out.reshape(256, 256), [min(bits, 20), bits, bits]


def tables(halves: list[DataFrame], codes) -> list[list[np.ndarray]]:
    """The predictors' tables over the words of each half, and over all. Tasks count in arrays as large as the tables and report the slots that they met by block; one sum for each block reaches the driver."""
    block, sums = 1 << BLOCK_BITS, len(halves) + 1

    def count(batches):
        held = [np.zeros((1 << b) * 2, np.uint16) for b in codes.value.sizes]
        full: list[list[np.ndarray]] = [[] for _ in held]  # where counts gave up FULL, each time
        for part, _ in _chunks(batches):
            bit, _, slots, _ = decisions(part, codes.value)
            for h, f, s in zip(held, full, slots, strict=True):
                where = s.astype(np.int64) << 1 | bit
                np.add.at(h, where, np.uint16(1))
                f.append(np.unique(where[h[where] >= FULL]))
                h[f[-1]] -= np.uint16(FULL)
                if not len(f[-1]):
                    f.pop()
        for k, h in enumerate(held):
            more = np.sort(np.concatenate([np.empty(0, np.int64), *full[k]]))
            for at in range(len(h) // 2 // block):
                first, last = 2 * at * block, 2 * (at + 1) * block
                both = h[first:last].astype(np.int32)
                np.add.at(both, more[np.searchsorted(more, first) : np.searchsorted(more, last)] - first, np.int32(FULL))
                zeros, ones = both.reshape(block, 2).T
                hit = np.flatnonzero(zeros | ones)
                if len(hit):
                    part = hit.astype(np.uint16).tobytes() + zeros[hit].tobytes() + ones[hit].tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([at], pa.int32()), pa.array([part], pa.binary())], ["k", "block", "counts"])

    def total(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((sums, 2, block), np.int64)
        for b in batches:
            for half, c in zip(b.column("half").to_pylist(), b.column("counts"), strict=True):
                part = c.as_buffer()
                n = len(part) // 10
                at = np.frombuffer(part, np.uint16, n)  # distinct
                out[half, :, at] += np.frombuffer(part, np.uint8)[2 * n :].view(np.int32).reshape(2, n).T
        out[-1] = out.sum(0)
        made = level(out[:, 1], out.sum(1))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([zlib.compress(made.tobytes(), 1)], pa.binary())], ["k", "block", "levels"])

    rows = reduce(DataFrame.unionByName, [d.select("word").mapInArrow(count, "k int, block int, counts binary").withColumn("half", F.lit(h)) for h, d in enumerate(halves)])
    rows = rows.groupBy("k", "block").applyInArrow(total, "k int, block int, levels binary").collect()
    out = [[np.full(1 << b, LEVELS // 2, np.uint8) for b in codes.value.sizes] for _ in range(sums)]
    for r in rows:
        for own, made in zip(out, np.frombuffer(zlib.decompress(r.levels), np.uint8).reshape(-1, block), strict=True):
            own[r.k][r.block * block : (r.block + 1) * block] = made
    return out


def decided(words: DataFrame, sent) -> DataFrame:
    """(cell, n, ones): the decisions of all words by cell, and how many of them are ones."""

    def work(batches):
        total = np.zeros((GATES * LEVELS**ORDERS, 2), np.int64)
        for part, _ in _chunks(batches):
            bit, cell, _ = sent.value.cells(part)
            np.add.at(total.reshape(-1), cell * np.int64(2) + bit, 1)
        hit = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit].sum(1)), pa.array(total[hit, 1])], ["cell", "n", "ones"])

    return words.select("word").mapInArrow(work, "cell long, n long, ones long")


def newton(x: np.ndarray, n: np.ndarray, ones: np.ndarray, offset: np.ndarray, start: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression over n decisions a row, of which some are ones, drawn towards start."""

    def loss(w):
        z = x @ w + offset
        return n @ np.logaddexp(0, z) - ones @ z + ridge / 2 * ((w - start) ** 2).sum()

    w, now = start, loss(start)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -50, 50)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (ones - n * p) - ridge * (w - start))
        size = 1.0
        while size > 1e-6 and (new := loss(w + size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - new < 1e-9 * now:
            break
        w, now = w + size * step, new
    return w


def fit(model: Model, sums: np.ndarray) -> None:
    """Set the weights, then the map, by sums (rows as decided gives them)."""
    gate = sums[:, 0] // LEVELS**ORDERS
    for g in np.unique(gate):
        cell, n, ones = sums[gate == g].T.astype(float)
        x = logits(cell.astype(np.int64)).astype(float)
        w = newton(x, n, ones, np.zeros(len(n)), model.weights[g].astype(float))
        z = x @ w
        low, part = knot(z)
        row = np.arange(len(n))
        knots = np.zeros((len(n), CELLS))
        knots[row, low], knots[row, low + 1] = (1 - part) / 2, part / 2
        model.weights[g], model.map[g] = w, newton(knots, n, ones, z / 2, model.map[g].astype(float))
    model.settle()


def learn(words: DataFrame) -> Model:
    """The spelling model of words (word, a, b): a and b count a word in the two halves of the training documents. A word counts once for each half."""
    sc = words.sparkSession.sparkContext
    codes = sc.broadcast(Codes(*byte_pairs(words.where("a + b > 0"))))
    halves = [words.where("a > 0"), words.where("b > 0")]
    *half, whole = tables(halves, codes)
    model = Model(codes.value, whole)
    sent = [sc.broadcast(Model(codes.value, other)) for other in half[::-1]]
    sums = reduce(DataFrame.unionByName, map(decided, halves, sent))
    sums = sums.groupBy("cell").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]]).orderBy("cell").toArrow()
    for x in sent:
        x.destroy()
    fit(model, np.stack([c.to_numpy() for c in sums.columns], 1))
    return model


def word_hashes(words: pa.BinaryArray) -> np.ndarray:
    """The hashes that Tokens gives these words (the end: the empty word)."""
    data, starts = laid(words)
    stop = starts[1:] - 1
    return _summed(data, starts[:-1], np.maximum(stop, starts[:-1] + 1))


def _summed(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of slices: sums of random numbers for the bytes, times powers for their places."""
    up, down = Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_HASHED[data] * up[: len(data)], out=sums[1:])
        return mixed((sums[stop] - sums[start]) * down[start], 0)


class Tokens:
    """The tokens of some texts: hash, kind of the gap before, document, and number within it. The end of a text is a token."""

    def __init__(self, texts: list[str | None], words: bool = False):
        blocks: list[list[bytes]] = [[]]
        size = 0
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass").translate(_LOW)
            at = 0
            while len(raw) - at > BLOCK and (found := _GAP.search(raw, at + BLOCK)):
                blocks += [[raw[at : found.start()]], []]
                at, size = found.start(), 0
            blocks[-1] += [raw[at:], b"\xff"]
            size += len(raw) - at
            if size > BLOCK:
                blocks.append([])
                size = 0
        got = [self._block(np.frombuffer(b"".join(b), np.uint8), words) for b in blocks if b and any(b)]
        self.hash, self.gap, end, self.opening, self.closing = (np.concatenate(x) if got else np.empty(0, d) for x, d in zip(list(zip(*got))[:5] or [()] * 5, (np.uint64, np.uint8, bool, np.uint8, np.uint8), strict=True))
        self.parts = [g[5:] for g in got]
        last = np.flatnonzero(end)
        self.count = np.diff(last, prepend=-1)
        self.first = last + 1 - self.count
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.place = np.arange(len(end)) - np.repeat(self.first, self.count)
        self.end = end

    @staticmethod
    def _block(data: np.ndarray, words: bool) -> tuple:
        end = data == END
        white = _SPACE[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = (white[1:] != white[:-1]) | end[1:] | end[:-1]
        cut = np.flatnonzero(edge)
        tok = ~white[cut[:-1]]
        start, stop = cut[:-1][tok], cut[1:][tok]
        before = np.concatenate([[0], stop[:-1]])
        size = start - before
        head = data[np.maximum(start - 1, 0)]
        first = data[np.minimum(before, len(data) - 1)]
        gap = np.where(size == 0, 0, np.where((size == 1) & (head == 32), 1, np.where((size == 1) & (head == 10), 2, np.where((size == 2) & (head == 10) & (first == 10), 3, np.minimum(size + 3, 255)))))
        return (_summed(data, start, stop), gap.astype(np.uint8), end[start], _KIND[data[start]], _KIND[data[stop - 1]], *((data, start, np.where(end[start], start, stop)) if words else ()))


GAPS = 256


def openings(t: Tokens) -> np.ndarray:
    """For each token: its context across words, times KINDS, and what it begins with."""
    before, ended = np.zeros(len(t.hash), np.uint64), np.zeros(len(t.hash), np.int64)
    before[1:], ended[1:] = t.hash[:-1], t.closing[:-1]
    before[t.first], ended[t.first] = 0, 0  # nothing stands before a text
    slot = ((t.gap != 1).astype(np.int64) << KIND_BITS | ended) << BEFORE | (before >> np.uint64(64 - BEFORE)).astype(np.int64)
    return slot * KINDS + t.opening


class Openings(Model):
    """What tokens begin with, by the contexts across words: counts (half, slot times KINDS and kind) of the training documents.

    One evaluation for each slot and kind, as all contexts follow from the slot; weights and map are fitted to each half's decisions, predicted from the other half."""

    def __init__(self, counts: np.ndarray):
        super().__init__(None, [])
        halves = counts.reshape(2, SLOTS, KINDS)
        sums = np.zeros((2, GATES * LEVELS**ORDERS))
        for own, other in (halves, halves[::-1]):
            cell = self._cells(other)
            for p in self._parts():
                for out, n in zip(sums, self._nodes(own[p]), strict=True):
                    out += np.bincount(cell[p].ravel(), n.ravel(), len(out))
        hit = np.flatnonzero(sums[1])
        fit(self, np.stack([hit, sums[1, hit].astype(np.int64), sums[0, hit].astype(np.int64)], 1))
        cell, kind = self._cells(halves.sum(0)), np.arange(KINDS)
        self.logs = np.concatenate([sum(self.meant[cell[p][:, (1 << d) - 1 + (kind >> KIND_BITS - d)] * 2 + (kind >> KIND_BITS - 1 - d & 1)] for d in range(KIND_BITS)) for p in self._parts()])

    @staticmethod
    def _parts() -> list[slice]:
        """Slots that are worked on at once."""
        return [slice(k, k + SLOTS // 16) for k in range(0, SLOTS, SLOTS // 16)]

    @staticmethod
    def _nodes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ones and all of each decision of the kind's bits."""
        x = np.concatenate([counts.reshape(len(counts), 1 << d, 2, -1).sum(-1) for d in range(KIND_BITS)], 1)
        return x[..., 1], x.sum(-1)

    def _cells(self, counts: np.ndarray) -> np.ndarray:
        gap, ended = (np.repeat(level(*self._nodes(counts.reshape(k, -1, KINDS).sum(1))), SLOTS // k, 0) for k in (2, 2 * KINDS))
        word = np.concatenate([level(*self._nodes(counts[p])) for p in self._parts()])
        depth = np.repeat(np.minimum(np.arange(KIND_BITS), 3), 1 << np.arange(KIND_BITS))
        gate = depth * 8 + _SURE[word] + _FAIRLY[ended]
        return ((gate.astype(np.int32) * LEVELS + gap) * LEVELS + ended) * LEVELS + word


def opened(model: Model, of_kind: np.ndarray, total: int, discount: float, mass: float) -> np.ndarray:
    """log10 probability of each kind under spelling and word counts; of_kind: tokens, and distinct words, of the training documents by kind."""
    codes, first = model.codes, np.arange(256)
    bit, cell, start = model.cells(pa.array([bytes([b]) for b in first], pa.binary()))
    log = np.concatenate([[0.0], np.cumsum(model.meant[cell * 2 + bit], dtype=np.float64)])
    spelled_ = np.bincount(_KIND, 10.0 ** (log[start[:-1] + codes.length[first]] - log[start[:-1]]), KINDS)
    return np.log10((of_kind[0] - discount * of_kind[1]) / max(total, 1) + mass * spelled_)


def _groups(hashes: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the tokens by hash, then place; where a hash begins in that order; how often each token (in that order) occurred before in its document."""
    n = len(hashes)
    bits = max(1, int(n).bit_length())
    low = np.uint64((1 << bits) - 1)
    keys = np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64))
    order = (keys & low).astype(np.int64)
    full = hashes[order]
    new = np.concatenate([[True], full[1:] != full[:-1]])
    if ((keys[1:] >> np.uint64(bits) == keys[:-1] >> np.uint64(bits)) & new[1:]).any():  # two hashes share their upper bits
        order = np.argsort(hashes, kind="stable")
        full = hashes[order]
        new = np.concatenate([[True], full[1:] != full[:-1]])
    own = document[order]
    run = new | np.concatenate([[True], own[1:] != own[:-1]])
    at = np.arange(n)
    return order, new, at - np.maximum.accumulate(np.where(run, at, 0))


def _together(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of about so many bytes."""
    for b in batches:
        at, size = 0, 0
        for k, n in enumerate(pa.compute.fill_null(pa.compute.binary_length(b.column(column)), 0).to_pylist()):
            size += n + 1
            if size >= most or k + 1 == b.num_rows:
                part = b.slice(at, k + 1 - at)
                yield part, part.column(column).to_pylist()
                at, size = k + 1, 0


def counted(docs: DataFrame) -> DataFrame:
    """(word, a, b) for docs (fold, text): how often each word (lower-cased bytes; the end is the empty one) occurs in the two halves of the training documents,
    0 if in others alone; with a null word, and 0 and n, each kind of gap in training documents, and from GAPS on the openings there."""

    def work(batches):
        met = np.zeros((2, SLOTS * KINDS), np.int32)
        for b, texts in _together(batches, 1, TOGETHER):
            t = Tokens(texts, words=True)
            part = b.column(0).to_numpy(zero_copy_only=False)[t.doc]
            order, new, _ = _groups(t.hash, t.doc)
            at = np.flatnonzero(new)
            sums = [np.add.reduceat((part[order] > lo) & (part[order] <= hi), at, dtype=np.int64) for lo, hi in ((0, FIRST), (FIRST, 9))]
            pick = np.sort(order[at])  # the bytes of a word at its first place, block by block
            back = np.argsort(order[at])
            made, base = [], 0
            for data, start, stop in t.parts:
                own = pick[(pick >= base) & (pick < base + len(start))] - base
                base += len(start)
                size = stop[own] - start[own]
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                of = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size) + np.repeat(start[own], size)
                made.append(pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(offsets), pa.py_buffer(data[of])]))
            words = pa.concat_arrays(made) if made else pa.array([], pa.binary())
            yield pa.RecordBatch.from_arrays([words, pa.nulls(len(words), pa.int64()), *[pa.array(s[back]) for s in sums]], names)
            at = openings(t)
            for m, lo, hi in zip(met, (0, FIRST), (FIRST, 9), strict=True):
                np.add.at(m, at[(part > lo) & (part <= hi)], np.int32(1))
            gaps = np.bincount(t.gap[part > 0], minlength=GAPS)
            hit = np.flatnonzero(gaps)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(hit), pa.binary()), pa.array(hit), pa.array(np.zeros_like(hit)), pa.array(gaps[hit])], names)
        hit = np.flatnonzero(met.any(0))
        for k in range(0, len(hit), 1 << 16):
            own = hit[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(own), pa.binary()), pa.array(own + GAPS), *[pa.array(m[own].astype(np.int64)) for m in met]], names)

    names = ["word", "kind", "a", "b"]
    return docs.select("fold", "text").mapInArrow(work, "word binary, kind long, a long, b long")


class Gaps:
    """log10 probability of each gap: by the document's own gaps so far and the corpus' shares; the long ones by their length and characters."""

    def __init__(self, counts: np.ndarray):
        kinds = np.concatenate([counts[:4], [counts[4:].sum()]]) + 0.5
        self.share = kinds / kinds.sum()

    def costs(self, t: Tokens) -> np.ndarray:
        kind = np.minimum(t.gap, 4)
        own = np.zeros(len(kind))
        for k in range(5):
            is_k = kind == k
            seen = np.cumsum(is_k) - is_k
            at = np.flatnonzero(is_k)
            own[at] = seen[at] - np.repeat(seen[t.first], t.count)[at]
        out = np.log10((own + 4 * self.share[kind]) / (t.place + 4))
        return out + np.where(kind == 4, (t.gap.astype(float) - 3) * math.log10(1 / 12), 0)


def spelled(words: DataFrame, model: Model, total: int, discount: float, mass: float) -> DataFrame:
    """(w, c, lp): each word's hash, count in the training documents and log10 probability. Of each count goes the discount; spelling has their share of all."""
    sent = words.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for b in batches:
            lp = np.full(b.num_rows, math.log10(mass))
            for part, rows in _chunks(iter([b])):
                np.add.at(lp, rows, sent.value.costs(part))
            c = b.column(1).to_numpy()
            seen = c > 0
            lp[seen] = np.log10((c[seen] - discount) / max(total, 1) + 10.0 ** np.maximum(lp[seen], -300))
            yield pa.RecordBatch.from_arrays([pa.array(word_hashes(b.column(0)).view(np.int64)), b.column(1), pa.array(lp)], ["w", "c", "lp"])

    return words.select("word", (F.col("a") + F.col("b")).alias("c")).mapInArrow(work, "w long, c long, lp double")


def frequent(words: DataFrame) -> tuple[np.ndarray, ...]:
    """Hashes (ascending), counts and log10 probabilities of the words (w, c, lp) whose count reaches the least level (eighths of a power of two) that no more than HEAD words reach."""
    level = F.floor(F.log2(F.col("c")) * 8).cast("int")
    least, held = 0, 0
    for r in words.where("c > 0").groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # no more than 8 * 63 rows
        held += r["count"]
        if held > HEAD:
            least = r["level"] + 1
            break
    got = words.where(F.col("c") > 0).where(level >= least).toArrow()
    w, c, lp = [x.to_numpy() for x in got.columns]
    order = np.argsort(w.view(np.uint64), kind="stable")
    return w.view(np.uint64)[order], c[order], lp[order]


def _lists(values: np.ndarray, sizes: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def coded(docs: DataFrame, head, gaps: Gaps, gain) -> DataFrame:
    """For each row of docs (doc_id, fold, text): counts and sums over the frequent words, by span; the other words with what the document so far says
    (own: the share that it gives them; rest: what remains for the corpus); the anchors of its spans and their hashes. gain: what the contexts across words add to the log10 probability of an opening; cost2, inside2 and rest2 hold it."""

    def work(batches):
        known, count, logp = head.value
        for b, texts in _together(batches, 2, TOGETHER // 4):
            t = Tokens(texts)
            n, docs_ = len(t.hash), len(texts)
            order, new, before = _groups(t.hash, t.doc)
            kind = np.cumsum(new) - 1
            unique = t.hash[order[new]]
            where = np.minimum(np.searchsorted(known, unique), max(len(known) - 1, 0))
            hit = known[where] == unique if len(known) else np.zeros(len(unique), bool)
            which, seen = np.empty(n, np.int64), np.empty(n, np.int64)
            which[order], seen[order] = kind, before
            in_head = hit[which]
            # the rate of repeats so far in the document, and the word's share of the tokens so far
            again = seen > 0
            so_far = np.cumsum(again) - again
            so_far = so_far - np.repeat(so_far[t.first], t.count)
            rate = 0.35 * (so_far + 0.2) / (t.place + 4.0)
            own = rate * seen / np.maximum(t.place, 1)
            lift = 10.0 ** gain.value[openings(t)].astype(np.float64)
            gap = gaps.costs(t)
            with np.errstate(divide="ignore"):
                told = (1 - rate) * (10.0 ** (logp[where] if len(known) else np.zeros(len(unique))))[which]
                cost, cost2 = (np.where(in_head, np.log10(x + own), 0.0) + gap for x in (told, told * lift))
            base = np.where(in_head, np.log10((count[where] if len(known) else np.zeros(len(unique)))[which] + 0.1), 0.0)
            # anchors: a hash of the last tokens
            with np.errstate(over="ignore"):
                h = t.hash.copy()
                for k in range(1, ANCHOR):
                    h[k:] = h[k:] * np.uint64(0x9E3779B97F4A7C15) + t.hash[:-k]
                h = mixed(h, 5)
            at = np.flatnonzero((h % np.uint64(SPAN) == 0) & (t.place >= ANCHOR - 1) & ~t.end)
            span = np.zeros(n, np.int64)
            span[at] = 1
            span = np.cumsum(span) - span
            span = span - np.repeat(span[t.first], t.count)  # 0: before the first anchor
            stop = np.concatenate([at[1:], [n]]) if len(at) else at
            stop = np.minimum(stop, (t.first + t.count)[t.doc[at]] - 1)
            following = _running(t.hash, at + 1, stop + 1)
            anchors = np.bincount(t.doc[at], minlength=docs_)
            _, first = np.unique(np.stack([t.doc[at].astype(np.uint64), h[at]]), axis=1, return_index=True) if len(at) else (None, np.empty(0, np.int64))
            fresh = np.zeros(len(at), bool)
            fresh[first] = True
            inside, inside2 = ((sums := np.concatenate([[0.0], np.cumsum(x)]))[stop + 1] - sums[at + 1] for x in (cost, cost2))
            out = np.flatnonzero(~in_head)
            others = np.bincount(t.doc[out], minlength=docs_)
            per = lambda x: np.add.reduceat(x, t.first) if n else np.zeros(0)
            size = [len((x or "").encode("utf-8", "surrogatepass")) for x in texts]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(t.count.astype(np.int64)), pa.array(per(in_head.astype(np.int64)).astype(np.int64)), pa.array(per(base)), pa.array(per(cost)), pa.array(per(cost2)),
                _lists(h[at].view(np.int64), anchors, pa.int64()), _lists(following.view(np.int64), anchors, pa.int64()), _lists(inside.astype(np.float32), anchors, pa.float32()), _lists(inside2.astype(np.float32), anchors, pa.float32()), _lists(fresh, anchors, pa.bool_()),
                _lists(t.hash[out].view(np.int64), others, pa.int64()), _lists(span[out].astype(np.int32), others, pa.int32()), _lists(own[out].astype(np.float32), others, pa.float32()), _lists((1 - rate[out]).astype(np.float32), others, pa.float32()), _lists(((1 - rate) * lift)[out].astype(np.float32), others, pa.float32()),
            ], _CODED_NAMES)

    return docs.select("doc_id", "fold", "text").mapInArrow(work, _CODED)


_CODED = "doc_id long, fold int, bytes long, n_tokens long, seen long, logs double, cost double, cost2 double, anchor array<long>, span array<long>, inside array<float>, inside2 array<float>, fresh array<boolean>, w array<long>, at array<int>, own array<float>, rest array<float>, rest2 array<float>"
_CODED_NAMES = [x.split()[0] for x in _CODED.split(", ")]


def _running(h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of runs of tokens."""
    up, down = Powers.of(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mixed(h, 6) * up[: len(h)], out=sums[1:])
        return mixed((sums[stop] - sums[start]) * down[start], 2)


def _gate() -> F.Column:
    """How many other training documents hold the predicted span, and how alone it is there."""
    held = F.when(F.col("others") < 2, 0).when(F.col("others") < 3, 1).when(F.col("others") < 8, 2).otherwise(3)
    alone = F.when(F.col("others") == F.col("all_others"), 2).when(F.col("others") * 2 >= F.col("all_others"), 1).otherwise(0)
    return held * 3 + alone


def predictions(coded_: DataFrame) -> DataFrame:
    """(row, at, held_out, inside, inside2, gate, hit): the spans that other training documents predict, and whether they follow."""
    spans = coded_.where(F.size("anchor") > 0).select("row", (F.col("fold") == 0).alias("held_out"), F.explode(F.arrays_zip(F.sequence(F.lit(1), F.size("anchor")).alias("at"), "anchor", "span", "inside", "inside2", "fresh")).alias("s"))
    spans = spans.select("row", "held_out", "s.*")
    best = spans.where("fresh AND NOT held_out").groupBy("anchor", "span").agg(F.count(F.lit(1)).alias("n"))
    best = best.groupBy("anchor").agg(F.sum("n").alias("total"), F.max(F.struct("n", "span")).alias("top"))
    best = written(best.select("anchor", "total", F.col("top.n").alias("n"), F.col("top.span").alias("follows")), "spans")
    # anchors that very many documents hold meet their spans by broadcast: at most HOT of them, by levels of their counts
    least = 1 << 10
    levels = best.where(F.col("total") >= least).groupBy(F.floor(F.log2("total")).cast("int").alias("level")).count().orderBy(F.desc("level")).collect()  # no more than 63 rows
    held, at_least = 0, 1 << 63
    for r in levels:
        held += r["count"]
        if held > HOT:
            break
        at_least = 1 << r["level"]
    hot = best.where(F.col("total") >= F.lit(min(at_least, (1 << 63) - 1)))
    met = spans.join(F.broadcast(hot), "anchor", "left")
    cold = met.where("total IS NULL").drop("total", "n", "follows").join(best.where("total < %d" % min(at_least, (1 << 63) - 1)), "anchor")
    met = met.where("total IS NOT NULL").unionByName(cold)
    own = (~F.col("held_out")).cast("long")
    met = met.withColumn("hit", F.col("span") == F.col("follows")).withColumn("others", F.col("n") - F.when(F.col("hit"), own).otherwise(0)).withColumn("all_others", F.col("total") - own)
    return met.where("others > 0").select("row", "at", "held_out", "inside", "inside2", _gate().alias("gate"), "hit")


#: Anchors that are broadcast with their spans at most (32 bytes each).
HOT = 1 << 16


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", fold(F.col("doc_id"), 10).cast("int").alias("fold"), "text")
    sc = spark.sparkContext
    found = counted(docs)
    words = written(found.groupBy("word", "kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "words")
    gaps = np.zeros(GAPS)
    for r in words.where("word IS NULL").where(F.col("kind") < GAPS).collect():  # a row for each kind of gap
        gaps[r.kind] = r.b
    at, *halves = [x.to_numpy() for x in words.where("word IS NULL").where(F.col("kind") >= GAPS).select("kind", "a", "b").toArrow().columns]  # no more than SLOTS * KINDS rows
    met = np.zeros((2, SLOTS * KINDS), np.int64)
    met[:, at - GAPS] = halves
    words = words.where("word IS NOT NULL").drop("kind")
    c = F.col("a") + F.col("b")
    first = F.conv(F.hex(F.substring("word", 1, 1)), 16, 10).cast("int").alias("first")
    of_byte = np.zeros((4, 257), np.int64)
    for r in words.groupBy(first).agg(F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)).collect():  # no more than 257 rows
        of_byte[:, END if r[0] is None else r[0]] += r[1:]
    n, v, once, twice = of_byte.sum(1).tolist()
    discount = min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5))
    mass = discount * v / n if n else 1.0
    model = learn(words)
    words = written(spelled(words, model, n, discount, mass), "spelled")
    of_kind = np.stack([np.bincount(_KIND, x[:256], KINDS) for x in of_byte[:2]])
    gain = Openings(met).logs - opened(model, of_kind, n, discount, mass)
    del met
    head = sc.broadcast(frequent(words))
    got = written(coded(docs, head, Gaps(gaps), sc.broadcast(gain.astype(np.float32).ravel())).withColumn("row", F.monotonically_increasing_id()), "coded")
    # the other words meet their counts
    least = F.lit(-300.0)
    other = got.where(F.size("w") > 0).select("row", F.explode(F.arrays_zip("w", "at", "own", "rest", "rest2")).alias("s")).select("row", "s.*").join(words, "w", "left")
    own = F.col("own").cast("double")
    cost, cost2 = (F.when(own > 0, F.log10(own + rest * F.pow(F.lit(10.0), F.greatest("lp", least)))).otherwise(F.log10(rest) + F.col("lp")) for rest in (F.col("rest").cast("double"), F.col("rest2").cast("double")))
    other = other.select("row", "at", cost.alias("cost"), cost2.alias("cost2"), F.when(F.col("c") > 0, 1).otherwise(0).alias("known"), F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1)).alias("rare"))
    other = other.select("row", "at", "cost", "cost2", "known", "rare", F.lit(None).cast("float").alias("inside"), F.lit(None).cast("float").alias("inside2"), F.lit(None).cast("int").alias("gate"), F.lit(None).cast("boolean").alias("hit"))
    spans = written(predictions(got), "predictions")
    rates = {r.gate: (r.hits, r.n) for r in spans.where("NOT held_out").groupBy("gate").agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("n")).collect()}  # 12 rows
    spans = spans.select("row", "at", F.lit(0.0).alias("cost"), F.lit(0.0).alias("cost2"), F.lit(0).alias("known"), F.lit(0.0).alias("rare"), "inside", "inside2", "gate", "hit")
    chance = F.element_at(F.array(*[F.lit((h + 0.5) / (m + 1)) for h, m in (rates.get(g, (0, 0)) for g in range(12))]), F.col("gate") + 1)
    by_span = other.unionByName(spans).repartition("row").groupBy("row", "at").agg(*[F.sum(x).alias(x) for x in ("cost", "cost2", "known", "rare")], *[F.max(x).alias(x) for x in ("inside", "inside2")], F.max("gate").alias("gate"), F.max("hit").alias("hit"))
    more = [F.when(F.col("gate").isNull(), F.col(x)).when(F.col("hit"), F.log10(chance) - F.col(y)).otherwise(F.col(x) + F.log10(1 - chance)) for x, y in (("cost", "inside"), ("cost2", "inside2"))]
    by_row = by_span.select("row", "known", "rare", more[0].alias("more"), more[1].alias("more2")).groupBy("row").agg(*[F.sum(x).alias(x) for x in ("known", "rare", "more", "more2")])
    got = got.select("row", "doc_id", "fold", "bytes", "n_tokens", "seen", "logs", "cost", "cost2").join(by_row, "row", "left")
    zero = F.lit(0.0)
    base = F.col("logs") + F.coalesce("rare", zero) - F.col("n_tokens") * F.log10(F.lit(n + 0.1 * (v + 1)))
    score, context_score = (F.col(x) + F.coalesce(y, zero) for x, y in (("cost", "more"), ("cost2", "more2")))
    return got.select("doc_id", (F.col("fold") == 0).alias("held_out"), "n_tokens", (F.col("seen") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"), (-score * math.log2(10) / F.greatest(F.col("bytes"), F.lit(1))).alias("bits_per_byte"), context_score.alias("context_score"))


QUERIES, ORACLES = {"op1_mixer": query}, {}
