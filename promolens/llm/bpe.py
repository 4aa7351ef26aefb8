"""Byte-level BPE with a minimal acyclic transducer lexicon.

The corpus' most frequent words are encoded once, by merging, and compiled into a deterministic automaton in which
equal suffixes share their states. Each transition carries the number of words that come before those behind it, so
that a walk sums up to the word's ordinal, and the ordinal gives the word's slice of ids: a transducer from words to
ids. It is laid out in flat arrays and memory-mapped by each Python worker. Words that it lacks are merged exactly,
pair by pair in order of rank, with a heap for long words.

Words are counted over all documents; the lexicon keeps the most frequent ones of at most LONGEST bytes: those whose
count reaches the least level (eighths of a power of two) that no more than LEXICON words reach, so the broadcast has a
fixed bound and nothing is sorted. Whatever the lexicon holds, the ids are the same.

Defined results: a null or empty text has no ids; special tokens' strings in a text become their ids, as the library does;
ids are decoded with bytes that are not UTF-8 replaced. Repeated rows, null ids and extra columns pass through.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import mmap
import re
import struct
import tempfile
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import table, written

#: Words of the lexicon and bytes of each, at most.
LEXICON, LONGEST = 1 << 16, 64
#: Distinct words that a worker remembers or counts at a time.
REMEMBERED = 300_000
#: Bytes of the words that are looked up together; characters of the texts that are.
WIDTHS, TOGETHER = (8, 16, 32), 1 << 20


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: visible Latin-1 characters are themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(shown))}


#: Fixed value: how byte-level BPE splits a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranges(kind: str) -> str:
    """The characters below U+10000 that match kind, as the inside of a set for Python's own matcher."""
    below = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    return "".join(re.escape(m[0][0]) + "-" + re.escape(m[0][-1]) for m in regex.finditer(f"(?:{kind})+", below))


@functools.cache
def plain_pattern() -> re.Pattern:
    """The same as PATTERN for texts without characters from U+10000 on: Python's own matcher takes less than half the time."""
    letters, digits, space = _ranges(r"\p{L}"), _ranges(r"\p{N}"), _ranges(r"\s")
    return re.compile(f"'(?:[smtd]|re|ve|ll)| ?[{letters}]+| ?[{digits}]+| ?[^{space}{letters}{digits}]+|[{space}]+(?![^{space}])|[{space}]+")


def is_plain(text: str) -> bool:
    return text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)


class Merger:
    """The vocabulary: exact merging of a word's bytes, and the bytes of each id."""

    def __init__(self, vocabulary: bytes):
        spec, byte = json.loads(vocabulary), _alphabet()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.single = [0] * 256
        for c, b in byte.items():
            self.single[b] = ids[c]
        self.ranks: dict[tuple[int, int], int] = {}  # of a pair of ids
        self.made: list[int] = []  # the id that the pair of each rank becomes
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[a], ids[b]] = rank
            self.made.append(ids[a + b])
        self.reach = max(ids.values()) + 1
        keys = np.fromiter((a * self.reach + b for a, b in self.ranks), np.int64, len(self.ranks))
        by = np.argsort(keys)
        self.pairs = np.append(keys[by], np.iinfo(np.int64).max), np.append(np.fromiter(self.ranks.values(), np.int32, len(keys))[by], len(self.made)).astype(np.int32)
        self.bytes = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()

    def merge(self, word: bytes) -> list[int]:
        ids = [*map(self.single.__getitem__, word)]
        if len(ids) > 96:
            return self._merge_long(ids)
        get, none = self.ranks.get, len(self.made)
        ranks = [*map(get, zip(ids, ids[1:]), itertools.repeat(none))]  # noqa: B905
        while ranks and (rank := min(ranks)) < none:
            at = ranks.index(rank)
            ids[at : at + 2] = [self.made[rank]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), none)
        return ids

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of merges for pairs that are none, such as those with -1."""
        key = left.astype(np.int64) * self.reach + right
        at = np.searchsorted(self.pairs[0], key)
        return np.where((self.pairs[0][at] == key) & (left >= 0) & (right >= 0), self.pairs[1][at], np.int32(len(self.made)))

    def merge_all(self, letters: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """merge() of many words at once, each a row of letters: every round replaces one pair of each word that still has one."""
        n, width = letters.shape
        out, row, column = [b""] * n, np.arange(n), np.arange(width)
        ids = np.array(self.single, np.int32)[letters]
        ids[column >= lengths[:, None]] = -1
        ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)
        none, made = len(self.made), np.array([*self.made, -1], np.int32)
        ranks = self._ranked(ids[:, :-1], ids[:, 1:])
        while len(row):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(row)), at]
            if len(done := np.flatnonzero(best == none)):
                whole, step = np.ascontiguousarray(ids[done], "<i4").tobytes(), 4 * (width + 1)
                for k, (r, size) in enumerate(zip(row[done].tolist(), (ids[done] >= 0).sum(1).tolist(), strict=True)):
                    out[r] = whole[k * step : k * step + 4 * size]
                on = best < none
                row, ids, ranks, at, best = row[on], ids[on], ranks[on], at[on], best[on]
            k, at = np.arange(len(row)), at[:, None]
            moved = np.take_along_axis(ids, np.minimum(column + (column > at), width), 1)
            ids[:, :-1], ids[:, -1] = moved, -1
            at = at[:, 0]
            ids[k, at] = made[best]
            ranks = np.take_along_axis(np.pad(ranks, ((0, 0), (0, 1)), constant_values=none), column + (column >= at[:, None]), 1)
            ranks[k, at] = self._ranked(ids[k, at], ids[k, at + 1])
            back = k[at > 0]
            ranks[back, at[back] - 1] = self._ranked(ids[back, at[back] - 1], ids[back, at[back]])
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same in n log n: a heap of pairs over a linked list; stale entries are passed over."""
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(rank, k, ids[k], ids[k + 1]) for k in range(n - 1) if (rank := self.ranks.get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, left, right = heapq.heappop(heap)
            j = after[k]
            if j < 0 or ids[k] != left or ids[j] != right:
                continue
            ids[k], ids[j] = self.made[rank], -1
            after[k] = after[j]
            if after[k] >= 0:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b >= 0 and (rank := self.ranks.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (rank, a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The transducer of the words, as bytes.

    Words come in ascending order, so the states of the last word that the next one does not share are final: each is
    replaced by an equal state if there is one. A state's transitions lie together, in ascending order of their bytes."""
    words = sorted(w for w in entries if w)
    known: dict[tuple, int] = {}
    states: list[tuple] = []  # (accepting, ((byte, target), ...))

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path: list[list] = [[False, []]]  # the open states along the last word
    last = b""
    for w in words:
        shared = 0
        while shared < min(len(w), len(last)) and w[shared] == last[shared]:
            shared += 1
        while len(path) > shared + 1:
            done = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        for _ in range(shared, len(w)):
            path.append([False, []])
        path[-1][0] = True
        last = w
    while len(path) > 1:
        done = settle(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    root = settle(path[0])
    count = [0] * len(states)  # words from each state on; targets come before their sources
    for k, (accepts, moves) in enumerate(states):
        count[k] = accepts + sum(count[t] for _, t in moves)
    first, accept, label, target, ahead = [0], [], [], [], []
    for accepts, moves in states:
        passed = int(accepts)
        for b, t in moves:
            label.append(b)
            target.append(t)
            ahead.append(passed)
            passed += count[t]
        accept.append(accepts)
        first.append(len(label))
    start, ids = [0], []
    for w in words:
        ids += entries[w]
        start.append(len(ids))
    arrays = [np.array(x, t) for x, t in ((first, "<u4"), (accept, "u1"), (label, "u1"), (target, "<u4"), (ahead, "<u4"), (start, "<u4"), (ids, "<u4"))]
    return struct.pack("<8I", root, *map(len, arrays)) + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, mapped from a file without a name: pages are shared and go with the process."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(blob)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view, self.root, *n = memoryview(self.map), *struct.unpack_from("<8I", self.map)
        at, got = 32, []
        for size, kind in zip(n, "IBBIIII", strict=True):
            end = at + size * struct.calcsize("<" + kind)
            got.append(view[at:end].cast(kind))
            at = end
        self.first, self.accept, self.label, self.target, self.ahead, self.start, self.ids = got
        size = np.diff(np.frombuffer(self.first, "<u4"))
        self.moves = np.append(np.repeat(np.arange(len(size), dtype=np.int64), size) * 256 + np.frombuffer(self.label, "u1"), np.iinfo(np.int64).max)  # ascending

    def find_all(self, letters: np.ndarray, lengths: np.ndarray) -> list[bytes | None]:
        """find() of many words at once, each a row of letters."""
        at, passed, alive = np.full(len(letters), self.root, np.int64), np.zeros(len(letters), np.int64), np.ones(len(letters), bool)
        target, ahead = np.frombuffer(self.target, "<u4"), np.frombuffer(self.ahead, "<u4")
        for k in range(letters.shape[1]):
            on = np.flatnonzero(alive & (lengths > k))
            key = at[on] * 256 + letters[on, k]
            move = np.searchsorted(self.moves, key)
            hit = self.moves[move] == key
            alive[on[~hit]] = False
            on, move = on[hit], move[hit]
            at[on] = target[move]
            passed[on] += ahead[move]
        alive &= np.frombuffer(self.accept, "u1")[at] > 0
        return [self.ids[self.start[p] : self.start[p + 1]].tobytes() if ok else None for ok, p in zip(alive.tolist(), passed.tolist(), strict=True)]

    def find(self, word: bytes) -> bytes | None:
        """The word's ids as little-endian 32-bit integers."""
        at, passed, first, label = self.root, 0, self.first, self.label
        for b in word:
            hi = first[at + 1]
            k = bisect_left(label, b, first[at], hi)
            if k == hi or label[k] != b:
                return None
            passed += self.ahead[k]
            at = self.target[k]
        return self.ids[self.start[passed] : self.start[passed + 1]].tobytes() if self.accept[at] else None


class Coder(dict):
    """Encodes and decodes; as a dict it remembers the words of this worker, a bounded number at a time."""

    def __init__(self, vocabulary: bytes, lexicon: bytes | None):
        self.merger, self.lexicon = Merger(vocabulary), Lexicon(lexicon) if lexicon else None
        self.frequent: dict[str, bytes] = {}  # what the lexicon held; as bounded as it is
        self.any, self.plain = regex.compile(PATTERN).findall, plain_pattern().findall
        special = self.merger.special
        self.specials = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        ids = self.lexicon.find(raw) if self.lexicon else None
        if ids is not None:
            self.frequent[word] = ids
        else:
            ids = struct.pack(f"<{len(m := self.merger.merge(raw))}I", *m)
        self[word] = ids
        return ids

    def split(self, part: str) -> list[str]:
        return self.plain(part) if is_plain(part) else self.any(part)

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        parts = self.specials.split(text) if self.specials else [text]
        return ((bool(k % 2), p) for k, p in enumerate(parts) if p)

    def learn(self, words: list[str]) -> None:
        """Looks new words up, those of about a size at once; longer ones are left to __missing__."""
        raw = [w.encode() for w in words]
        least = 0
        for width in WIDTHS:
            some = [k for k, r in enumerate(raw) if least < len(r) <= width]
            least = width
            if not some:
                continue
            lengths = np.array([len(raw[k]) for k in some])
            letters = np.frombuffer(b"".join(raw[k].ljust(width, b"\0") for k in some), np.uint8).reshape(-1, width)
            found = self.lexicon.find_all(letters, lengths) if self.lexicon else [None] * len(some)
            for k, ids in zip(some, found, strict=True):
                if ids is not None:
                    self[words[k]] = self.frequent[words[k]] = ids
            rest = np.array([k for k, ids in enumerate(found) if ids is None], np.int64)
            for k, ids in zip(rest.tolist(), self.merger.merge_all(letters[rest], lengths[rest]), strict=True):
                self[words[some[k]]] = ids

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self) >= REMEMBERED:
            self.clear()
            self.update(self.frequent)
        special, get = self.merger.special, self.__getitem__
        split = [[(fixed, part if fixed else self.split(part)) for fixed, part in self.pieces(t)] for t in texts]
        seen = set(itertools.chain.from_iterable(part for parts in split for fixed, part in parts if not fixed))
        self.learn([w for w in seen if w not in self])
        return [b"".join(itertools.chain.from_iterable([struct.pack("<I", special[part])] if fixed else map(get, part) for fixed, part in parts)) for parts in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers; about TOGETHER characters are worked on at once, or one text."""
        out, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= TOGETHER:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def decode(self, ids: bytes) -> str:
        known = self.merger.bytes
        return b"".join(map(known.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_coders: dict[str, Coder] = {}


def coder(vocabulary, lexicon=None) -> Coder:
    """This worker's coder for two broadcasts; the last one stays for the next task."""
    key = f"{vocabulary.value[0]}/{lexicon.value[0] if lexicon else ''}"
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(vocabulary.value[1], lexicon.value[1] if lexicon else None)
    return _coders[key]


def _sent(spark: SparkSession, blob: bytes):
    return spark.sparkContext.broadcast((hashlib.sha256(blob).hexdigest(), blob))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def word_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """(word, n) over all texts. A task counts a bounded number of distinct words at a time; Spark sums them up."""

    def count(batches):
        code, seen = coder(vocabulary), Counter()

        def out():
            items = list(seen.items())
            seen.clear()
            for k in range(0, len(items), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in items[k : k + 10_000]], pa.string()), pa.array([n for _, n in items[k : k + 10_000]], pa.int64())], ["word", "n"])

        for b in _slices(batches):
            for text in b.column(0).to_pylist():
                for fixed, part in code.pieces(text or ""):
                    if not fixed:
                        seen.update(code.split(part))
            if len(seen) > REMEMBERED:
                yield from out()
        yield from out()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary, size: int = LEXICON) -> bytes:
    """The counts are written once; the driver gets a number of words for each level, then at most size words."""
    level = F.floor(F.log2("n") * 8).cast("int")
    counts = written(word_counts(docs, vocabulary).where(F.octet_length("word") <= LONGEST).select("word", level.alias("level")), "words")
    least, held = 0, 0
    for r in counts.groupBy("level").count().orderBy(F.desc("level")).collect():  # no more than 8 * 63 rows
        held += r["count"]
        if held > size:
            least = r["level"] + 1
            break
    merge = Merger(vocabulary.value[1]).merge
    return compile_lexicon({w: merge(w) for (w,) in ((r.word.encode(),) for r in counts.where(F.col("level") >= least).select("word").collect())})


def encoded(docs: DataFrame, path: str | None = None, size: int = LEXICON, ids: bool = False) -> DataFrame:
    """docs' columns but text, with n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids themselves."""
    spark = docs.sparkSession
    with open(path or vocabulary_path(), "rb") as f:
        vocabulary = _sent(spark, f.read())
    lexicon = _sent(spark, build_lexicon(docs, vocabulary, size))
    kept = [c for c in docs.columns if c not in {"text", "n_tokens", "ids_sha256", "decoded_sha256", "ids"}]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema) + (", " if kept else "") + "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def work(batches):
        code = coder(vocabulary, lexicon)
        for b in _slices(batches):
            made = code.encode([t or "" for t in b.column(b.num_columns - 1).to_pylist()])
            columns = [*b.columns[:-1], pa.array([len(m) // 4 for m in made], pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in made]), pa.array([hashlib.sha256(code.decode(m).encode()).hexdigest() for m in made])]
            if ids:
                columns.append(pa.array([np.frombuffer(m, "<i4") for m in made], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids])

    return docs.select(*kept, "text").mapInArrow(work, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES, ORACLES = {"op2_bpe": query}, {}
