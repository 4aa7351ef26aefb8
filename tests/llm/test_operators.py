"""The training-data operators against brute force, round trips and defined edge cases, on small tables."""

import base64
import hashlib
import math
import pickle
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from promolens.llm import bpe, graph, jaccard, licenses, lines, mixer, mixing, quality, spotsigs, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, taken string"
rng = random.Random(5)
WORDS = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "in", "kappa7", "éta", "x9"]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = [prose(120) for _ in range(6)]
    near = [" ".join(w if k not in (7, 60) else "edited" for k, w in enumerate(b.split())) for b in base[:3]]
    texts = [*base, *near, base[0], base[0], None, "", "  \n\t ", "one", "one", "!!! ???", "same line of a text\n" + prose(30), "same line of a text\n" + prose(30), prose(20000)]
    out = [(k, t, "en", "hot" if k % 3 else None, None, "clash", None) for k, t in enumerate(texts)]
    return [*out, (None, base[1], None, "a", 1, None, "x"), out[4], out[4]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_jaccard(docs, rows, empty):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        sets.setdefault(i if i is not None else -1, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    label = {i: i for i in sets}
    for _ in sets:
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    got = {(r.doc_id if r.doc_id is not None else -1): (r.n_shingles, r.component_id if r.component_id is not None else -1) for r in jaccard.join(docs).collect()}
    assert got == {i: (len(sets[i]), label[i]) for i in sets}
    kept = [r.doc_id if r.doc_id is not None else -1 for r in jaccard.distinct_documents(docs).collect()]
    assert sorted(kept) == sorted({label[i] for i in sets})
    assert jaccard.join(empty).count() == 0


def test_distinct_documents_links_rows_by_text_alone(spark):
    texts = [prose(60) for _ in range(7)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (5, texts[4]), (6, texts[0]), (7, texts[5]), (3, texts[5]), (8, texts[6]), (None, ""), (None, None)]
    got = [tuple(r) for r in jaccard.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    want = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (3, texts[5]), (8, texts[6]), (None, ""), (None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bpe(docs, rows, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.vocabulary_path())
    got = {r.doc_id: r for r in bpe.encoded(docs, size=50, ids=True).collect()}
    for i, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert (got[i].ids, got[i].n_tokens) == (ids, len(ids))
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encoded(empty).count() == 0
    coder = bpe.Coder(open(bpe.vocabulary_path(), "rb").read(), None)
    for t in ["a" * 3000, "<|endoftext|> x<|endoftext|>", "\u0085 \x1c  y", "日本語🙂", "don't  \n\n stop"]:
        assert [i for (i,) in struct.iter_unpack("<I", coder.encode([t])[0])] == tok.encode(t, add_special_tokens=False).ids


def test_transducer_shares_suffixes():
    entries = {w: [k, k + 1] for k, w in enumerate([b"walking", b"talking", b"king", b"kings", b"t"])}
    lex = bpe.Lexicon(bpe.compile_lexicon(entries))
    assert {w: lex.find(w) for w in entries} == {w: struct.pack("<2I", *v) for w, v in entries.items()}
    assert lex.find(b"walk") is None and lex.find(b"") is None
    asked = [*entries, b"walk", b"kin", b"q", b"walkings"]
    letters = np.frombuffer(b"".join(w.ljust(8, b"\0") for w in asked), np.uint8).reshape(-1, 8)
    assert lex.find_all(letters, np.array([*map(len, asked)])) == [lex.find(w) for w in asked]
    assert len(lex.accept) < sum(map(len, entries))


def test_merging_together_equals_merging_each():
    merger = bpe.Merger(open(bpe.vocabulary_path(), "rb").read())
    words = [bytes(rng.choice(b"abcdeerstainn \xc3\xa9") for _ in range(rng.randint(1, 32))) for _ in range(3000)] + [b"a", b"aaaaaaaa", b"ab" * 16]
    letters = np.frombuffer(b"".join(w.ljust(32, b"\0") for w in words), np.uint8).reshape(-1, 32)
    want = [struct.pack(f"<{len(ids)}I", *ids) for ids in map(merger.merge, words)]
    assert merger.merge_all(letters, np.array([*map(len, words)])) == want
    assert [merger._merge_long([merger.single[b] for b in w]) for w in words] == [*map(merger.merge, words)]



def test_lines(docs, rows, empty):
    got = lines.deduplicated(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    assert by[17]["__l_dropped"] == 0 and by[18]["__l_dropped"] == 1 and "same line" not in by[18]["__l_kept"]
    assert by[0]["__l_dropped"] == 0 and by[9]["__l_kept"] == ""
    assert by[11]["__l_kept"] == "" and by[15]["__l_dropped"] == 1 and by[4]["__l_dropped"] == 0
    cleaned = lines.cleaned(docs)
    assert cleaned.columns == docs.columns and 9 not in {r.doc_id for r in cleaned.collect()}
    assert lines.deduplicated(empty).count() == 0


def test_lines_of_hot_and_other_templates(docs, monkeypatch):
    def got():
        return Counter((r.doc_id, r["__l_dropped"], r["__l_kept"]) for r in lines.deduplicated(docs).collect())

    by_broadcast = got()
    monkeypatch.setattr(lines, "HOT", 1)  # no template is hot
    assert got() == by_broadcast and any(k[1] for k in by_broadcast)


@pytest.mark.parametrize("ids", [[5], [7] * 50, list(range(1000)), [-(1 << 63)] * 40 + [1 << 40, 3, 4, 5] + list(range(9, 300)) + [(1 << 63) - 1], [k * k * k for k in range(-200, 200)]])
def test_spotsigs_ranges(spark, ids):
    d = spark.createDataFrame([(k,) for k in ids], "__id long").repartition(3)
    for ranges in (1 << 16, 5):
        firsts = spotsigs.range_firsts(d, 8, ranges)
        assert firsts == sorted(set(firsts)) and firsts[0] == min(ids) and set(firsts) <= set(ids)
        got = Counter(max(f for f in firsts if f <= k) for k in ids)
        most = max(8, -(-len(ids) // ranges))
        assert all(n <= 2 * most or len({k for k in ids if max(f for f in firsts if f <= k) == f0}) == 1 for f0, n in got.items())
        assert len(firsts) <= max(2, 2 * len(ids) // most + 2)
    assert spotsigs.range_firsts(d.limit(0)) == [0]


def test_spotsigs(docs, rows, empty):
    d = spotsigs.with_next(docs, rows=4).collect()
    assert len(d) == len(rows)
    ordered = sorted(((i if i is not None else -1 << 63, t or "") for i, t, *_ in rows))
    follow = {}
    for k, (i, t) in enumerate(ordered):
        follow.setdefault((i, t), []).append(ordered[(k + 1) % len(ordered)][1])
    for r in d:
        assert r["__next"] in follow[r.doc_id if r.doc_id is not None else -1 << 63, r.text]
    common = set(spotsigs.COMMON)
    for r in d:
        w = [x for x in re.split(r"[\W_]+", r.text.lower()) if x]
        chains = set()
        for k, x in enumerate(w):
            after = [y for y in w[k + 1 :] if y not in common][:2]
            if x in common and len(after) == 2:
                chains.add((x, *after))
        assert len(r["__sigs"]) == (len(chains) or (r.text != ""))
    assert spotsigs.with_next(empty).count() == 0
    pairs = {(r.a, r.b) for r in spotsigs.near_pairs(docs.where("doc_id < 9"), 0.5).collect()}
    sets = {r.doc_id: set(r["__sigs"]) for r in d if r.doc_id is not None and r.doc_id < 9}
    assert pairs == {(a, b) for a in sets for b in sets if a < b and sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}


def test_mixing(docs, rows, empty):
    m = [r.asDict() for r in mixing.mix(docs).collect()]
    assert len(m) == len(rows)
    total, by = sum(r["__mix_size"] for r in m), {}
    for r in m:
        s = by.setdefault(r["source"], [0, r["__mix_source_size"], r["__mix_target"], 0])
        s[0] += r["__mix_size"]
        t = math.floor(r["__mix_target"] + 0.5)
        s[3] += sum(max(0, min(r["__mix_size"], t - r["__mix_before"] - k * r["__mix_source_size"])) for k in (0, 1))
    assert all(s[0] == s[1] and s[2] <= 2 * s[1] and s[3] == math.floor(s[2] + 0.5) for s in by.values())
    assert abs(sum(s[2] for s in by.values()) - 1.5 * total) < 1e-6 * total
    assert mixing.sequence(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0
    many = [(None, prose(k % 7), "en", "s", None, None, None) for k in range(60)] + [(k, prose(5), "en", "s", None, None, None) for k in range(60)]
    m = mixing.mix(docs.sparkSession.createDataFrame(many, SCHEMA).repartition(4), rows=1 << 20).collect()
    m.sort(key=lambda r: (hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest(), r["__mix_size"], r["__mix_before"]))
    assert sorted(r["__mix_before"] for r in m) == [r["__mix_before"] for r in m] and len(m) == 120
    assert all(b["__mix_before"] - a["__mix_before"] == a["__mix_size"] for a, b in zip(m, m[1:]))


def test_quality(spark, docs, empty):
    d = spark.createDataFrame([(k, ("GOOD " if k % 2 else "nice ") * 20) for k in range(400)], "doc_id long, text string")
    labels = d.select("doc_id", F.when(F.col("doc_id") % 2 == 1, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    model = quality.learn(d, labels)
    got = quality.score(d, model).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in got) and len(model[1]) < 40
    assert all(0 <= r.score <= 1 for r in quality.score(docs, model).collect())
    assert quality.learn(empty, labels.limit(0)) == (0.0, [])
    assert quality.kept(docs, labels.limit(0)).columns == docs.columns


def test_warc(spark, tmp_path):
    big = "x" * 1200
    pages = spark.createDataFrame([(1, "http://a/é\r\n", big, 0), (2, None, big, 1), (2, None, big, 1), (3, "http://b", None, 2), (4, "http://c", "a\r\n\r\nWARC/1.1 b", 3), (None, "u", big, 4)], "page_id long, url string, html string, digest int")
    warc.write(pages, str(tmp_path / "w"))
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(spark, str(tmp_path / "w")).collect())
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    body = "a\r\n\r\nWARC/1.1 b"
    assert got == sorted([("1", 1200, sha(big), "revisit", "2"), ("2", 1200, sha(big), "response", None), ("2", 1200, sha(big), "response", None), ("3", 0, sha(""), "response", None), ("4", len(body), sha(body), "response", None), ("null", 1200, sha(big), "revisit", "2")])


def test_salvage():
    def record(i, p):
        b = warc.HTTP.encode() + p
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{hashlib.sha1(p).hexdigest()}\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n"

    for pack in (bytes, warc.member):
        parts = [pack(record(i, b"hello %d " % i * 30)) for i in range(5)]
        bad = bytearray(b"".join(parts))
        bad[len(parts[0]) + len(parts[1]) // 2] ^= 255
        out = list(warc.salvage(bytes(bad)))
        assert [x[0] for x in out] == ["record", "gap", "record", "record", "record"]
        assert (out[1][1], out[1][2]) == (len(parts[0]), len(parts[1])) and sum(x[2] for x in out) == len(bad)
    assert list(warc.salvage(b"")) == [] and next(iter(warc.salvage(b"junk")))[0] == "gap"


def test_salvage_of_members_with_several_records():
    def record(i, p, digest):
        b = warc.HTTP.encode() + p
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{digest(hashlib.sha1(p))}\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n"

    forms = [lambda h: h.hexdigest(), lambda h: h.hexdigest().upper(), lambda h: base64.b32encode(h.digest()).decode(), lambda h: base64.b32encode(h.digest()).decode().lower()]
    noise = np.random.default_rng(3)
    parts = [record(i, noise.integers(97, 123, 3000, dtype=np.uint8).tobytes(), forms[i % 4]) for i in range(12)]
    kinds = lambda data: [x[0] for x in warc.salvage(data)]
    assert kinds(b"".join(parts)) == kinds(warc.member(b"".join(parts))) == ["record"] * 12
    whole = warc.member(parts[0] + b"junk" + parts[1])
    assert [x[:3] for x in warc.salvage(whole)] == [(k, 0, len(whole)) for k in ("record", "gap", "record")]
    packed = warc.member(b"".join(parts))
    cut = kinds(packed[: len(packed) * 2 // 3])
    assert cut.count("record") >= 6 and cut[-1] == "gap"
    bad = bytearray(packed)
    bad[len(bad) * 2 // 3 :] = b"\xff" * (len(bad) - len(bad) * 2 // 3)
    assert kinds(bytes(bad) + warc.member(parts[3])).count("record") >= 7


def test_graph(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(700, 8)).astype(np.float32)
    x[50:90] = x[3]
    data = [(k, v.tolist(), 0) for k, v in enumerate(x)] + [(9000, None, 0), (9001, [0.0] * 8, 0), (9002, [float("nan")] * 8, 0), (9003, [], 0), (None, [1.0] * 8, 0)]
    d = graph.usable(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int"))
    assert d.count() == 700
    g = graph.index(d, shard=300).cache()
    got = {}
    for row in graph.nearest(g, d.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    hit = 0
    for q in range(0, 700, 100):
        dist = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        dist[q] = np.inf
        want = np.lexsort((np.arange(700), dist))[:10]
        hit += len(set(want) & {v for v, _ in got[q]})
        assert [s for _, s in got[q]] == sorted(s for _, s in got[q]) and len(got[q]) == 10
        assert all(abs(s - dist[v]) < 1e-12 for v, s in got[q])
    assert hit >= 63
    assert graph.index(d.limit(0)).count() == 0


def test_licenses(docs, empty):
    filler = prose(400)
    mit = licenses.TEMPLATES["mit"].replace("hereby ", "")
    text = f"{filler} {licenses.TEMPLATES['mit-line']} {filler} {mit} {filler} all rights reserved. {filler}"
    lists = {k: licenses.words(v) for k, v in licenses.TEMPLATES.items()}
    found = licenses.scan(text, lists)
    assert {f[0] for f in found} >= {"mit-line", "mit", "all-rights-reserved"} and all(f[1] >= 0.8 for f in found)
    assert licenses.scan(filler, lists) == [] and licenses.scan("", lists) == []
    assert licenses.rising([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    got = licenses.scanned(docs).collect()
    assert all(r.finds == [] for r in got) and licenses.scanned(empty).count() == 0


def test_licenses_close_together():
    lists = {k: licenses.words(v) for k, v in licenses.TEMPLATES.items()}
    names = lambda text: [f[0] for f in licenses.scan(text, lists)]
    assert names("Copyright A. All rights reserved. Copyright B. All rights reserved. The rest of the text goes on.") == ["all-rights-reserved"] * 2
    mit = licenses.TEMPLATES["mit"]
    edited = [mit, mit.replace("hereby ", ""), mit.replace("publish, distribute, sublicense", "print, hand out, license"), mit.replace("The above", "Here the above")]
    for n in (2, 3, 4, 9):
        for between in (" ", " Copyright someone else. ", " " + prose(50) + " "):
            found = [f for f in licenses.scan(prose(60) + " " + between.join(edited[k % 4] for k in range(n)) + " " + prose(60), lists) if f[0] == "mit"]
            assert len(found) == n and all(f[1] >= 0.9 for f in found)
            assert all(a[3] <= b[2] for a, b in zip(found, found[1:]))


def plain_tokens(text):
    """(gap, word) of a text, the end being the empty word."""
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    out, at = [], 0
    for m in re.finditer(r"[^\x20\x09-\x0D]+", low):
        out.append((low[at : m.start()], m.group()))
        at = m.end()
    return [*out, (low[at:], "")]


def test_mixer_by_brute_force(spark, rows, tmp_path, monkeypatch):
    """The query against plain Python: base columns, and the score from the model's spelling of each word."""
    rows = [(i, t if t is None or len(t) < 9000 else t[:9000]) for i, t, *_ in rows] + [(100 + k, prose(60) + " w" + "x" * k) for k in range(40)] + [(300, "y" * 9000 + " y"), (301, "\n\n \t a\n\nb\tc ")]
    rows += [(400 + k, rows[-5 - k % 2][1]) for k in range(6)]
    spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, score string, row long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for name, value in (("BLOCK", 256), ("TOGETHER", 4096), ("CHUNK", 512), ("PIECE", 700), ("HEAD", 9), ("SPAN", 4)):
        monkeypatch.setattr(mixer, name, value)
    models, learn = [], mixer.learn
    monkeypatch.setattr(mixer, "learn", lambda words: models.append(learn(words)) or models[-1])
    got = sorted(mixer.query(spark, str(tmp_path)).collect(), key=str)
    part = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    texts = [(i, part(i), plain_tokens(t)) for i, t in rows]
    count = Counter(w for _, f, t in texts if f for _, w in t)
    n, v = sum(count.values()), len(count)
    once, twice = [sum(c == k for c in count.values()) for k in (1, 2)]
    discount = min(0.95, max(0.05, once / (once + 2 * twice)))
    spelling = lambda w: sum(models[0].costs(pa.array([x], pa.binary()))[0] for x in ([w[k : k + 700] for k in range(0, len(w), 700)] or [w]))
    lp = {w: math.log10(discount * v / n) + spelling(w.encode()) for w in {w for *_, t in texts for _, w in t}}
    lp = {w: math.log10((count[w] - discount) / n + 10 ** max(x, -300)) if count[w] else x for w, x in lp.items()}
    kind = lambda g: {"": 0, " ": 1, "\n": 2, "\n\n": 3}.get(g, 4)
    gaps = Counter(kind(g) for _, f, t in texts if f for g, _ in t)
    share = {k: (gaps[k] + 0.5) / (sum(gaps.values()) + 2.5) for k in range(5)}
    hashes = {w: int(mixer.word_hashes(pa.array([w.encode()], pa.binary()))[0]) for w in lp}
    coded, held = [], {}
    for i, f, t in texts:
        cost, again, seen, own = [], 0, Counter(), Counter()
        for k, (g, w) in enumerate(t):
            rate = 0.35 * (again + 0.2) / (k + 4)
            repeats = rate * seen[w] / max(k, 1)
            word = math.log10(1 - rate) + lp[w] if not seen[w] else math.log10((1 - rate) * 10 ** max(lp[w], -300) + repeats)
            gap = math.log10((own[kind(g)] + 4 * share[kind(g)]) / (k + 4)) + (kind(g) == 4) * max(0, min(len(g) + 3, 255) - 3) * math.log10(1 / 12)
            cost.append(word + gap)
            again += seen[w] > 0
            seen[w] += 1
            own[kind(g)] += 1
        spans, h = [], [hashes[w] for _, w in t]
        for k in range(mixer.ANCHOR - 1, len(t) - 1):
            spans.append(k) if anchor(h, k) % mixer.SPAN == 0 else None
        spans = [(tuple(w for _, w in t[a - 2 : a + 1]), tuple(w for _, w in t[a + 1 : b + 1]), sum(cost[a + 1 : b + 1])) for a, b in zip(spans, [*spans[1:], len(t) - 1])]
        if f:
            for a, b in {a: b for a, b, _ in spans[::-1]}.items():
                held.setdefault(a, Counter())[b] += 1
        coded.append((i, f, t, sum(cost), spans))
    top = {a: c for a, c in held.items()}
    flags = []
    for k, (i, f, t, _, spans) in enumerate(coded):
        for a, b, cost in spans:
            if a in top:
                most = max(top[a].values())
                ties = [x for x, n_ in top[a].items() if n_ == most]
                follows = max(ties, key=lambda x: span_hash([hashes[w] for w in x]))
                others = most - (f > 0 and b == follows)
                all_ = sum(top[a].values()) - (f > 0)
                if others > 0:
                    gate = (0 if others < 2 else 1 if others < 3 else 2 if others < 8 else 3) * 3 + (2 if others == all_ else 1 if others * 2 >= all_ else 0)
                    flags.append((k, f, gate, b == follows, cost))
    hits, all_ = Counter(g for _, f, g, hit, _ in flags if f and hit), Counter(g for _, f, g, _, _ in flags if f)
    total = [c for *_, c, _ in coded]
    for k, _, g, hit, cost in flags:
        chance = (hits[g] + 0.5) / (all_[g] + 1)
        total[k] += math.log10(chance) - cost if hit else math.log10(1 - chance)
    assert sum(hit for *_, hit, _ in flags) > 20
    want = []
    for (i, f, t, *_), score, (_, text) in zip(coded, total, rows, strict=True):
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for _, w in t)
        want.append((i, f == 0, len(t), sum(count[w] > 0 for _, w in t), n, base, score, -score * math.log2(10) / max(1, len((text or "").encode()))))
    want.sort(key=lambda r: str(r[:5]))
    got = [tuple(r) for r in sorted(got, key=lambda r: str(tuple(r)[:5]))]
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert sorted(round(r[5], 5) for r in got) == sorted(round(r[5], 5) for r in want)
    assert np.allclose(sorted(r[6] for r in got), sorted(r[6] for r in want), rtol=1e-4, atol=1e-3)
    assert np.allclose(sorted(r[7] for r in got), sorted(r[7] for r in want), rtol=1e-4, atol=1e-3)


def anchor(h, k):
    """The hash of the last ANCHOR tokens at k, by its definition."""
    h = np.array(h[: k + 1], np.uint64)
    out = h.copy()
    with np.errstate(over="ignore"):
        for back in range(1, mixer.ANCHOR):
            out[back:] = out[back:] * np.uint64(0x9E3779B97F4A7C15) + h[:-back]
    return int(mixer.mixed(out, 5)[-1])


def span_hash(h):
    return int(mixer._running(np.array(h, np.uint64), np.array([0]), np.array([len(h)])).view(np.int64)[0])


def test_mixer_spelling_learns_from_all_words(spark):
    r = random.Random(1)
    words = {"".join(r.choices("abcdefghijklmnop", k=r.randint(1, 9))).encode() for _ in range(3000)} | {b"", b"z" * 9000}
    frame = spark.createDataFrame([(bytearray(w), k % 3, (k + 1) % 2) for k, w in enumerate(sorted(words))], "word binary, a long, b long").repartition(3)
    half = [[w for k, w in enumerate(sorted(words)) if (k % 3, (k + 1) % 2)[x]] for x in (0, 1)]
    model = mixer.learn(frame)
    flat = [w[k : k + 4096] for w in half[0] + half[1] for k in range(0, max(len(w), 1), 4096)]
    bit, _, slots, _ = mixer.decisions(pa.array(flat, pa.binary()), model.codes)
    for s, t in zip(slots, model.tables, strict=True):  # the tables by brute force
        n, ones = np.bincount(s, minlength=len(t)), np.bincount(s, bit, len(t))
        assert (t[n > 0] == mixer.level(ones, n)[n > 0]).all() and (t[n == 0] == mixer.LEVELS // 2).all()
    sums = mixer.decided(frame.where("a > 0"), spark.sparkContext.broadcast(model)).groupBy().sum().first()
    bits = mixer.decisions(pa.array([w[k : k + 4096] for w in half[0] for k in range(0, max(len(w), 1), 4096)], pa.binary()), model.codes)[0]
    assert (sums["sum(n)"], sums["sum(ones)"]) == (len(bits), int(bits.sum()))
    one = [model.costs(pa.array([w], pa.binary()))[0] for w in flat[:50]]
    assert np.allclose(model.costs(pa.array(flat[:50], pa.binary())), one, rtol=1e-5) and max(one) < 0
    # what was learnt is worth more than even odds, on words of the same kind
    new = pa.array(["".join(r.choices("abcdefghijklmnop", k=8)).encode() for _ in range(300)], pa.binary())
    assert model.costs(new).sum() > -300 * 9 * 2.4
    # tables grow with the distinct words
    many = spark.range(60000).select(F.md5(F.col("id").cast("string")).cast("binary").alias("word"))
    assert mixer.byte_pairs(many)[1][1] > model.codes.sizes[1] > 15


def test_mixer_memory_of_a_worker(spark):
    """Two workers share an executor with its heap: what counting, and a model with tables of the largest size, take; counts beyond 16 bits are whole."""
    r = random.Random(3)
    words = [b"e" * 4095] * 50 + ["".join(r.choices("abcdefghij", k=6)).encode() for _ in range(60000)]
    codes = mixer.Codes(np.ones((256, 256), np.int64), [16, mixer.CAP, mixer.CAP])

    class Kept:  # in place of a DataFrame
        def mapInArrow(self, work, _):
            self.work = work
            return self

        select = withColumn = groupBy = applyInArrow = lambda self, *_: self

        def collect(self):
            return []

    def peak(work):
        tracemalloc.start()
        try:
            return work(), tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    kept = Kept()
    mixer.tables([kept], SimpleNamespace(value=codes))
    rows, counting = peak(lambda: [x for b in kept.work(pa.RecordBatch.from_arrays([pa.array(words[k : k + 9000], pa.binary())], ["word"]) for k in range(0, len(words), 9000)) for x in b.to_pylist()])
    got = [np.zeros((1 << b, 2), np.int64) for b in codes.sizes]
    for x in rows:
        n = len(x["counts"]) // 10
        at = np.frombuffer(x["counts"], np.uint16, n).astype(np.int64) + (x["block"] << mixer.BLOCK_BITS)
        got[x["k"]][at] = np.frombuffer(x["counts"][2 * n :], np.int32).reshape(2, n).T
    bit, _, slots, _ = mixer.decisions(pa.array(words, pa.binary()), codes)
    for s, n in zip(slots, got, strict=True):
        assert (n.ravel() == np.bincount(s.astype(np.int64) << 1 | bit, minlength=n.size)).all()
    assert got[1].max() > 1 << 17
    sent = pickle.dumps(mixer.Model(codes, [np.zeros(1 << b, np.uint8) for b in codes.sizes]))
    _, loading = peak(lambda: pickle.loads(sent))
    assert counting < 130 and loading < 60, (counting, loading)


def test_mixer_context_across_words(spark, tmp_path):
    """context_score knows what words follow each other, score does not; what it adds are probabilities of openings under both."""
    r = random.Random(8)
    words = [a + "".join(r.choices("aeioubcd", k=4)) for a in "abcdefgh" for _ in range(6)]

    def text(k, chained):
        at = [r.randrange(48) for _ in range(150)]
        for i in range(1, 150 * chained):
            at[i] = at[i - 1] * 5 % 8 * 6 + r.randrange(6)  # the word before tells the first letter
        return (k, " ".join(words[i] for i in at))

    gained = {}
    for chained in (True, False):
        spark.createDataFrame([text(k, chained) for k in range(300)], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/{chained}/documents.parquet")
        held = [x for x in mixer.query(spark, f"{tmp_path}/{chained}").collect() if x.held_out]
        gained[chained] = sum(x.context_score - x.score for x in held) / sum(x.n_tokens for x in held)
    assert gained[True] > 0.5 and abs(gained[False]) < 0.05 and len(held) > 15
    # the contexts by hand
    texts = ["The end. (of it)\n\nthe  9th \u00e9t\u00e9", "", None, "one", "X" * 30 + ' "quoted" - \x00']
    t = mixer.Tokens(texts)
    kind = lambda x: 0 if not x else ord(x) - 96 if "a" <= x <= "z" else 27 if "0" <= x <= "9" else 28 if x > "\x7f" else 29 if x in "\"'([{<" else 30 if "!" <= x <= "~" else 31
    want = []
    for x in texts:
        before, ended = 0, ""
        for gap, w in plain_tokens(x):
            want.append((((int(gap != " ") << 5 | kind(ended)) << 10 | before >> 54) << 5) | kind(w[:1]))
            before, ended = int(mixer.word_hashes(pa.array([w.encode()], pa.binary()))[0]), w[-1:]
    assert mixer.openings(t).tolist() == want
    # both sum up to one
    met = np.zeros((2, mixer.SLOTS * mixer.KINDS), np.int64)
    np.add.at(met, ([k % 2 for k in range(3000)], [r.choice(want) + r.randrange(3) // 2 for _ in range(3000)]), 1)
    assert np.allclose((10.0 ** mixer.Openings(met).logs.astype(float)).sum(1), 1, atol=1e-4)
    model = mixer.learn(spark.createDataFrame([(bytearray(w.encode()), 3, 2) for w in [*words, ""]], "word binary, a long, b long"))
    of_kind = np.zeros((2, mixer.KINDS), np.int64)
    for w in [*words, ""]:
        of_kind[:, kind(w[:1])] += [5, 1]
    assert math.isclose((10.0 ** mixer.opened(model, of_kind, 5 * 49, 0.5, 0.5 * 49 / (5 * 49))).sum(), 1, abs_tol=1e-3)


def test_mixer_of_nothing(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert mixer.query(spark, f"{tmp_path}/none").count() == 0
    spark.createDataFrame([(None, "Held out"), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/held/documents.parquet")
    got = mixer.query(spark, f"{tmp_path}/held").collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.score < 0 and math.isclose(r.base_score, 0.0, abs_tol=1e-9) for r in got)


def test_salvage_of_mixed_archives(spark, tmp_path):
    def part(k):
        p = (b"payload %d " % k) * 50
        b = warc.HTTP.encode() + p
        return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n" % (k, hashlib.sha1(p).hexdigest().encode(), len(b)) + b + warc.END

    plain, packed = [part(k) for k in range(4)], [warc.member(part(k)) for k in range(4)]
    for data in (packed[0] + plain[1], plain[0] + packed[1], plain[0] + packed[1] + plain[2] + packed[3]):
        assert {x[0] for x in warc.salvage(data)} == {"record"}
    for cut in (b"", b"junk\x1f\x8b\x08junk", packed[2][:20], plain[2][:30]):
        got = list(warc.salvage(packed[0] + cut + plain[1] + cut + packed[3]))
        assert [x[0] for x in got].count("record") == 3 and (not cut or [x[0] for x in got] == ["record", "gap", "record", "gap", "record"])
        assert sum(x[2] for x in got) == len(packed[0] + plain[1] + packed[3]) + 2 * len(cut)
    d = spark.createDataFrame([(1, "http://a.b/x?q=1&r=a b#é\n%41", "h"), (2, "http://a.b/x?q=1", None), (3, None, "x" * 40000)], "page_id long, url string, html string")
    assert d.select(warc._uri(F.col("url")).alias("u")).first().u == "http://a.b/x?q=1&r=a%20b#%C3%A9%0A%41"
    warc.write(d, f"{tmp_path}/w")
    assert sorted((r.page_id, r.payload_bytes) for r in warc.read(spark, f"{tmp_path}/w").collect()) == [("1", 1), ("2", 0), ("3", 40000)]
    d.limit(0).write.parquet(f"{tmp_path}/e/pages.parquet")
    assert warc.query(spark, f"{tmp_path}/e").count() == 0


@pytest.fixture(scope="module")
def crawl():
    """(page_id, url, html) with a generator of its own, so that it doesn't depend on which tests ran before."""
    r = random.Random(77)
    return [(k, f"http://a/{k}", f"<p>{k} {' '.join(r.choice(WORDS) for _ in range(60))}</p>" if k % 9 else "same " * 300) for k in range(400)]


def test_salvage_query(spark, tmp_path, crawl):
    spark.createDataFrame(crawl, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = warc.salvage_query(spark, str(tmp_path)).collect()
    back, gaps = [r for r in got if r.record_type != "gap"], [r for r in got if r.record_type == "gap"]
    assert all(r.n == r.right for r in back) and sum(r.n for r in back) >= 350 and sum(r.n for r in gaps) >= 8  # what comes back is right


def test_salvage_survives_any_damage(spark, tmp_path, crawl):
    """A thousand damages, in every part of a record: what comes back is a page's own record, and all records that the damage doesn't touch come back."""
    d = spark.createDataFrame(crawl, "page_id long, url string, html string").where("page_id < 40").coalesce(1)
    warc.write(d, f"{tmp_path}/w")
    data = max((f.read_bytes() for f in (tmp_path / "w").glob("part-*")), key=len)
    key = lambda x: (tuple(sorted(x[3].items())), x[4])
    records = list(warc.salvage(data))
    assert {x[0] for x in records} == {"record"} and {x[3]["warc-type"] for x in records} == {"response", "revisit"}
    packed = b"".join(warc.member(data[x[1] : x[1] + x[2]]) for x in records)
    r, right = random.Random(3), {key(x) for x in records}
    fields = [data.find(f.encode(), records[3][1]) for f in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target", "WARC-Payload", "X-Payload", "Content-Type", "Content-Length", "X-Header")]
    for n in range(1000):
        whole = packed if n % 4 == 3 else data
        at = r.choice(fields) + r.randrange(30) if n % 4 == 1 else r.randrange(len(whole))
        kind, size = r.randrange(4), r.randint(1, 60)
        damage = {0: bytes([whole[at] ^ 1 << r.randrange(8)]) + whole[at + 1 :], 1: whole[at + size :], 2: r.randbytes(size) + whole[at:], 3: bytes([r.randrange(256)]) + whole[at + 1 :]}[kind]
        got = list(warc.salvage(whole[:at] + damage))
        back = [key(x) for x in got if x[0] == "record"]
        assert set(back) <= right, (n, at, kind)
        assert len(set(back)) >= len(records) - 3, (n, at, kind)


def test_salvage_foreign_archives():
    """Archives of other writers: unknown types and records that lack what the others state are suspect; lengths that are no numbers don't raise."""

    def record(k, kind=b"response", digest=True, more=b""):
        p = b"payload %d " % k
        b = warc.HTTP.encode() + p
        stated = b"WARC-Payload-Digest: sha1:%s\r\n" % hashlib.sha1(p).hexdigest().encode() if digest else b""
        return b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:%d>\r\n%s%sContent-Length: %d\r\n\r\n" % (kind, k, stated, more, len(b)) + b + warc.END

    said = lambda data: [x[3] if x[0] == "gap" else x[0] for x in warc.salvage(data)]
    assert said(record(1) + record(2, b"responze") + record(3)) == ["record", "unknown type", "record"]
    assert said(record(1) + record(2, digest=False) + record(3)) == ["record", "no payload digest", "record"]
    assert said(record(1, digest=False) + record(2, digest=False)) == ["record", "record"]
    assert said(record(1, b"revisit", more=b"X-Payload-Length: 12x\r\n")) == ["record"] and warc._number("12x") is None and warc._number("9" * 30) is None and warc._number("12") == 12
    assert said(record(1, b"metadata", more=b"WARC-Block-Digest: sha1:00\r\n")) == ["block digest differs"]


def test_graph_far_from_the_origin_and_repeated_ids(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(1500, 16)) + 10_000
    rows = [(int(k), [float(c) for c in v]) for k, v in enumerate(x)] + [(7, [float(c) for c in x[300]]), (7, [float(c) for c in x[300]]), (1499, [1.0, 2.0]), (1498, None), (None, [1.0]), (100, [float("inf")] * 16)]
    d = graph.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {}
    g = graph.index(d, shard=400).cache()
    for row in graph.nearest(g, d.where("vec_id % 100 = 0"), asked=16 * 8 * 4).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    known = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and len(v) == 16 and np.isfinite(v).all()]
    right = all_ = 0
    for q in range(0, 1500, 100):
        best = {}
        for i, v in known:
            if i != q:
                s = float(np.sqrt(((v - x[q]) ** 2).sum()))
                best[i] = min(s, best.get(i, np.inf))
        want = sorted((s, i) for i, s in best.items())[:10]
        have = sorted(got[q])
        assert [h[0] for h in have] == list(range(1, 11)) and all(abs(best[i] - s) < 1e-9 for _, i, s in have)
        right += len({i for _, i in want} & {h[1] for h in have})
        all_ += 10
    assert right / all_ >= 0.95 and got[300][0][1:] != ()
    assert (1, 7, 0.0) in got[300]
    assert graph.nearest(g, d.limit(0)).count() == 0


def test_plain_split_equals_the_general_one():
    import itertools

    import regex

    both = regex.compile(bpe.PATTERN).findall, bpe.plain_pattern().findall
    pairs = itertools.product(map(chr, range(128)), repeat=2)
    for text in itertools.chain(map("".join, pairs), map("".join, itertools.product("'sl A1!\t\n\r\x1c", repeat=4))):
        assert both[0](text) == both[1](text), repr(text)
    below = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for between in ("", " ", "  ", "é", "'s", "\u3000\n"):
        text = between.join(below)
        assert bpe.is_plain(text) and both[0](text) == both[1](text)
    assert not bpe.is_plain("a\U0001f600")


def test_shingles_by_brute_force(monkeypatch):
    texts = [None, "", " \n", "A", "a b", "a b c d a b c d e", prose(500), "x" * 300 + " é\x85y  z\x0b" + prose(40)]
    whole = [jaccard.shingles(t, 3) for t in texts]
    for text, got in zip(texts, whole, strict=True):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        assert len(got) == len({tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else ())
    monkeypatch.setattr(jaccard, "BLOCK", 16)  # blocks end between words, so they change nothing
    assert all(np.array_equal(jaccard.shingles(t, 3), s) for t, s in zip(texts, whole, strict=True))


def test_licenses_against_a_naive_aligner(spark):
    """Finds of whole texts against the longest common subsequence with the template at the best place."""
    lists = {k: licenses.words(v) for k, v in licenses.TEMPLATES.items()}
    noise = lambda n: [rng.choice(WORDS) for _ in range(n)]
    cases = [(name, noise(40) + [w for k, w in enumerate(t) if len(t) < 12 or k % 17] + noise(30)) for name, t in lists.items()]

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for k, y in enumerate(b, 1):
                last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
        return row[-1]

    rows = [(k, " ".join(t), "clash") for k, (_, t) in enumerate(cases)] + [(None, None, "x"), (901, "", "x"), (902, "Licensed under CC BY-NC 4.0.", "x"), (903, "LICENSED UNDER CC BY 4.0 and more", "x"), (903, "plain text", "x")]
    got = licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string, finds string")).collect()
    found = {r.doc_id: {f.license: f for f in r.finds} for r in got if r.doc_id is not None and r.text}
    for k, (name, t) in enumerate(cases):
        assert name in found[k], name
        assert abs(found[k][name].coverage - common(t, lists[name]) / len(lists[name])) < 0.06
        for other, f in found[k].items():
            assert common(t[f.first : f.end], lists[other]) >= licenses.COVERED * len(lists[other]) - 1e-9
    assert [sorted(f.license for f in r.finds) for r in got if r.doc_id in (902, 903)] == [["cc-by-nc-line"], ["cc-by-line"], []]
    assert all(r.finds == [] for r in got if not r.text) and licenses.scanned(spark.createDataFrame([], "text string")).count() == 0


def test_pipeline_by_brute_force(spark, tmp_path):
    """Each stage of run() against plain Python over what the stage before it kept."""
    import tokenizers

    import corpus_pipeline

    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(2, 7)))
    texts = [" ".join(word() for _ in range(60)) + ".\n" + " ".join(word() for _ in range(20)) for _ in range(60)]
    near = [t.replace(t.split()[5], "edited", 1) for t in texts[:12]]
    shared = " ".join(word() for _ in range(30))
    texts = [*texts, *near, texts[0], texts[1], *[f"{shared}\n{t}" for t in texts[20:24]], None, "", "CAPS!!! " * 40]
    rows = [(k, t, "en", f"s{k % 3}" if k % 5 else None, len(t or "")) for k, t in enumerate(texts)] + [(None, texts[30], "en", "s1", 1), (3, texts[40], "en", "s2", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 0 if k % 7 == 3 else 1, 0) for k in range(len(texts)) if k % 2], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = mixer.written(stage(spark, docs, str(tmp_path)), "stage")
        seen.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    key = lambda rows_: sorted(((x.doc_id is None, x.doc_id, x.text or "") for x in rows_), key=str)
    scores = {(x.doc_id, x.text): x.s for x in quality.score(spark.read.parquet(f"{tmp_path}/documents.parquet"), quality.learn(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")), "s").collect()}
    assert key(seen[0]) == sorted(((i is None, i, t or "") for i, t, *_ in rows if scores[(i, t)] >= 0.5), key=str)
    before = {w for x in seen[0] for w in (x.text or "").split("\n")}
    assert all(line in before for x in seen[1] for line in (x.text or "").split("\n")) and sum((x.text or "").count(shared) for x in seen[1]) <= 1
    # all pairs of five-word shingles at 0.8; the first by id stays
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := (x.text or "").lower().split()) else frozenset() for x in seen[1]]
    label = list(range(len(sets)))
    for _ in sets:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 10 * len(x & y) >= 8 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    groups = {}
    for k, n in enumerate(label):
        groups.setdefault(n, []).append(seen[1][k])
    kept = [min(g, key=lambda x: (x.doc_id is not None, x.doc_id or 0)) for g in groups.values()]
    assert sorted(str(x.doc_id) for x in seen[2]) == sorted(str(x.doc_id) for x in kept)
    assert {(x.doc_id, x.text) for x in seen[3]} <= {(x.doc_id, x.text) for x in seen[2]}
    size = lambda t: len((t or "").split())
    taken, had = Counter(), Counter()
    for x in seen[3]:
        taken[x.source] += size(x.text)
    for x in seen[2]:
        had[x.source] += size(x.text)
    target = dict(zip(sorted(had, key=lambda s: (s is None, s)), (3, 1, 2, 3), strict=True))
    total, free = 1.5 * sum(had.values()), set(had)
    goal = {}
    while free:
        share = {s: total * target[s] / sum(target[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * had[s] + 1e-9}
        if not over:
            goal |= share
            break
        for s in over:
            goal[s] = 2 * had[s]
            total -= 2 * had[s]
        free -= over
    assert all(abs(taken[s] - goal[s]) <= 100 for s in had)
    library = tokenizers.Tokenizer.from_file(str(bpe.vocabulary_path()))
    library.no_truncation(), library.no_padding()
    text_of = {(x.doc_id, x.text or "") for x in seen[3]}
    digests = {(i, hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()) for i, t in text_of for ids in [library.encode(t, add_special_tokens=False).ids]}
    assert {(x.doc_id, x.ids_sha256) for x in seen[4]} == digests and len(seen[4]) == len(seen[3])
    spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/e/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0
