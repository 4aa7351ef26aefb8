"""Spelling variants, phrases and outliers against brute force, with every bound lowered, and their defined edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from promolens.llm import outliers, phrases, variants

SCHEMA = "doc_id long, text string, lang string, source string, n string, word string, kept string, size string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(texts, lang=lambda k: "en", source=lambda k: "a"):
    return [(k, t, lang(k), source(k), "clash", None, "x", None) for k, t in enumerate(texts)]


# --- spelling variants ------------------------------------------------------------------------------------------------


def edits(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_of(docs):
    n = Counter()
    for doc_id, text, *_ in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if edits(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: f for w, f in form.items() if n[f] >= 10 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def test_variants(spark):
    r = random.Random(11)
    base = ["".join(r.choice("abcéÿ") for _ in range(r.randint(7, 12))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "×÷abcdefg"]
    words = list(base)
    for w in base:
        for _ in range(14):
            k, c = r.randrange(len(w)), r.choice("abcÉé")
            words.append(r.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]]))
    chain = ["letterings", "letteringz", "letteringzq"]  # each ten times as frequent as the next
    texts = [" ".join(r.choice(words).capitalize() if r.random() < 0.2 else r.choice(words) for _ in range(200)) for _ in range(30)]
    texts += [" ".join([chain[0]] * 600 + [chain[1]] * 45 + [chain[2]] * 3), "tiedwordx " * 50 + "tiedwordy " * 50 + "tiedword " * 3, None, "", "short words only", "x" * 3000 + " " + "x" * 3000]
    docs = rows(texts) + [(None, texts[0], None, None, None, None, None, None), (3, texts[3], "en", "a", "clash", None, "x", None)]
    d = spark.createDataFrame(docs, SCHEMA).repartition(3)
    want = variants_of(docs)
    assert len([w for w in want if w[1]]) > 2 and any(w[2] not in (w[0], w[1]) for w in want) and max(w[4] for w in want) > 5
    for segments in (variants.SEGMENTS, 7):  # 7: most keys are grids of parts
        got = sorted((x.word, x.form, x.root, x.n, x.n_near, x.form_n) for x in variants.grouped(d, segments=segments).collect())
        assert got == want
    assert variants.grouped(d.limit(0)).count() == 0


def test_near_takes_every_pair_once():
    """Each pair at one edit is found by one half alone, each other pair by none."""
    import itertools

    words = ["".join(x) for n in (3, 4, 5) for x in itertools.product("ab", repeat=n)]
    for v in words:
        for u in words:
            h, hits = len(u) // 2, 0
            for side in (0, 1):
                if v.endswith(u[h:]) if side else v.startswith(u[:h]):
                    if abs(len(u) - len(v)) <= 1:
                        hits += int(variants.near(variants._matrix([v], len(v)), variants._matrix([u], len(u)), side)[0, 0])
            assert hits == edits(v, u), (v, u)


# --- phrases ----------------------------------------------------------------------------------------------------------


def phrases_of(docs, least, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    found = {}
    big = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    for (lang, p), a in big.items():
        if any(x == lang and len(q) > len(p) and b >= a and inside(p, q) for (x, q), b in big.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right, n[lang]))
    return sorted((lang, k, p.decode(), -a, x, y, m, -s) for lang, ps in found.items() for k, (s, a, p, x, y, m) in enumerate(sorted(ps)[:top], 1))


def test_phrases(spark):
    r = random.Random(2)
    common = ["the", "of", "a", "IN", "é", " x", "ha"]
    rare = [f"w{k}" for k in range(300)]
    said = ["new york city hall", "ha ha ha ha ha ha ha", "of the of the of", "a b c d e f"]

    def text():
        parts = [r.choice(said) if r.random() < 0.2 else r.choice(common) if r.random() < 0.7 else r.choice(rare) for _ in range(60)]
        return "".join(p + r.choice([" ", " ", " ", "\t ", ". ", ",", "\n"]) for p in parts)

    texts = [text() for _ in range(60)] + [None, "", " .;", "of the " * 400]
    docs = rows(texts, lang=lambda k: ("en", None, "de")[k % 3]) + [(1, texts[1], "en", None, None, None, None, None)] * 2 + [(None, texts[4], "und", None, None, None, None, None)]
    d = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = lambda **of: sorted(tuple(x) for x in phrases.collocations(d, least=6, **of).collect())
    want = phrases_of(docs, 6, 2000)
    assert {len(p[2].split(" ")) for p in want} == {2, 3, 4, 5} and {p[0] for p in want} == {"en", "de", "und"}
    assert got() == want
    assert got(most_words=0) == want  # numbers come from a join
    assert got(most_pairs=0, most_fragments=9) == want  # no pairs break fragments, pivots are dealt over shards
    assert got(top=7) == phrases_of(docs, 6, 7)
    assert phrases.collocations(d.limit(0)).count() == 0 and phrases.collocations(d).count() == len(phrases_of(docs, 100, 2000))


def test_phrases_small_blocks(monkeypatch):
    """Phrases at the borders of what a task rewrites at a time are counted as others are: blocks end at a text's end."""
    monkeypatch.setattr(phrases, "TOKENS", 3)
    r = random.Random(4)
    texts = [np.array([r.randint(0, 4) for _ in range(r.randint(0, 12))] + [0], np.int32) for _ in range(60)]
    want, got = Counter(), Counter()
    for x in texts:
        for m in (3, 4, 5):
            want.update(tuple(x[i : i + m]) for i in range(len(x) - m + 1) if all(x[i : i + m]))
    for x in phrases._gathered(iter(texts)):
        found, n = phrases.fragments_of(x, None)
        for g, k in zip(*phrases.mined(found, n, np.ones(len(found), int), 1), strict=True):
            got[tuple(int(i) for i in g if i)] += int(k)
    assert got == want


def test_scores_beyond_64_bits(spark):
    sql = "SELECT CAST(1000 * CAST(a AS DECIMAL(18,0)) * CAST(n AS DECIMAL(18,0)) AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS s FROM VALUES (99999999999L, 9999999999999L, 99999999999L, 99999999998L) t(a, n, l, r)"
    assert spark.sql(sql).head().s == 1000 * 99999999999 * 9999999999999 // (99999999999 * 99999999998)


# --- outliers ---------------------------------------------------------------------------------------------------------


def counts_of(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(covered)


def judged_of(docs):
    """The method with numpy's own linear algebra."""
    stats = [counts_of(d[1]) for d in docs]
    bad = [c[0] < 50 or 100 * c[5] > 50 * c[0] for c in stats]
    x = np.array([[0] * 4 if b else [math.floor(1024 * v + 0.5) for v in (math.log(c[1] / c[0]), math.log1p(20 * c[2] / c[0]), c[4] / c[3], c[5] / c[0])] for b, c in zip(bad, stats, strict=True)], float)
    good = [k for k, b in enumerate(bad) if not b]
    own, lang = Counter((docs[k][2], docs[k][3]) for k in good), Counter()
    for (g, s), n in own.items():
        lang[g] += n if n < 100 else 0
    level = lambda k: (docs[k][2], docs[k][3]) if own[docs[k][2], docs[k][3]] >= 100 else (docs[k][2],) if lang[docs[k][2]] >= 100 else ()
    floors = np.diag([(1024 * f) ** 2 for f in outliers.FLOORS])
    far = lambda v, m, c: np.einsum("ij,jk,ik->i", v - m, np.linalg.inv(c), v - m)
    of = lambda v, factor: (v.mean(0), np.cov(v.T, bias=True) * factor + floors)
    kept = [not b for b in bad]
    for g in {level(k) for k in good}:
        asked = [k for k in good if level(k) == g]
        v = x[asked if g else good]
        if len(v) < 100:
            continue
        med = np.median(v, 0)
        found = []
        for m, c in ((med, np.diag((1.4826 * np.median(abs(v - med), 0)) ** 2) + floors), of(v, 1.0)):
            for _ in range(outliers.STEPS):
                b = np.minimum(np.floor(64 * np.sqrt(far(v, m, c))), 64 * 64)
                h = np.sort(b)[math.ceil(0.75 * len(v)) - 1]
                m, c = of(v[b <= h], outliers.consistency(0.75))
            found.append((np.linalg.slogdet(c)[1], m, c))
        _, m, c = min(found, key=lambda y: y[0])
        m, c = of(v[far(v, m, c) <= outliers.quantile(0.975)], outliers.consistency(0.975))
        for k, d in zip(asked, far(x[asked], m, c), strict=True):
            kept[k] = bool(d <= outliers.quantile(outliers.CUTOFF))
    return sorted(((d[0], *c[:3], *c[4:], b, k) for d, c, b, k in zip(docs, stats, bad, kept, strict=True)), key=str)


@pytest.fixture(scope="module")
def mixed():
    r = random.Random(8)
    word = lambda a, b: "".join(r.choice("abcdefghij") for _ in range(r.randint(a, b)))
    clean = lambda: "\n".join(" ".join(word(2, 8) for _ in range(r.randint(8, 14))) for _ in range(r.randint(6, 12)))
    repeats = lambda: (s := clean()) + "\n" + "\n".join(r.sample(s.split("\n"), 2))
    junk = [lambda: " ".join(word(2, 8) + "###" for _ in range(80)), lambda: " ".join(word(14, 20) for _ in range(80)), lambda: "\n".join([clean(), *["menu"] * 40])]
    texts = [r.choice(junk)() if r.random() < 0.12 else repeats() if r.random() < 0.2 else clean() for _ in range(420)]
    texts += ["a b c " * 30, None, "", "\n \t\n", "one", "a b a b a b", "word " * 20000, clean().replace(" ", "\x0b"), texts[0], texts[0]]
    langs, sources = ["en"] * 5 + ["de"] * 2 + [None], ["hot", "hot", "hot", "b", None]
    docs = rows(texts, lambda k: langs[k % 8] if k < 415 else "rare", lambda k: sources[k % 5])
    return [*docs, (None, texts[3], None, None, None, None, None, None), docs[4], docs[4]]


def test_outliers(spark, mixed, tmp_path):
    d = spark.createDataFrame(mixed, SCHEMA).repartition(3)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(x) for x in outliers.query(spark, str(tmp_path)).collect()), key=str)
    want = judged_of(mixed)
    assert got == want
    junk = [w for w in want if not w[-2] and (w[3] > 100 or w[2] > 12 * w[1] or w[4] > 30)]
    assert len(junk) > 20 and not any(w[-1] for w in junk)
    assert sum(not w[-1] for w in want if not w[-2]) <= len(junk) + 2  # clean documents stay


def test_outliers_without_groups(spark, mixed, monkeypatch):
    d = spark.createDataFrame(mixed[:60], SCHEMA)
    assert all(x.kept != x.base_failed for x in outliers.judged(d).collect())  # too few documents for a verdict
    assert outliers.judged(d.limit(0)).count() == 0
    monkeypatch.setattr(outliers, "FEW", 0)  # estimates meet documents in joins
    got = sorted(((x.doc_id, x.kept) for x in outliers.judged(spark.createDataFrame(mixed, SCHEMA)).collect()), key=str)
    assert got == sorted(((w[0], w[-1]) for w in judged_of(mixed)), key=str)
