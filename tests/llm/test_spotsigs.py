"""Every column of the SpotSigs queries against plain Python."""

import hashlib
import random
import re

import pytest

from promolens.llm import spotsigs

COMMON = set(spotsigs.COMMON)


def chains(text):
    """A text's signatures: an anchor and the two content words after it; its words, or itself, if it has none."""
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    found = {(x, *after) for k, x in enumerate(w) if x in COMMON and len(after := [y for y in w[k + 1 :] if y not in COMMON][:2]) == 2}
    return found or ({" ".join(w) or text} if text else set())


def like(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(12)
    words = ["the", "of", "and", "in", "is", "die", "un", *[f"word{k}" for k in range(60)], "Éta", "naïve"]
    base = [" ".join(r.choice(words) for _ in range(r.randint(20, 160))) for _ in range(40)]
    near = []
    for b in base[:20]:
        for _ in range(3):  # a few words edited
            w = b.split()
            for k in r.sample(range(len(w)), r.randint(1, 3)):
                w[k] = r.choice(words)
            near.append(" ".join(w))
    return [*base, *near, base[0], base[0], base[1], "", None, "the the the", "lone", "lone", "!!!", "x" * 9, "é" * 7 + " the a b"]


def test_query(spark, texts, tmp_path):
    """ids, lengths, digests, fingerprints and likenesses of texts, edited texts and successors."""
    rows = [(3 * k, t, "clash") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in spotsigs.query(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    prints = {}
    for k, (doc_id, text, _) in enumerate(rows):
        t, n = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + n[:cut]
        r, a, e = got[doc_id], chains(t), chains(edited)
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - like(a, e)) < 1e-12 and abs(r.near_next - like(a, chains(n))) < 1e-12
        for x, p in ((a, r.fingerprint), (e, r.edited_fingerprint)):
            assert len(p) == 8 * len(x) and prints.setdefault(frozenset(x), p) == p  # a set has one fingerprint
    assert len(set(prints.values())) == len(prints)


@pytest.mark.parametrize("near", [0.8, 0.5])
def test_near_classes(spark, texts, near):
    rows = [(2 * k + 1, t) for k, t in enumerate(texts)] + [(None, texts[0]), (1, texts[0])]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(frozenset(chains(t or "")), []).append(i)
    want = []
    for s, ids in sets.items():
        links = sorted((-like(s, o), min(oi)) for o, oi in sets.items() if o != s and s and o and like(s, o) >= near)
        want += [(i, min(ids), len(links), links[0][1] if links else None, -links[0][0] if links else None) for i in ids]
    got = [tuple(r) for r in spotsigs.near_classes(d, near).collect()]
    none = lambda x: tuple((y is None, y if y is None or isinstance(y, int) else round(y, 12)) for y in x)
    assert sorted(map(none, got)) == sorted(map(none, want))
    assert sum(x[2] > 0 for x in want) > 10
    assert spotsigs.near_classes(d.limit(0)).count() == 0
