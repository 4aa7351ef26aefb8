"""The Jaccard join's query (four words, 85 %) against all pairs in plain Python."""

import random
import re

import pytest

from promolens.llm import jaccard

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def components(rows):
    """(set size, smallest id reachable) by id, over all pairs."""
    sets, top = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= 85 * len(x | y):
                i, j = sorted((root(a), root(b)))
                top[j] = i
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(31)
    word = lambda: r.choice(["The", "of", "and", *[f"w{k}" for k in range(400)]])
    texts = []
    for _ in range(12):  # chains: each a few words off the one before, around the limit
        w = [word() for _ in range(r.randint(40, 200))]
        for _ in range(r.randint(1, 8)):
            texts.append(" ".join(w))
            w = list(w)
            for k in r.sample(range(len(w)), max(1, int(len(w) * r.choice([0.005, 0.015, 0.025, 0.04])))):
                w[k] = word()
    texts += [" ".join(word() for _ in range(60)) for _ in range(20)] + [texts[0], texts[0].upper(), "\x0b".join(texts[3].split(" "))]
    texts += [None, "", " \n ", "one", "One", "one two", "one two three", "ONE two  three", "one two three four", "a b c d " * 50, "a b c d " * 49]
    r.shuffle(texts)
    return [(7 * k + 2, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("ids", [jaccard.IDS, 0])  # 0: ids meet in shuffles, none is broadcast
def test_query(spark, rows, tmp_path, monkeypatch, ids):
    monkeypatch.setattr(jaccard, "IDS", ids)
    spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, n_shingles string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    want = components(rows)
    sizes = [c for _, c in want.values()]
    assert len(set(sizes)) < len(rows) - 20 and len(set(sizes)) > 30
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.query(spark, str(tmp_path)).collect()}
    assert got == want
