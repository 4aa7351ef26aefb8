import math
import re
from collections import Counter

from promolens.operators import matching


def brute(gold, chunks, stop):
    def grams(text):
        words = [w for w in re.findall(r"\w\w+", (text or "").lower()) if w not in stop]
        return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)])

    out = {}
    for grp, text in gold:
        own = sorted((k, t) for g, k, t in chunks if g == grp)
        corpus = [grams(text), *(grams(t) for _, t in own)]
        df = Counter(w for c in corpus for w in c)
        vectors = [{w: n * (math.log((1 + len(corpus)) / (1 + df[w])) + 1) for w, n in c.items()} for c in corpus]
        size = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
        sims = [(round(sum(x * vectors[0].get(w, 0) for w, x in v.items()) / (s * size[0]), 12) if s * size[0] else 0.0, -k) for v, s, (k, _) in zip(vectors[1:], size[1:], own, strict=True)]
        best = max(sims, default=None)
        out[grp] = (-best[1] if best else None, round(best[0], 4) if best else 0.0, len(own))
    return out


def test_best_chunk(spark):
    gold = [(1, "Happy hour daily, half price beers"), (2, None), (3, "Trivia night"), (4, "Étoile du nord"), (5, "one two")]
    chunks = [(1, 0, "Beers at half price every happy hour"), (1, 1, "Contact us"), (1, 2, "happy hour daily half price beers"), (1, 3, "happy hour daily half price beers"), (2, 0, "x y"), (2, 1, None), (4, 7, "étoile NORD"), (4, 8, ""), (5, 3, "three"), (5, 4, "four"), (9, 0, "nobody asks")]
    got = matching.best_chunk(spark.createDataFrame(gold, "grp long, text string"), spark.createDataFrame(chunks, "grp long, chunk_id int, text string"), ["us", "at"])
    assert {r.grp: (r.chunk_id, r.similarity, r.num_chunks) for r in got.collect()} == brute(gold, chunks, {"us", "at"})
    assert matching.best_chunk(spark.createDataFrame([], "grp long, text string"), spark.createDataFrame([], "grp long, chunk_id int, text string")).count() == 0
