"""Replayed fetching against a loop over requests."""

import random

from promolens.operators import fetch

RESPONSE = "url string, attempt int, status int, ms long, error string, body string"


def looped(requests, responses, limit, budget, retries):
    """One request after the other, as a client would."""
    out, clock = [], {}
    tries = {}
    for r in responses:
        tries[r[0], r[1]] = min(tries.get((r[0], r[1]), r), r, key=lambda x: (x[2], x[3], (x[4] is not None, x[4])))
    for venue, ord_, url in sorted(requests, key=lambda x: (x[0], x[1])):
        begins = at = clock.get(venue, 0)
        stop, made, status, outcome, page = False, 0, None, None, ""
        for k in range(1, retries + 2):
            t = tries.get((url, k))
            if t is None or stop:
                continue
            if at > budget and outcome is None:
                outcome = "deadline"
            _, _, code, ms, error, body = t
            kind = "timeout" if ms > limit else "error" if error is not None else "ok" if code == 200 else "bad_status"
            if at <= budget:
                made, outcome, status, page = made + 1, kind, code if kind in ("ok", "bad_status") else None, (body or "") if kind == "ok" else ""
            at += min(ms, limit)
            stop = kind == "ok" or (kind == "bad_status" and code != 429 and code < 500)
        clock[venue] = at
        outcome = outcome or ("deadline" if begins > budget else "missing")
        out.append((venue, ord_, url, begins, made, status, outcome, page))
    return out


def test_fetched(spark):
    r = random.Random(6)
    urls = [f"http://a/{k}" for k in range(60)]
    responses = [(u, a, r.choice([200, 200, 404, 429, 503, 500]), r.randint(0, 14_000), r.choice([None, None, None, "reset"]), r.choice([f"<p>{u} {a}</p>", None])) for u in urls[:50] for a in range(r.choice([0, 1]), r.randint(1, 5))]
    requests = [(f"v{r.randrange(6)}", k, r.choice([*urls, None])) for k in range(200)]
    d, s = spark.createDataFrame(requests, "venue string, ord int, url string").repartition(3), spark.createDataFrame(responses, RESPONSE).repartition(3)
    for limit, budget, retries in ((10_000, 45_000, 2), (5_000, 200_000, 0), (10_000, 0, 3)):
        got = fetch.fetched(d, s, limit, budget, retries).collect()
        want = looped(requests, responses, limit, budget, retries)
        assert sorted((x.venue, x.ord, x.url, x.begins, x.attempts, x.status, x.outcome, x.html) for x in got) == want, (limit, budget, retries)
    assert {x.outcome for x in fetch.fetched(d, s).collect()} == {"ok", "bad_status", "timeout", "error", "missing", "deadline"}
    assert fetch.fetched(d.limit(0), s).count() == 0 and {x.outcome for x in fetch.fetched(d, s.limit(0)).collect()} == {"missing"}


def test_texts_of_fetched_pages(spark):
    shell, told = '<html><body><div id="root"></div></body></html>', "<html><body><p>Happy hour every day with half price drinks for all</p></body></html>"
    s = spark.createDataFrame([("a", 1, 200, 5, None, shell), ("b", 1, 200, 5, None, told), ("c", 1, 404, 5, None, told), ("d", 1, 200, 5, None, None)], RESPONSE)
    d = spark.createDataFrame([("v", k, u) for k, u in enumerate("abcde")], "venue string, ord int, url string")
    got = {x.url: (x.shell, x.text) for x in fetch.with_texts(fetch.fetched(d, s)).collect()}
    assert got == {"a": (True, ""), "b": (False, "Happy hour every day with half price drinks for all"), "c": (False, ""), "d": (False, ""), "e": (False, "")}
