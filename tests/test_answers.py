"""Clients that fail, and answers that are kept."""

import os

import pytest
from pyspark.sql import functions as F

from promolens.operators import cascade, job, training
from promolens.operators.clients import KeywordClient, answered, answers


def flaky(folder, fails):
    """A client that notes each call and fails on prompts that hold a word, as often as that says."""

    def make():
        def client(p):
            with open(os.path.join(folder, "calls"), "a") as f:
                f.write(p + "\n")
            calls = open(os.path.join(folder, "calls")).read().split("\n").count(p)
            for word, times in fails.items():
                if word in p and calls <= times:
                    raise ConnectionError(f"{word} is down")
            return None if "silent" in p else p.upper()

        return client

    return make


def calls(folder):
    path = os.path.join(folder, "calls")
    return open(path).read().split("\n")[:-1] if os.path.exists(path) else []


def test_retries_and_errors(spark, tmp_path):
    d = spark.createDataFrame([(1, "good"), (2, "shaky"), (3, "dead"), (4, None), (5, "silent")], "k int, p string").coalesce(1)
    got = {x.k: (x.a, x.a_error) for x in answered(d, "p", "a", flaky(str(tmp_path), {"shaky": 2, "dead": 99})).collect()}
    assert got == {1: ("GOOD", None), 2: ("SHAKY", None), 3: (None, "ConnectionError: dead is down"), 4: (None, None), 5: (None, "no answer")}
    assert sorted(calls(tmp_path)) == sorted(["good"] + ["shaky"] * 3 + ["dead"] * 3 + ["silent"] * 3)


def test_second_run_sends_no_prompt(spark, tmp_path):
    d = spark.createDataFrame([(k, f"p{k % 5}") for k in range(20)] + [(20, None), (21, "dead"), (22, "")], "k int, p string").repartition(3)
    store, client = f"{tmp_path}/answers", flaky(str(tmp_path), {"dead": 3})
    assert answers(spark, store).count() == 0
    for run in (1, 2, 3):
        got = {x.k: (x.a, x.a_error) for x in answered(d, "p", "a", client, store).collect()}
        dead = (None, "ConnectionError: dead is down") if run == 1 else ("DEAD", None)  # a failure is sent again by the next run
        assert got == {k: (f"P{k % 5}", None) for k in range(20)} | {20: (None, None), 21: dead, 22: ("", None)}
        assert sorted(calls(tmp_path)) == sorted([*[f"p{k}" for k in range(5)], "", *["dead"] * (3 if run == 1 else 4)])
    assert answered(d.limit(0), "p", "a", client, store).count() == 0
    more = answered(d.select("k", "p", F.lit(1).alias("answer")), "p", "a", client, store)  # a clashing column
    assert more.columns == ["k", "p", "answer", "a", "a_error"] and more.count() == 23


def test_failures_are_no_missing_offers(spark, tmp_path):
    venues = spark.createDataFrame([(0, "a", "n", "http://a"), (1, "b", "n", "http://b"), (2, "c", "n", "http://c")], "row_idx long, venue_id string, venue_name string, `Source URL` string")
    pages = spark.createDataFrame([(0, "Happy hour specials every day from three"), (1, "Happy hour is dead here but great drinks"), (2, "")], "row_idx long, text string")

    def make():
        known = KeywordClient("")

        def client(p):
            if "dead" in p:
                raise TimeoutError("slow")
            return known(p)

        return client

    store = f"{tmp_path}/answers"
    for _ in range(2):
        got = {r.venue_id: (r["Incentive Category"], r["_meta"].extraction_source, r["Notes"]) for r in job.run(venues, pages, make, store=store).collect()}
        assert got["a"][:2] == ("Happy Hour", "llm") and got["b"] == ("No Incentive", "no_result", "Client failed: TimeoutError: slow") and got["c"] == ("No Incentive", "no_result", "")
    records = job.run(venues, pages, make, store=store).withColumn("_meta", F.col("_meta").withField("scraped_text", F.rpad(F.col("_meta.scraped_text"), 120, "x")))
    assert {r.venue_name for r in job.relabelled(records, lambda: (lambda p: 1 / 0)).collect()} == set()
    long = records.withColumn("_meta", F.col("_meta").withField("text_chars", F.lit(300)))
    assert sorted(r.text[:1] for r in training.run_rows(long).collect()) == ["x"]  # the empty page; what the client failed on is no example
    d = spark.createDataFrame([(1, "Happy hour every day is dead", "bar", [])], "k int, text string, business_type string, predictions array<struct<sentence:string,label:string,motivator:string,cuisine:string,confidence:double>>")
    assert cascade.run(d, make).first().client_error == "TimeoutError: slow"


@pytest.mark.parametrize("retries", [0, 1])
def test_retries_are_counted(spark, tmp_path, retries):
    d = spark.createDataFrame([("dead",)], "p string")
    answered(d, "p", "a", flaky(str(tmp_path), {"dead": 99}), f"{tmp_path}/s", retries).collect()
    assert len(calls(tmp_path)) == retries + 1 and answers(spark, f"{tmp_path}/s").first().tries == retries + 1
