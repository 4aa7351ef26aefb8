"""Fetching, replayed: requests meet stored responses as they would meet a server, with retries, a time limit for each try and a budget for each venue.

A stored response is one try: (url, attempt from 1, status, ms it took, error or null, body). A try that takes longer than the limit counts as
the limit and fails; what timed out, broke off, or had status 429 or 5xx is tried again, as far as responses are stored and tries are left. A venue's
requests go one after the other: none begins, and nothing is tried again, once its budget is used up.

Times of tries are added up in windows over what is stored without the bodies; only the bodies of tries that give a page are joined, by url and
attempt, so that a body moves once at most. Responses of urls that nobody asks for are left out where they are read (a semi join, which Spark filters by a
Bloom filter of the urls).

Defined results: a null url or one without stored responses is ``missing`` and takes no time; a null body of a good response is the empty page; of several
responses with one url and attempt that with the smallest status, time and error counts, and any one of its bodies; requests that are alike are requests each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.sources import html

LIMIT_MS, BUDGET_MS, RETRIES = 10_000, 45_000, 2
TRY = ("attempt", "status", "ms", "error")


def _outcome(x: Column, limit: int) -> Column:
    return F.when(x["ms"] > limit, "timeout").when(x["error"].isNotNull(), "error").when(x["status"] == 200, "ok").otherwise("bad_status")


def _replayed(tries: Column, begins: Column, limit: int, budget: int | None) -> Column:
    """struct<ms, attempts, status, outcome, attempt>: what the tries of one request come to, if it begins so many milliseconds after its venue's first."""
    late = lambda at: F.lit(False) if budget is None else begins + at > budget
    nothing = F.struct(
        F.lit(0).cast("long").alias("ms"), F.lit(0).alias("attempts"), F.lit(None).cast("int").alias("status"), F.when(late(F.lit(0)), "deadline").otherwise("missing").alias("outcome"),
        F.lit(None).cast("int").alias("attempt"), F.lit(False).alias("done"))

    def step(t: Column, x: Column) -> Column:
        out = _outcome(x, limit)
        again = out.isin("timeout", "error") | ((out == "bad_status") & ((x["status"] == 429) | (x["status"] >= 500)))
        new = F.struct(
            (t["ms"] + F.least(x["ms"], F.lit(limit).cast("long"))).alias("ms"), (t["attempts"] + 1).alias("attempts"), F.when(out.isin("ok", "bad_status"), x["status"]).alias("status"), out.alias("outcome"),
            F.when(out == "ok", x["attempt"]).alias("attempt"), (~again).alias("done"))
        return F.when(t["done"] | late(t["ms"]), t).otherwise(new)

    return F.aggregate(tries, nothing, step)


def fetched(requests: DataFrame, responses: DataFrame, limit: int = LIMIT_MS, budget: int = BUDGET_MS, retries: int = RETRIES) -> DataFrame:
    """requests (venue, ord, url and what else they have) with status, attempts, begins and ms (milliseconds), outcome and html, empty but for good pages."""
    asked = requests.select("url").where("url IS NOT NULL").distinct()
    r = responses.where((F.col("attempt") >= 1) & (F.col("attempt") <= retries + 1)).join(asked, "url", "left_semi")
    r = r.select("url", F.col("attempt").cast("int").alias("attempt"), F.col("status").cast("int").alias("status"), F.col("ms").cast("long").alias("ms"), F.col("error").cast("string").alias("error"), "body")
    tries = r.groupBy("url", "attempt").agg(F.min(F.struct("status", "ms", "error")).alias("x"))  # a few for each url
    tries = tries.groupBy("url").agg(F.sort_array(F.collect_list(F.struct("attempt", "x.status", "x.ms", "x.error"))).alias("__tries"))
    d = requests.join(tries, "url", "left").withColumn("__tries", F.coalesce("__tries", F.array().cast("array<struct<attempt:int,status:int,ms:bigint,error:string>>")))
    d = d.withColumn("__all", _replayed(F.col("__tries"), F.lit(0), limit, None)["ms"])
    before = F.sum("__all").over(W.partitionBy("venue").orderBy("ord").rowsBetween(W.unboundedPreceding, -1))
    d = d.withColumn("begins", F.coalesce(before, F.lit(0).cast("long")))
    d = d.withColumn("__got", F.explode(F.array(_replayed(F.col("__tries"), F.col("begins"), limit, budget))))
    d = d.select(*requests.columns, "begins", "__got.ms", "__got.attempts", "__got.status", "__got.outcome", F.col("__got.attempt").alias("__attempt"))
    bodies = r.where(_outcome(F.struct(*TRY), limit) == "ok").groupBy(F.col("url").alias("__url"), F.col("attempt").alias("__at")).agg(F.min_by(F.coalesce("body", F.lit("")), F.struct("status", "ms", "error")).alias("__body"))
    d = d.join(bodies, (F.col("url") == F.col("__url")) & (F.col("__attempt") == F.col("__at")), "left")
    return d.select(*requests.columns, "begins", "ms", "attempts", "status", "outcome", F.coalesce("__body", F.lit("")).alias("html"))


def with_texts(pages: DataFrame) -> DataFrame:
    """fetched() pages with ``shell`` (drawn by scripts, so that a browser has to) and ``text``: the telling text of good pages that are no shells, else empty."""
    d = html.with_page(pages, F.when(F.col("outcome") == "ok", F.col("html")), "text", "body", "blocks", "heroes", "div_ids", to="__p")
    shell = (F.col("outcome") == "ok") & html.is_shell(F.col("__p"), F.col("html"))
    d = d.withColumn("shell", F.coalesce(shell, F.lit(False)))
    return d.withColumn("text", F.when((F.col("outcome") == "ok") & ~F.col("shell"), html.relevant_text(F.col("__p"))).otherwise("")).drop("__p")
