"""Decisions of a crawl, over stored pages: which paths count, which are tried next, which text a venue ends with.

Pages come as (venue, path, ord, attempt, text): ord is the order of the paths, attempt counts fetches of one path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.functions import chunks, vocab
from promolens.functions.text import page_score

GOOD, SPARSE, RETRIED, LINKS = 3, 300, 3, 5


def replaced(pages: DataFrame) -> DataFrame:
    """(venue, path, ord, text, score): of each path's attempts the first with the best score; its place stays that of the first attempt."""
    scored = pages.withColumn("score", page_score(F.col("text")))
    best = F.max_by(F.struct("text", "score"), F.struct(F.col("score"), -F.col("attempt")))
    return scored.groupBy("venue", "path").agg(F.min("ord").alias("ord"), best.alias("b")).select("venue", "path", "ord", "b.text", "b.score")


def until_good(pages: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Each venue's pages (with a score) up to the first good one, among the given paths if any: later ones would not have been fetched."""
    good = (F.col("score") >= GOOD) & (F.col("path").isin(paths) if paths else F.lit(True))
    stop = pages.where(good).groupBy("venue").agg(F.min("ord").alias("stop"))
    return pages.join(stop, "venue", "left").where(F.col("stop").isNull() | (F.col("ord") <= F.col("stop"))).drop("stop")


def best_scores(pages: DataFrame) -> DataFrame:
    """(venue, best): the largest score, 0 without any."""
    return pages.groupBy("venue").agg(F.coalesce(F.max("score"), F.lit(0)).alias("best"))


def unsettled(pages: DataFrame) -> DataFrame:
    """Venues whose best page is not good: the next pass is for them."""
    return best_scores(pages).where(F.col("best") < GOOD).select("venue")


def next_paths(pages: DataFrame, venues: DataFrame) -> DataFrame:
    """(venue, path): the extra paths of the venue's business type that were not tried, for unsettled venues."""
    seen = pages.select("venue", "path").distinct()
    extra = unsettled(pages).join(venues.select("venue", "business_type"), "venue").select("venue", F.posexplode(chunks.extra_paths(F.col("business_type"))).alias("k", "path"))
    return extra.join(seen, ["venue", "path"], "left_anti").select("venue", "path", "k")


def sparse_paths(pages: DataFrame) -> DataFrame:
    """(venue, path): the first RETRIED known paths, in the list's order, that gave little text."""
    known = F.create_map(*[x for k, p in enumerate(vocab.PATHS) for x in (F.lit(p), F.lit(k))])
    little = pages.where(F.length(F.coalesce("text", F.lit(""))) < SPARSE).withColumn("k", F.try_element_at(known, F.col("path"))).where("k IS NOT NULL")
    return little.withColumn("n", F.row_number().over(W.partitionBy("venue").orderBy("k"))).where(F.col("n") <= RETRIED).select("venue", "path", "k")


def archived_text(snapshots: DataFrame) -> DataFrame:
    """(venue, text): of stored snapshots (venue, path, text) the best, tried in the archive's order until one is good; the first of equal ones."""
    order = F.create_map(*[x for k, p in enumerate(vocab.ARCHIVE_PATHS) for x in (F.lit(p), F.lit(k))])
    s = snapshots.withColumn("ord", F.try_element_at(order, F.col("path"))).where("ord IS NOT NULL AND coalesce(text, '') <> ''").withColumn("score", page_score(F.col("text")))
    return until_good(s).groupBy("venue").agg(F.max_by("text", F.struct(F.col("score"), -F.col("ord"))).alias("text"))


def search_text(results: DataFrame, answers: DataFrame | None = None, most: int = 8000) -> DataFrame:
    """(venue, text): a venue's own search results (venue, pos, link, title, snippet) in order, after the answer box (venue, answer) if it is no stock question."""
    own = results.where(chunks.is_own_result(*[F.col(c) for c in ("venue", "link", "title", "snippet")])).select("venue", "pos", F.concat(F.coalesce("title", F.lit("")), F.lit(". "), "snippet").alias("t"))
    if answers is not None:
        box = answers.where(~F.col("answer").rlike(vocab.FAQ_NOISE) & (F.col("answer") != ""))
        own = own.unionByName(box.select("venue", F.lit(-1).cast(own.schema["pos"].dataType).alias("pos"), F.col("answer").alias("t")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), " ")
    return own.groupBy("venue").agg(F.substring(joined, 1, most).alias("text"))


def search_query(name: Column, city: Column, terms: Column | str = "happy hour specials deals") -> Column:
    return F.trim(F.concat(F.lit('"'), name, F.lit('" '), F.coalesce(city, F.lit("")), F.lit(" "), terms if isinstance(terms, Column) else F.lit(terms)))


def crawled_item(pages: DataFrame, listed: int | None = None, chars: int | None = None) -> DataFrame:
    """pages (with status, and p as the HTML reader gives it) as scraped items: title, score, hits, best chunk, all chunks, failure class.

    Every chunk is listed, with its whole text; listed=8, chars=1000 cut both, as the reference's items do."""
    from promolens.sources.html import telling_chunks

    d = pages.withColumn("page", chunks.clean_text(F.col("p.text"))).withColumn("page_title", chunks.clean_text(F.col("p.title"))).withColumn("told", chunks.told(F.col("page")))
    d = d.withColumn("chunks", telling_chunks(F.col("p"), F.col("told")))
    best, shown = F.get("chunks", F.lit(0)), lambda t: t if chars is None else F.substring(t, 1, chars)
    return d.select(
        *[c for c in pages.columns if c != "p"], "page_title", F.length("page").alias("text_chars"), chunks.told_score(F.col("told")).alias("incentive_score"), F.array_join("told.hits", ", ").alias("keyword_hits"),
        F.coalesce(shown(best["t"]), F.lit("")).alias("top_candidate_text"), F.coalesce(best["s"], F.lit(0)).alias("top_candidate_score"),
        F.array_join(F.transform("chunks" if listed is None else F.slice("chunks", 1, listed), lambda c: shown(c["t"])), " ||| ").alias("all_candidate_chunks"),
        chunks.failure(F.col("status"), F.col("page_title"), F.col("page"), F.size("chunks")).alias("failure_type"))
