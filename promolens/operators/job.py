"""The main job: venues and their page texts to incentive records, with a pluggable extractor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import chunks, extract, schedule, text, vocab
from promolens.operators.clients import Client, answered

PROMPT_CHARS, TEASER_WORDS = 3000, 7
FAILED = "Client failed: "
PROMPT = "Find the best promotional offer in a venue's page and answer in JSON with category (one of: {categories}), teaser, timing and value.\nVenue type: {business}\nText:\n"
REWRITE = "Rewrite in at most 7 words{price}.\nText:\n"
ANSWER = "category string, teaser string, timing string, value string"
PLACE = {"venue_id": "venue_id", "venue_name": "name", "address": "address", "city": "city", "state": "state", "Business Type": "business_type", "Source URL": "url"}


def places(venues: DataFrame, *keys: str) -> DataFrame:
    """The fields of a venue that the job carries, renamed; those that are missing are null."""
    return venues.select(*keys, *[(F.col(f"`{a}`") if a in venues.columns else F.lit(None).cast("string")).alias(b) for a, b in PLACE.items()])


def _struct(**fields) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])


def empty_result(note: Column | str = "") -> Column:
    """The result of a page that holds no offer."""
    unknown = dict.fromkeys(("timing", "motivator", "cuisine", "value", "status"), "Unknown")
    return _struct(category="No Incentive", teaser="No incentive found", description="No incentive found", **unknown, notes=note, model_confidence=0.0, source="no_result")


def prompt(page: Column, business: Column) -> Column:
    """A page's candidate sentences (the whole page if it has none) in a prompt; null for an empty page."""
    some = text.let(text.candidates(page), lambda told: F.substring(F.when(F.size(told) > 0, F.array_join(told, " ")).otherwise(page), 1, PROMPT_CHARS))
    head, tail = PROMPT.replace("{categories}", " | ".join(vocab.CATEGORIES)).split("{business}")
    kind = F.when(F.coalesce(business, F.lit("")) == "", "Unknown").otherwise(business)
    return F.when(F.coalesce(page, F.lit("")) != "", F.concat(F.lit(head), kind, F.lit(tail), some))


def chat_turns(page: Column, business: Column, shots: list[tuple[str, str]] = ()) -> Column:
    """array<struct<role, content>>: examples and their answers, then the page's first 4000 characters."""
    said = F.concat(F.when(F.coalesce(business, F.lit("")) != "", F.concat(F.lit("[Venue type: "), business, F.lit("]\n\n"))).otherwise(""), F.substring(page, 1, 4000))
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(*[t for a, b in shots for t in (turn("user", F.lit(a)), turn("assistant", F.lit(b)))], turn("user", said))


def parsed_answer(raw: Column) -> Column:
    """The JSON object between the first and the last brace; its fields are null if it is none."""
    return F.from_json(F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)(\{.*\})", 1), ANSWER)


def parsed_fenced(raw: Column) -> Column:
    """The JSON object of an answer that may stand in a code fence, with defaults."""
    t = text.strip(F.coalesce(raw, F.lit("")))
    inner = F.when(t.startswith("```"), F.regexp_replace(F.get(F.split(t, "```"), F.lit(1)), "^json", "")).otherwise(t)
    a = F.from_json(inner, ANSWER + ", description string")
    rest = {k: F.coalesce(a[k], F.lit("")) for k in ("value", "timing", "teaser", "description")}
    return _struct(category=F.coalesce(a["category"], F.lit("No Incentive")), **rest)


def result(raw: Column, source: str = "llm") -> Column:
    """The result that an extractor's answer gives; unknown categories and bad answers give the empty one."""
    or_unknown = lambda c: F.when(F.coalesce(c, F.lit("")) == "", "Unknown").otherwise(c)

    def made(a: Column) -> Column:
        teaser, timing = text.strip(F.coalesce(a["teaser"], F.lit(""))), or_unknown(a["timing"])
        both = F.concat_ws(" ", teaser, timing)
        found = _struct(
            category=a["category"], teaser=teaser, description=teaser, timing=timing, motivator=extract.llm_motivator(a["category"], both), cuisine="Unknown", value=or_unknown(a["value"]),
            status=extract.llm_status(both), notes=source, model_confidence=1.0, source=source)
        return F.when(a["category"].isin(*[c for c in vocab.CATEGORIES if c != "No Incentive"]), found).otherwise(empty_result())

    return text.let(parsed_answer(raw), made)


def failed(error: Column) -> Column:
    """The result of a page whose client gave no answer: no offer is known of it, and its notes say why."""
    return empty_result(F.concat(F.lit(FAILED), error))


def told(raw: Column, error: Column, source: str = "llm") -> Column:
    return F.when(error.isNotNull(), failed(error)).otherwise(result(raw, source))


def rescued(found: Column, pricing: Column) -> Column:
    """A result whose value is unknown takes it from the text of a search for prices, if that tells one."""
    value = extract.value(F.coalesce(pricing, F.lit("")))
    needs = (found["value"] == "Unknown") & ~found["category"].isin("No Incentive", "Unknown") & (value != "Unknown")
    return F.when(needs, found.withField("value", value).withField("notes", F.concat(found["notes"], F.lit(" [value: pricing search]")))).otherwise(found)


def rewrite_prompt(teaser: Column) -> Column:
    """A prompt for teasers of more than TEASER_WORDS words; null for others."""
    words = F.size(F.filter(F.split(teaser, r"(?U)\s+"), lambda w: w != ""))
    long = F.coalesce((teaser != "No incentive found") & (words > TEASER_WORDS), F.lit(False))
    head, tail = REWRITE.split("{price}")
    return F.when(long, F.concat(F.lit(head), F.when(chunks.has_price(teaser), " and keep the price").otherwise(""), F.lit(tail), teaser))


def rewritten(teaser: Column, answer: Column) -> Column:
    """The answer if it is shorter and keeps the price, else the teaser."""
    good = (F.length(answer) > 0) & (F.length(answer) < F.length(teaser)) & (~chunks.has_price(teaser) | chunks.has_price(answer))
    return F.when(F.coalesce(good, F.lit(False)), answer).otherwise(teaser)


def run(venues: DataFrame, pages: DataFrame, extractor: Callable[[], Client], rewriter: Callable[[], Client] | None = None, pricing: DataFrame | None = None, source: str = "llm", store: str | None = None) -> DataFrame:
    """One record for each venue (row_idx, the venue's fields) from pages (row_idx, text, and if it has them scrape_source, scrape_time_s), and pricing (row_idx, pricing_text).

    store: where answers are kept (see answered()). A page whose client failed says so in its notes, which begin with FAILED; it is no example of a page without an offer."""
    v = places(venues, "row_idx")
    more = {"scrape_source": F.lit(None).cast("string"), "scrape_time_s": F.lit(0.0)}
    pages = pages.select("row_idx", "text", *[(F.col(c) if c in pages.columns else d).alias(c) for c, d in more.items()])
    d = v.join(pages, "row_idx", "left").withColumn("text", F.coalesce("text", F.lit("")))
    d = answered(d.withColumn("prompt", prompt(F.col("text"), F.col("business_type"))), "prompt", "raw", extractor, store)
    d = d.select(*[c for c in d.columns if c not in ("prompt", "raw", "raw_error")], told(F.col("raw"), F.col("raw_error"), source).alias("found"))
    if pricing is not None:
        d = d.join(pricing.select("row_idx", "pricing_text"), "row_idx", "left").withColumn("found", rescued(F.col("found"), F.col("pricing_text"))).drop("pricing_text")
    d = d.withColumn("teaser", F.col("found.teaser"))
    if rewriter is not None:
        d = answered(d.withColumn("prompt", rewrite_prompt(F.col("teaser"))), "prompt", "short", rewriter, store).withColumn("teaser", rewritten(F.col("teaser"), F.col("short"))).drop("prompt", "short", "short_error")
    return d.select(*record())


def record() -> list[Column]:
    """The output record of a row (the place's fields, row_idx, text, found, teaser, scrape_source, scrape_time_s)."""
    c, f = F.col, F.col("found")
    fields = {
        "venue_id": c("venue_id"), "row": c("row_idx") + 1, "venue_name": F.coalesce("name", F.lit("Unknown")), "address": c("address"), "city": c("city"), "state": c("state"), "Business Type": c("business_type"),
        "Cuisine / Experience Category": extract.cuisine(c("business_type"), c("text"), f["category"]), "Incentive Category": f["category"], "Incentive Teaser": c("teaser"), "Full Incentive Description": f["description"],
        "Days / Timing Restrictions": f["timing"], "Group Friendly?": extract.group_friendly(c("text"), f["category"]), "Psychological Motivator Type": f["motivator"], "Estimated Perceived Value ($ range)": f["value"],
        "Expiration / Ongoing": f["status"], "Source URL": F.coalesce("url", F.lit("")), "Notes": f["notes"], "incentives": schedule.incentives(f["category"], f["category"], f["description"], f["timing"], f["status"]),
        "_meta": F.struct(F.round(f["model_confidence"], 4).alias("model_confidence"), F.round("scrape_time_s", 2).alias("scrape_time_s"), F.lit(0.0).alias("inference_time_s"), F.length("text").alias("text_chars"),
                          c("scrape_source"), f["source"].alias("extraction_source"), c("text").alias("scraped_text")),
    }
    return [v.alias(k) for k, v in fields.items()]


def metrics(records: DataFrame) -> DataFrame:
    """One row: venues, those with text, average times and confidence, and how many came from each source (a map)."""
    m = F.col("_meta")
    sources = records.groupBy(m["extraction_source"].alias("s")).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("s", "n")))).alias("by_source"))
    avg = lambda k: F.coalesce(F.avg(m[k]), F.lit(0.0)).alias(f"avg_{k}")
    one = records.agg(F.count(F.lit(1)).alias("n"), F.count_if(m["text_chars"] > 0).alias("scraped"), avg("scrape_time_s"), avg("inference_time_s"), avg("model_confidence"))
    return one.crossJoin(F.broadcast(sources))  # one row each


def relabelled(records: DataFrame, extractor: Callable[[], Client], store: str | None = None) -> DataFrame:
    """Records with at least 100 characters of page text, labelled anew by an extractor; the old label is kept beside. Those that it failed on are left out: nothing is known of them."""
    m = F.col("_meta")
    d = records.where(F.length(F.coalesce(m["scraped_text"], F.lit(""))) >= 100)
    d = d.select("venue_name", "Business Type", F.coalesce("Incentive Category", F.lit("No Incentive")).alias("old"), m["scraped_text"].alias("text"))
    d = answered(d.withColumn("prompt", prompt(F.col("text"), F.col("Business Type"))), "prompt", "raw", extractor, store).where("raw_error IS NULL")
    a = parsed_fenced(F.col("raw"))
    d = d.withColumn("a", a)
    none = F.col("a.category") == "No Incentive"
    text_or = lambda k: F.when(none, "").otherwise(F.col(f"a.{k}"))
    meta = F.struct(F.col("text").alias("scraped_text"), F.lit("relabelled").alias("extraction_source"), F.col("old").alias("old_category"), F.when(~none, F.col("a.value")).alias("value"), F.when(~none, F.col("a.timing")).alias("timing"), F.length("text").alias("text_chars"))
    return d.select(
        "venue_name", "Business Type", F.col("a.category").alias("Incentive Category"), F.when(none, "Value").otherwise(extract.relabel_motivator(F.col("a.category"))).alias("Psychological Motivator Type"),
        F.col("Business Type").alias("Cuisine / Experience Category"), text_or("teaser").alias("Incentive Teaser"), text_or("description").alias("Full Incentive Description"), meta.alias("_meta"))


def relabel_counts(records: DataFrame) -> DataFrame:
    none = F.col("Incentive Category") == "No Incentive"
    return records.agg(F.count(F.lit(1)).alias("records"), F.count_if(~none).alias("positive"), F.count_if(none).alias("negative"), F.count_if(~none & (F.col("Incentive Category") != F.col("_meta.old_category"))).alias("changed"))
