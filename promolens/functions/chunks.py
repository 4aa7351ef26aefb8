"""Gates, scores and failure classes of page blocks, chunks, links and search results, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.functions import vocab
from promolens.functions.text import any_of, block_score, bordered, clean_url, hits, is_menu_block, let, strip

PRICE, PERCENT = r"\$\s?\d+", r"\d+\s?%"
#: The days of chunk_score(), between borders of ASCII words; two letters are looked at before anything else.
DAY = r"(?=[dfmstwDFMSTW][aehoruAEHORU])(?<![0-9A-Za-z_])(?i:mon|tue|wed|thu|fri|sat|sun|daily|weekly)(?![0-9A-Za-z_])"
WHEN = r"(?i)\b(mon|tue|wed|thu|fri|sat|sun|daily|weekly|happy hour|\d{1,2}\s?(am|pm))\b"


def _low(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")


def clean_text(text: Column) -> Column:
    """White-space runs as one space, stripped; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def truncated(text: Column, n: int = 36) -> Column:
    """— for nothing, else at most n characters and an ellipsis."""
    return F.when(F.coalesce(text, F.lit("")) == "", "—").when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("…"))).otherwise(text)


def bar(share: Column, width: int = 20) -> Column:
    """A share as a bar of full and empty blocks, rounded half to even."""
    full = F.greatest(F.lit(0), F.least(F.lit(width), F.bround(share * width).cast("int")))
    return F.concat(F.expr(f"repeat('█', {width})").substr(F.lit(1), full), F.expr(f"repeat('░', {width})").substr(F.lit(1), F.lit(width) - full))


def same_category(a: Column, b: Column) -> Column:
    return F.lower(F.trim(F.coalesce(a, F.lit("")))) == F.lower(F.trim(F.coalesce(b, F.lit(""))))


def is_membership(description: Column, teaser: Column) -> Column:
    return any_of(F.lower(F.concat_ws(" ", F.coalesce(description, F.lit("")), F.coalesce(teaser, F.lit("")))), vocab.MEMBERSHIP)


def has_hours(text: Column) -> Column:
    """Two clock times on one line."""
    return F.coalesce(text, F.lit("")).rlike(bordered(vocab.HOURS))


def has_price(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).contains("$") | _low(text).contains("% off")


def is_noise(text: Column) -> Column:
    few = lambda w: (F.size(w) > 8) & (F.size(F.array_distinct(w)) / F.size(w) < 0.35)
    return let(_low(text), lambda low: any_of(low, vocab.NOISE) | let(_words(low), few))


def is_chunk_menu(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    dollars = F.length(t) - F.length(F.replace(t, F.lit("$"), F.lit("")))
    return (dollars >= 2) & any_of(_low(text), vocab.CHUNK_FOOD) & ~any_of(_low(text), vocab.CHUNK_DEALS)


def chunk_score(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return let(_low(text), lambda low: hits(low, vocab.CHUNK_KEYWORDS)) + 2 * t.rlike(PRICE).cast("int") + 2 * t.rlike(PERCENT).cast("int") + t.rlike(bordered(r"(?i)\b(mon|tue|wed|thu|fri|sat|sun|daily|weekly)\b")).cast("int")


def told(text: Column, of: Column | None = None) -> Column:
    """struct<hits, price, percent, day>: what chunk_score counts in a text; of: what a text tells that holds this one, since it tells nothing else."""
    t = F.coalesce(text, F.lit(""))
    known = F.array(*[F.lit(k) for k in sorted(vocab.CHUNK_KEYWORDS)]) if of is None else of["hits"]
    has = lambda name, pattern: (t.rlike(pattern) if of is None else of[name] & t.rlike(pattern)).alias(name)
    return F.struct(let(_low(t), lambda low: F.filter(known, lambda k: F.contains(low, k))).alias("hits"), has("price", PRICE), has("percent", PERCENT), has("day", DAY))


def told_score(x: Column) -> Column:
    """chunk_score() of the text that tells x."""
    return F.size(x["hits"]) + 2 * x["price"].cast("int") + 2 * x["percent"].cast("int") + x["day"].cast("int")


def keyword_hits(text: Column) -> Column:
    """The sorted keywords that occur."""
    return let(_low(text), lambda low: F.array_sort(F.filter(F.array(*[F.lit(k) for k in vocab.CHUNK_KEYWORDS]), lambda k: F.contains(low, k))))


def flags(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.struct(t.rlike(PRICE).alias("has_price"), t.rlike(PERCENT).alias("has_percent"), t.rlike(WHEN).alias("has_time"))


def may_be_chunk(text: Column) -> Column:
    """text is cleaned; what has a score besides is a chunk."""
    return (F.length(text) >= 30) & ~is_noise(text) & ~is_chunk_menu(text)


def is_chunk(text: Column) -> Column:
    return may_be_chunk(text) & (chunk_score(text) > 0)


def is_hero(text: Column) -> Column:
    return F.length(text).between(20, 500) & (block_score(text) >= 1)


def is_block(text: Column) -> Column:
    return (F.length(text) >= 20) & ((block_score(text) >= 1) | has_hours(text)) & ~is_menu_block(text)


def link_score(href: Column, anchor: Column, words: list[str] = vocab.LINK_KEYWORDS) -> Column:
    return let(F.lower(F.concat_ws(" ", href, anchor)), lambda low: hits(low, words))


def host(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def resolved(href: Column, base: Column) -> Column:
    """A link's whole address, without query and fragment, if it stays on the base's host; else null.

    Trailing slashes go before the query does, so /a/?q becomes /a/."""
    h = strip(F.coalesce(href, F.lit("")))
    whole = F.when(h.startswith("/"), F.concat(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1), h)).when(h.startswith("http"), h)
    return let(whole, lambda w: F.when(host(w) == host(base), F.regexp_replace(F.regexp_replace(w, "/+$", ""), r"[?#].*$", "")))


def extra_paths(business_type: Column) -> Column:
    bt, of = _low(business_type), lambda k: F.array(*[F.lit(p) for p in vocab.EXTRA_PATHS[k]])
    return (
        F.when(any_of(bt, ["nightclub", "night club", "casino"]), of("nightclub"))
        .when(bt.contains("live music"), of("live_music"))
        .when(bt.contains("bar") & ~bt.contains("restaurant"), of("bar"))
        .when(bt.contains("entertainment"), of("entertainment"))
        .otherwise(F.array().cast("array<string>"))
    )


def is_own_result(venue: Column, link: Column, title: Column, snippet: Column) -> Column:
    """Whether a search result is about the venue itself: no aggregator, no list of places nearby, no stock question, and it names the venue."""
    domain = F.regexp_replace(F.lower(host(link)), r"^[w.]+", "")
    both = F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(snippet, F.lit("")))
    other = domain.isin(vocab.AGGREGATORS)
    for a in vocab.AGGREGATORS:
        other |= domain.endswith("." + a)
    named = (F.coalesce(venue, F.lit("")) == "") | F.contains(F.lower(both), _low(venue))
    return ~other & ~F.coalesce(title, F.lit("")).rlike(vocab.NEARBY_TITLE) & ~both.rlike(vocab.FAQ_NOISE) & named & (F.coalesce(snippet, F.lit("")) != "")


def price_terms(category: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in vocab.PRICE_TERMS.items() for x in kv]), category), F.lit(vocab.OTHER_PRICE_TERMS))


def failure(status: Column, title: Column, page: Column, n_chunks: Column) -> Column:
    """What a fetched page failed by; page is cleaned text."""
    stale = any_of(_low(title), vocab.STALE) | any_of(_low(page), vocab.STALE)
    return (
        F.when(status.isin(401, 403, 429), "blocked_or_forbidden")
        .when(status >= 400, "request_fail")
        .when(stale, "wrong_or_stale_url")
        .when(F.length(F.coalesce(page, F.lit(""))) < 300, "js_required_or_low_text")
        .when(F.coalesce(n_chunks, F.lit(0)) == 0, "no_incentive_keywords")
        .otherwise("ok")
    )


def fetch_failure(error: Column) -> Column:
    e = _low(error)
    return (
        F.when(any_of(e, ["dns lookup failed", "cannotresolvehost"]), "dns_unresolved")
        .when(e.contains("timeout"), "timeout")
        .when(e.contains("connection refused"), "connection_refused")
        .when(any_of(e, ["certificate", "ssl"]), "ssl_error")
        .otherwise("request_fail")
    )


def split_chunks(blob: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(blob, F.lit("")), r"\|\|\|"), strip), lambda x: F.length(x) > 0)


def url_key(url: Column) -> Column:
    return clean_url(F.regexp_replace(url, r";[^/?#]*(?=$|[?#])", ""))
