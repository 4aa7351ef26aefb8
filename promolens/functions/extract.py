"""Value, status, motivator, cuisine and group fields of an incentive."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.functions import vocab
from promolens.functions.text import any_of, let, strip


def value(text: Column) -> Column:
    low = F.lower(text)
    got = lambda p, k=1: F.regexp_extract(text, p, k)
    return (
        F.when(low.rlike(r"\b(free admission|free entry|no cover|no charge|complimentary)\b"), "$0 (free)")
        .when(low.rlike(r"\bfree\b") & ~low.rlike(r"\bfree (parking|wifi|shipping)\b"), "$0 (free)")
        .when(low.rlike(r"\bopen bar\b"), "Open bar")
        .when(low.rlike(r"\bhalf[- ]?(price|off)\b"), "50% off")
        .when(low.rlike(r"\b(2[\s-]?for[\s-]?1|two[\s-]?for[\s-]?one|bogo)\b"), "2 for 1")
        .when(low.rlike(r"\d\s*%\s*off"), F.concat(got(r"(?i)(\d+)\s*%\s*off"), F.lit("% off")))
        .when(low.rlike(r"\d\s*%"), F.concat(got(r"(\d+)\s*%"), F.lit("%")))
        .when(text.rlike(vocab.AMOUNT), F.trim(F.concat(F.lit("$"), got(vocab.AMOUNT), F.lit(" "), F.coalesce(got(vocab.AMOUNT, 2), F.lit("")))))
        .otherwise("Unknown")
    )


def status(text: Column, phrases: list[str] = vocab.LIMITED) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.when(any_of(F.lower(t), phrases), "Limited Time").when(t.rlike(r"\S"), "Ongoing").otherwise("Unknown")


def motivator(category: Column, text: Column, urgent: str = vocab.URGENT) -> Column:
    base = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in vocab.MOTIVATORS.items() for x in kv]), category), F.lit("Value"))
    timed = category.isin("Happy Hour", "Discount", "Matinee Deal") & text.rlike(vocab.TIMED)
    return F.when(F.lower(text).rlike(urgent), "FOMO").when((base == "Value") & timed, "FOMO").otherwise(base)


def cuisine(business: Column, text: Column, category: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    known = F.try_element_at(F.create_map(*[F.lit(x) for kv in vocab.BUSINESS_TYPES.items() for x in kv]), business)
    return F.coalesce(F.when(category.isin("Happy Hour", "Live Music"), category), known, *[F.when(low.contains(k), v) for k, v in vocab.CUISINES], F.lit("Restaurant"))


def group_friendly(text: Column, category: Column) -> Column:
    low, real = F.lower(F.coalesce(text, F.lit(""))), ~F.coalesce(category, F.lit("")).isin("", "No Incentive", "Unknown")
    return F.when(real, "Yes").when(any_of(low, vocab.GROUP_NEGATIVES), "No").when(any_of(low, vocab.GROUP_SIGNALS), "Likely").otherwise("Unknown")


def _mapped(key: Column, groups: dict[str, list[str]], more: dict[str, str]) -> Column:
    known = {k: v for v, ks in groups.items() for k in ks} | more
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.trim(F.coalesce(key, F.lit(""))))


def broad_category(label: Column, compared: bool = False) -> Column:
    """The broad class of a fine label, null if it is unknown; reports know one label more."""
    return _mapped(label, vocab.BROAD, vocab.COMPARED_ONLY if compared else {})


def motivator_class(label: Column) -> Column:
    return _mapped(label, {}, vocab.MOTIVATOR_CLASSES)


def venue_type(raw: Column, training: bool = False) -> Column:
    return F.coalesce(_mapped(raw, vocab.VENUE_TYPES, vocab.TRAINED_TYPES if training else vocab.SERVED_TYPES), F.lit("Other"))


def relabel_motivator(category: Column) -> Column:
    return F.coalesce(_mapped(category, {}, vocab.RELABEL_MOTIVATORS), F.lit("Value"))


def llm_status(text: Column) -> Column:
    return status(text, vocab.LLM_LIMITED)


def llm_motivator(category: Column, text: Column) -> Column:
    return motivator(category, text, vocab.LLM_URGENT)


def _mentions(text: Column, pattern: str, most: int, acc: Column) -> Column:
    """One pattern's matches, in order, folded into what is taken so far.

    A match begins where the pieces and matches before it end, so a running position over the pieces between the matches and the
    matches gives every span. A span that begins or ends in one taken before is left out, as is one whose text, but for case, is taken already."""
    p = "(?iuU)" + pattern
    pairs = F.arrays_zip(F.split(text, p).alias("before"), F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("said"))  # the last piece has no match behind it

    def step(t: Column, m: Column) -> Column:
        a = t["at"] + F.length(m["before"])
        b = a + F.length(m["said"])
        what = strip(m["said"])
        stabbed = F.exists(t["spans"], lambda x: ((x["a"] <= a) & (a < x["b"])) | ((x["a"] < b) & (b <= x["b"])))
        new = m["said"].isNotNull() & (F.size(t["spans"]) < most) & ~stabbed & (what != "") & ~F.exists(t["said"], lambda x: F.lower(x) == F.lower(what))
        span = F.array(F.struct(a.alias("a"), b.alias("b")))
        return F.struct(F.coalesce(b, a).alias("at"), F.when(new, F.concat(t["spans"], span)).otherwise(t["spans"]).alias("spans"), F.when(new, F.concat(t["said"], F.array(what))).otherwise(t["said"]).alias("said"))

    return F.when(text.rlike(p), F.aggregate(pairs, F.struct(F.lit(0).alias("at"), acc["spans"].alias("spans"), acc["said"].alias("said")), step)).otherwise(acc)


def timing(text: Column, most: int = 6) -> Column:
    """The first six mentions of days and times, by pattern, then place. A match that begins or ends in one taken before is left out.

    No more than six spans are ever kept, so a text takes time in proportion to its length, however many mentions it has."""
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("spans"), F.array().cast("array<string>").alias("said"))

    def found(t: Column) -> Column:
        acc = nothing
        for pattern in vocab.TIMES:
            acc = let(acc, partial(_mentions, t, pattern, most))
        return F.array_join(acc["said"], ", ")

    any_time = "(?iuU)" + "|".join(f"(?:{p})" for p in vocab.TIMES)
    return F.when(text.rlike(any_time), let(text, found)).otherwise("Unknown")
