"""Timing strings to days, periods and nested schedules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.functions import vocab
from promolens.functions.text import any_of, let, slug

_DAY = vocab.DAY
_RANGE = rf"(?i)\b({_DAY})\s*(?:-|–|through|to)\s*({_DAY})\b"
_TIME = r"\d{1,2}(?::\d{2})?\s*(?:am|pm)"
_TIMES = rf"(?i)({_TIME})\s*(?:-|–|to)\s*({_TIME})"
_SINGLE = r"(?i)\b(\d{1,2}:\d{2}\s*(?:am|pm)?|\d{1,2}\s*(?:am|pm))\b"
_DATE = r"\b(\d{4}-\d{2}-\d{2})\b"
ZONE = "America/Los_Angeles"


def day_number(day: Column) -> Column:
    names = F.create_map(*[F.lit(x) for k, d in enumerate(vocab.DAYS, 1) for x in (d[:3], k)])
    return F.try_element_at(names, F.substring(F.lower(day), 1, 3))


def day_range(a: Column, b: Column) -> Column:
    return F.when(a <= b, F.sequence(a, F.greatest(a, b))).otherwise(F.concat(F.sequence(a, F.lit(7)), F.sequence(F.lit(1), b)))


def days(timing: Column) -> Column:
    low = F.lower(F.coalesce(timing, F.lit("")))
    ints = lambda *x: F.array(*[F.lit(i) for i in x])
    named = F.filter(F.array(*[F.when(low.rlike(rf"\b(?:{d}|{d[:3]})s?\b"), F.lit(k)).otherwise(F.lit(0)) for k, d in enumerate(vocab.DAYS, 1)]), lambda x: x > 0)
    first, last = (day_number(F.regexp_extract(low, _RANGE, k)) for k in (1, 2))
    return (
        F.when(any_of(low, ["daily", "every day", "each day", "all week", "7 days", "nightly", "every night"]), ints(*range(1, 8)))
        .when(any_of(low, ["weekday", "monday-friday", "mon-fri", "monday through friday", "monday - friday", "monday – friday"]), ints(*range(1, 6)))
        .when(any_of(low, ["weekend"]), ints(6, 7))
        .when(low.rlike(_RANGE), day_range(F.coalesce(first, F.lit(1)), F.coalesce(last, F.lit(1))))
        .otherwise(named)
    )


def clock(t: Column) -> Column:
    """12-hour text as HH:MM:00; null for hours beyond 23."""
    half = F.lower(F.regexp_extract(t, r"(?i)(am|pm)", 1))

    def made(p: Column) -> Column:
        h = F.when((p["half"] == "pm") & (p["h"] != 12), p["h"] + 12).when((p["half"] == "am") & (p["h"] == 12), F.lit(0)).otherwise(p["h"])
        return F.when(h <= 23, F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.when(p["m"] == "", "00").otherwise(p["m"]), F.lit(":00")))

    return let(F.struct(F.regexp_extract(t, r"(\d{1,2})", 1).try_cast("int").alias("h"), F.regexp_extract(t, r":(\d{2})", 1).alias("m"), half.alias("half")), made)


def periods(timing: Column) -> Column:
    t = F.coalesce(timing, F.lit(""))
    pairs = F.arrays_zip(F.regexp_extract_all(t, F.lit(_TIMES), F.lit(1)).alias("a"), F.regexp_extract_all(t, F.lit(_TIMES), F.lit(2)).alias("b"))
    made = F.transform(pairs, lambda p: F.struct(clock(p["a"]).alias("start"), clock(p["b"]).alias("end")))
    made = F.filter(made, lambda p: p["start"].isNotNull())
    one = clock(F.regexp_extract(t, _SINGLE, 1))
    before = F.lower(F.regexp_extract(t, r"(?is)^(.*?)" + _SINGLE[4:], 1)).rlike(r"\bbefore\b")
    none = F.lit(None).cast("string")
    single = F.array(F.struct(F.when(~before, one).otherwise(none).alias("start"), F.when(before, one).otherwise(none).alias("end")))
    empty = F.array().cast("array<struct<start:string,end:string>>")
    return F.when(F.size(made) > 0, made).when(t.rlike(_SINGLE) & one.isNotNull(), single).otherwise(empty)


def _kind(timing: Column, expiry: Column, found: Column) -> Column:
    low = F.lower(F.coalesce(timing, F.lit("")))
    return (
        F.when((expiry == "Limited Time") & low.rlike(_DATE), "date_range")
        .when(low.isin("unknown", ""), "always")
        .when((F.size(found["d"]) > 0) | (F.size(found["p"]) > 0) | any_of(low, vocab.PERIOD_WORDS), "recurring")
        .otherwise("always")
    )


def _found(timing: Column) -> Column:
    return F.struct(days(timing).alias("d"), periods(timing).alias("p"))


def kind(timing: Column, expiry: Column) -> Column:
    return let(_found(timing), lambda f: _kind(timing, expiry, f))


def incentives(category: Column, title: Column, description: Column, timing: Column, expiry: Column) -> Column:
    """The nested array of zero or one incentive with its schedule."""

    def entry(f: Column) -> Column:
        of, d, p = f["of"], f["f"]["d"], f["f"]["p"]
        dates = F.regexp_extract_all(timing, F.lit(_DATE), F.lit(1))
        recurring, ranged = of == "recurring", of == "date_range"
        parsed = recurring & ((F.size(d) > 0) | (F.size(p) > 0))
        schedule = F.when(parsed | ranged, F.struct(
            F.when(recurring & (F.size(d) > 0), d).alias("days"), F.when(recurring & (F.size(p) > 0), p).alias("periods"), F.when(recurring, F.lit(ZONE)).alias("timezone"),
            F.when(ranged, F.get(dates, F.lit(0))).alias("start_date"), F.when(ranged, F.coalesce(F.get(dates, F.lit(1)), F.get(dates, F.lit(0)))).alias("end_date"),
        ))
        return F.struct(slug(category).alias("id"), title.alias("title"), description.alias("description"), of.alias("type"), F.lit(None).cast("string").alias("priority"), schedule.alias("schedule"))

    made = F.transform(F.array(_found(timing)), lambda f: F.struct(f.alias("f"), _kind(timing, expiry, f).alias("of")))
    one = F.transform(made, entry)
    return F.when(F.coalesce(category, F.lit("")).isin("", "No Incentive", "Unknown"), F.slice(one, 1, 0)).otherwise(one)
