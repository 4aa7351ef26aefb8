"""Expected values worked out by hand for the text, schedule and extraction functions."""

import json

from pyspark.sql import functions as F

from promolens.functions import extract, schedule, text
from promolens.operators import compare
from promolens.sources.positions import picked
from promolens.sources.tables import json_values


def rows(spark, values, *columns):
    d = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [tuple(r)[1:] for r in d.select("k", *columns).orderBy("k").collect()]


def test_schedules(spark):
    v, p = F.col("v"), F.transform(schedule.periods(F.col("v")), lambda x: F.concat_ws("-", F.coalesce(x["start"], F.lit("")), F.coalesce(x["end"], F.lit(""))))
    cases = {
        "Monday–Friday 4:00 PM – 6:00 PM": ([1, 2, 3, 4, 5], ["16:00:00-18:00:00"], "recurring"),
        "Daily late afternoon/evening (varies by spot)": ([1, 2, 3, 4, 5, 6, 7], [], "recurring"),
        "Monday all day; Tuesday–Friday 4:00 PM – 6:00 PM": ([2, 3, 4, 5], ["16:00:00-18:00:00"], "recurring"),
        "Tuesday–Thursday before 6 PM": ([2, 3, 4], ["-18:00:00"], "recurring"),
        "3-6pm": ([], ["18:00:00-"], "recurring"), "Fri-Mon": ([5, 6, 7, 1], [], "recurring"), "12am - 12pm": ([], ["00:00:00-12:00:00"], "recurring"),
        "13pm": ([], [], "always"), "lunch": ([], [], "recurring"), "Unknown": ([], [], "always"), "": ([], [], "always"),
        "All showtimes for groups of 21+": ([], [], "always"),
    }
    got = rows(spark, list(cases), schedule.days(v), p, schedule.kind(v, F.lit("Ongoing")))
    assert dict(zip(cases, got, strict=True)) == cases


def test_incentive_json(spark):
    one = lambda t, e: json.loads(rows(spark, [t], F.to_json(schedule.incentives(F.lit("Group Rate"), F.lit("t"), F.lit("d"), F.col("v"), F.lit(e))))[0][0])
    assert one("2026-06-01 to 2026-06-30", "Limited Time")[0]["schedule"] == {"start_date": "2026-06-01", "end_date": "2026-06-30"}
    assert "schedule" not in one("lunch", "Ongoing")[0]
    assert one("lunch", "Ongoing")[0]["id"] == "group_rate"


def test_values(spark):
    cases = {"gluten free": "$0 (free)", "free parking and free gifts": "Unknown", "20 % off": "20% off", "5%": "5%", "$1,200": "$1", "$5 offset": "$5 off", "$12.50 admission": "$12.50 admission", "half-price": "50% off", "two for one": "2 for 1", "no": "Unknown"}
    assert [r[0] for r in rows(spark, list(cases), extract.value(F.col("v")))] == list(cases.values())


def test_sentences(spark):
    got = rows(spark, ["Happy hour daily at five. Happy hour daily at five! Read our privacy policy special deal\nshort. Two weak: special tickets", None, ""], text.candidates(F.col("v")))
    assert got == [(["Happy hour daily at five", "Two weak: special tickets"],), ([],), ([],)]


def test_quality_hint_flag(spark):
    assert [round(r[0], 2) for r in rows(spark, ["click here for $5 off", "no bonus at all in this one", "a a a a a a a"], text.quality(F.col("v")))] == [0.0, 0.3, 0.15]
    assert rows(spark, ["free concert with live music", "nothing"], text.category_hint(F.col("v"))) == [("Live Music",), (None,)]
    assert rows(spark, ["Unknown", "a", "—"], compare.flag(F.col("v"), F.lit("unknown"))) == [("~",), ("✗",), ("~",)]


def test_json_values_and_picks(spark):
    assert list(json_values(b'\xef\xbb\xbf[{"a": 1}, 2] {"a": 2}\n{"a": 3} oops {"a": 4}')) == [{"a": 1}, {"a": 2}, {"a": 3}]
    d = spark.createDataFrame([(k,) for k in range(4)], "row_idx long")
    assert [r.row_idx for r in picked(d, [3, -4, 3, 9]).orderBy("pos").collect()] == [3, 0, 3]
