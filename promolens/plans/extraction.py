"""Extraction over all sentences of the stored texts.

The stored texts hold almost no offers, so each sentence follows an offer, or a timing, whose amounts, days and hours its document's id and
its place give; the queries read whole texts and grow with them."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.functions import chunks, extract, schedule, text, vocab
from promolens.operators import cascade, job
from promolens.operators.clients import KeywordClient
from promolens.plans.queries import _count, _either, query
from promolens.sources.tables import table

_OFFERS = [
    ("Happy Hour", "Happy hour daily {h}pm to {g}pm with ${n} off cocktails"), ("Discount", "Save {p}% off tickets every {day}"), ("Free", "Free admission for kids under {h}"),
    ("Free", "Gluten free menu and free parking"), ("Live Music", "Live music and open bar tonight only"), ("Group Booking", "Group rate of ${n}.50 admission for large party of {g}"),
    ("Matinee Deal", "Half-price matinee on {day}s while supplies last"), ("Unknown", "Two for one burgers on {day}s at {h}:30 am"), ("No Incentive", "Contact us for directions"), ("Discount", "${n},200 prize ${p} offset"),
]
_TIMES = [
    "{day}–{late} {h}:00 PM – {g}:00 PM", "{day}–{late} {h}:00 PM – {g}:00 PM and 9:00 PM – close", "Daily {h}:15 PM – {g}:30 PM", "Daily late afternoon/evening (varies by spot)",
    "Every {day} all day", "{day} all day; {late}–Friday 4:00 PM – {g}:00 PM", "{day}–{late} before {h} PM", "Select evenings ({day} starting at {h} PM or similar)", "All showtimes for groups of {p}+",
    "{h}-{g}pm", "weekdays {h}am", "{h}am - {g}pm", "13pm", "lunch", "Unknown", "", "2026-06-01 to 2026-1{d}-30", "weekends at {h} am",
]


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _listed(items: list[str], key: str) -> str:
    return "[" + ", ".join(map(_quoted, items)) + f"][{key} % {len(items)} + 1]"


def _picked(items: list[str], key: Column | str = "doc_id") -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in items]), ((F.col(key) if isinstance(key, str) else key) % len(items) + 1).cast("int"))


def _filled(template: Column, n: Column) -> Column:
    """A template with the amounts, days and hours that a number gives."""
    names = [d.capitalize() for d in vocab.DAYS]
    whole = lambda c: F.floor(c).cast("string")
    put = {"{n}": whole(n % 40 + 1), "{p}": whole(n % 19 * 5 + 5), "{h}": whole(n % 12 + 1), "{g}": whole(n / 5 % 12 + 1), "{d}": whole(n % 3), "{day}": _picked(names, n), "{late}": _picked(names, F.floor(n / 7))}
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), kv[1]), put.items(), template)


def _put(template: str, n: str) -> str:
    """_filled() in SQL."""
    names = [d.capitalize() for d in vocab.DAYS]
    put = {"{n}": f"{n} % 40 + 1", "{p}": f"{n} % 19 * 5 + 5", "{h}": f"{n} % 12 + 1", "{g}": f"CAST(floor({n} / 5) AS BIGINT) % 12 + 1", "{d}": f"{n} % 3"}
    put = {k: f"CAST({v} AS VARCHAR)" for k, v in put.items()} | {"{day}": _listed(names, n), "{late}": _listed(names, f"CAST(floor({n} / 7) AS BIGINT)")}
    return reduce(lambda c, kv: f"replace({c}, '{kv[0]}', {kv[1]})", put.items(), template)


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, category, s): each document and the offer that its id gives."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _picked([c for c, _ in _OFFERS]).alias("category"), _filled(_picked([s for _, s in _OFFERS]), F.col("doc_id")).alias("s"))


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, k, n, sentence): every sentence of every text, k its place."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("k", "sentence"))
    return d.withColumn("n", F.col("doc_id") * 31 + F.col("k"))


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, k, n, category, s): every sentence after an offer."""
    d = _sentences(spark, sf_dir)
    return d.select("doc_id", "k", "n", _picked([c for c, _ in _OFFERS], "n").alias("category"), F.concat(_filled(_picked([s for _, s in _OFFERS], "n"), F.col("n")), F.lit(" "), "sentence").alias("s"))


_K = """SELECT doc_id, s AS sentence, k, doc_id * 31 + k AS n FROM (SELECT doc_id, s, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) - 1 AS INT) AS k FROM (SELECT doc_id, trim(s) AS s, i
    FROM (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[.!?\n]')) AS s, generate_subscripts(regexp_split_to_array(coalesce(text, ''), '[.!?\n]'), 1) AS i FROM documents) WHERE length(trim(s)) >= 10) GROUP BY doc_id, s)"""
_S = f"SELECT doc_id, k, n, {_listed([c for c, _ in _OFFERS], 'n')} AS c, s, lower(s) AS l FROM (SELECT doc_id, k, n, {_put(_listed([s for _, s in _OFFERS], 'n'), 'n')} || ' ' || sentence AS s FROM ({_K}))"
_T = f"SELECT doc_id, k, n, t, lower(t) AS l, CASE WHEN contains(t, '2026') THEN 'Limited Time' ELSE 'Ongoing' END AS e FROM (SELECT doc_id, k, n, {_put(_listed(_TIMES, 'n'), 'n')} || CASE WHEN n % 2 = 0 THEN ' ' || sentence ELSE '' END AS t FROM ({_K}))"

# --- schedules, in SQL of its own ------------------------------------------------------------------------------------

_NAMES = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
_WORD = "(" + "|".join(f"{d[:3]}(?:{d[3:]})?" for d in _NAMES) + ")"
_NUMBER = lambda x: "CASE left({}, 3) {} END".format(x, " ".join(f"WHEN '{d[:3]}' THEN {k}" for k, d in enumerate(_NAMES, 1)))
_SPAN = rf"'\b{_WORD}\s*(?:-|–|through|to)\s*{_WORD}\b'"
_DAYS = f"""CASE WHEN regexp_matches(l, 'daily|every day|each day|all week|7 days|nightly|every night') THEN '1,2,3,4,5,6,7'
    WHEN regexp_matches(l, 'weekday|monday-friday|mon-fri|monday (through|-|–) friday') THEN '1,2,3,4,5' WHEN contains(l, 'weekend') THEN '6,7'
    WHEN regexp_matches(l, {_SPAN}) THEN (SELECT array_to_string(CASE WHEN a <= b THEN range(a, b + 1) ELSE list_concat(range(a, 8), range(1, b + 1)) END, ',') FROM (SELECT {_NUMBER(f"regexp_extract(l, {_SPAN}, 1)")} AS a, {_NUMBER(f"regexp_extract(l, {_SPAN}, 2)")} AS b))
    ELSE array_to_string(list_filter([{", ".join(f"CASE WHEN regexp_matches(l, {chr(39)}{chr(92)}b({d}|{d[:3]})s?{chr(92)}b{chr(39)}) THEN {k} END" for k, d in enumerate(_NAMES, 1))}], lambda x: x IS NOT NULL), ',') END"""
_HOUR = r"\d{1,2}(?::\d\d)?\s*(?:am|pm)"


def _clock(x: str) -> str:
    hour, half = rf"CAST(regexp_extract({x}, '\d+') AS INT)", f"regexp_extract({x}, '[ap]m')"
    h = f"CASE WHEN {half} = 'pm' AND {hour} <> 12 THEN {hour} + 12 WHEN {half} = 'am' AND {hour} = 12 THEN 0 ELSE {hour} END"
    return rf"CASE WHEN {h} <= 23 THEN lpad(CAST({h} AS VARCHAR), 2, '0') || ':' || coalesce(nullif(regexp_extract({x}, ':(\d\d)', 1), ''), '00') || ':00' END"


_ONE = r"'\b(\d{1,2}:\d\d\s*(?:am|pm)?|\d{1,2}\s*(?:am|pm))\b'"
_FIRST = f"regexp_extract(l, {_ONE}, 1)"
_PERIODS = rf"""coalesce((SELECT nullif(string_agg(a || '-' || coalesce(b, ''), ',' ORDER BY k), '') FROM (SELECT k, {_clock("x")} AS a, {_clock("y")} AS b FROM (SELECT unnest(regexp_extract_all(l, '({_HOUR})\s*(?:-|–|to)\s*({_HOUR})', 1)) AS x,
    unnest(regexp_extract_all(l, '({_HOUR})\s*(?:-|–|to)\s*({_HOUR})', 2)) AS y, generate_subscripts(regexp_extract_all(l, '({_HOUR})\s*(?:-|–|to)\s*({_HOUR})', 1), 1) AS k)) WHERE a IS NOT NULL),
    CASE WHEN {_FIRST} = '' THEN '' WHEN regexp_matches(left(l, position({_FIRST} IN l) - 1), '\bbefore\b') THEN '-' || {_clock(_FIRST)} ELSE {_clock(_FIRST)} || '-' END, '')"""
_KIND = rf"""CASE WHEN e = 'Limited Time' AND regexp_matches(l, '\b\d{{4}}-\d\d-\d\d\b') THEN 'date_range' WHEN l IN ('unknown', '') THEN 'always'
    WHEN days <> '' OR periods <> '' OR regexp_matches(l, {_either(vocab.PERIOD_WORDS)}) THEN 'recurring' ELSE 'always' END"""
_SCHEDULES = f"SELECT *, {_KIND} AS type FROM (SELECT *, {_DAYS} AS days, {_PERIODS} AS periods FROM ({_T}))"


def _joined(c: Column) -> Column:
    return F.array_join(c, ",")


def _spans(p: Column) -> Column:
    return _joined(F.transform(p, lambda x: F.concat(F.coalesce(x["start"], F.lit("")), F.lit("-"), F.coalesce(x["end"], F.lit("")))))


def _timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    t = _sentences(spark, sf_dir).select("doc_id", "k", "n", F.concat(_filled(_picked(_TIMES, n), n), F.when(n % 2 == 0, F.concat(F.lit(" "), "sentence")).otherwise("")).alias("t"))
    return t.withColumn("e", F.when(F.col("t").contains("2026"), "Limited Time").otherwise("Ongoing"))


@query("schedules", f"SELECT doc_id, k, type, days, periods FROM ({_SCHEDULES})")
def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timing strings, half of them with the sentence after them, as days, periods and type."""
    t = F.col("t")
    return _timings(spark, sf_dir).select("doc_id", "k", schedule.kind(t, F.col("e")).alias("type"), _joined(schedule.days(t)).alias("days"), _spans(schedule.periods(t)).alias("periods"))


@query("incentives", rf"""SELECT doc_id, k, 'happy_hour' AS id, 'Happy Hour' AS title, type, CASE WHEN type = 'recurring' THEN nullif(days, '') END AS days, CASE WHEN type = 'recurring' THEN nullif(periods, '') END AS periods,
    CASE WHEN type = 'recurring' AND days || periods <> '' THEN 'America/Los_Angeles' END AS timezone, CASE WHEN type = 'date_range' THEN d[1] END AS start_date, CASE WHEN type = 'date_range' THEN coalesce(d[2], d[1]) END AS end_date
    FROM (SELECT *, regexp_extract_all(t, '\b(\d{{4}}-\d\d-\d\d)\b', 1) AS d FROM ({_SCHEDULES})) WHERE n % 3 <> 0""")
def incentives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested incentives, unpacked; records without an offer (here every third) have none."""
    category = F.when(F.col("n") % 3 == 0, "No Incentive").otherwise("Happy Hour")
    made = _timings(spark, sf_dir).select("doc_id", "k", F.explode(schedule.incentives(category, category, F.col("t"), F.col("t"), F.col("e"))).alias("i"))
    s = F.col("i.schedule")
    return made.select("doc_id", "k", "i.id", "i.title", "i.type", _joined(s["days"]).alias("days"), F.when(s["periods"].isNotNull(), _spans(s["periods"])).alias("periods"), s["timezone"].alias("timezone"), s["start_date"].alias("start_date"), s["end_date"].alias("end_date"))


# --- fields ----------------------------------------------------------------------------------------------------------


_DIGITS = r"\$\s*(\d+(?:\.\d{1,2})?)"


@query("values", rf"""SELECT doc_id, k, CASE WHEN regexp_matches(l, '\b(no (cover|charge)|complimentary|free (admission|entry))\b') THEN '$0 (free)'
    WHEN regexp_matches(l, '\bfree\b') AND NOT regexp_matches(l, '\bfree (wifi|shipping|parking)\b') THEN '$0 (free)' WHEN regexp_matches(l, '\bopen bar\b') THEN 'Open bar'
    WHEN regexp_matches(l, '\bhalf[ -]?(off|price)\b') THEN '50% off' WHEN regexp_matches(l, '\b(bogo|(2|two)[\s-]?for[\s-]?(1|one))\b') THEN '2 for 1'
    WHEN regexp_matches(l, '\d\s*%\s*off') THEN regexp_extract(l, '(\d+)\s*%\s*off', 1) || '% off' WHEN regexp_matches(l, '\d\s*%') THEN regexp_extract(l, '(\d+)\s*%', 1) || '%'
    WHEN contains(l, '$') AND regexp_matches(l, '\$\s*\d') THEN rtrim('$' || array_to_string(list_filter([regexp_extract(l, {_quoted(_DIGITS)}, 1), m], lambda x: x <> ''), ' ')) ELSE 'Unknown' END AS value,
    CASE WHEN regexp_matches(l, {_either(vocab.LIMITED)}) THEN 'Limited Time' ELSE 'Ongoing' END AS status, CASE WHEN regexp_matches(l, 'limited time|while supplies last|t(oday|onight) only|expires') THEN 'Limited Time' ELSE 'Ongoing' END AS llm_status
    FROM (SELECT *, regexp_extract(s, '(?i)\$\s*\d+(?:\.\d{{1,2}})?\s*(off|discount|cover|admission|tickets?|beers?|drinks?|cocktails?|shots?|wines?|specials?)?', 1) AS m FROM ({_S}))""")
def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s")
    return _said(spark, sf_dir).select("doc_id", "k", extract.value(s).alias("value"), extract.status(s).alias("status"), extract.llm_status(s).alias("llm_status"))


_MOTIVE = "CASE c WHEN 'Free' THEN 'Free' WHEN 'Early Entry' THEN 'FOMO' WHEN 'Live Music' THEN 'Social' WHEN 'Group Booking' THEN 'Social' ELSE 'Value' END"
_TIMED = r"c IN ('Happy Hour', 'Discount', 'Matinee Deal') AND regexp_matches(l, '\b((mon|tue|wed|thu|fri|sat|sun|daily|nightly|weekday|weekend)|\d{1,2}(:\d\d)?\s*(am|pm)|every\s+(monday|tuesday|wednesday|thursday|friday|saturday|sunday|week|night|day))\b')"
_HINT = "CASE " + " ".join(f"WHEN contains(l, {_quoted(k)}) THEN {_quoted(v)}" for k, v in sorted(vocab.HINTS.items(), key=lambda x: -len(x[0]))) + " END"
_QUALITY = rf"""CASE WHEN regexp_matches(l, {_either(vocab.NAVIGATION)}) OR regexp_matches(l, '\bopen(ing)?\b.{{0,40}}\b\d{{1,2}}(:\d{{2}})?\s*(am|pm)') THEN 0 WHEN len(w) > 4 AND len(list_distinct(w)) / len(w)::DOUBLE < 0.6 THEN 0.15
    ELSE greatest(0.05, least(1.0, 0.5::DOUBLE {" ".join(f"+ CASE WHEN regexp_matches(l, {_quoted(p)}) THEN {b}::DOUBLE ELSE 0 END" for p, b in vocab.QUALITY)} + CASE WHEN length(s) BETWEEN 40 AND 250 THEN 0.1 WHEN length(s) < 30 THEN -0.2 ELSE 0 END)) END"""


@query("enriched", rf"""SELECT doc_id, k, CASE WHEN regexp_matches(l, '\b(limited time|(tonight|today) only|last chance|selling fast|few left|exclusive event)\b') THEN 'FOMO' WHEN {_MOTIVE} = 'Value' AND {_TIMED} THEN 'FOMO' ELSE {_MOTIVE} END AS motivator,
    CASE WHEN regexp_matches(l, '\b(limited time|(tonight|today) only|last chance|selling fast)\b') THEN 'FOMO' WHEN {_MOTIVE} = 'Value' AND {_TIMED} THEN 'FOMO' ELSE {_MOTIVE} END AS llm_motivator,
    CASE WHEN c IN ('Happy Hour', 'Live Music') THEN c {" ".join(f"WHEN contains(l, {_quoted(k)}) THEN {_quoted(v)}" for k, v in vocab.CUISINES)} ELSE 'Restaurant' END AS cuisine,
    CASE WHEN c NOT IN ('No Incentive', 'Unknown') THEN 'Yes' WHEN regexp_matches(l, 'no reservations|walk-in only|counter service') THEN 'No' WHEN regexp_matches(l, {_either(vocab.GROUP_SIGNALS)}) THEN 'Likely' ELSE 'Unknown' END AS group_friendly,
    {_HINT} AS hint, round({_QUALITY}, 9) AS quality, trim(regexp_replace(lower(c), '[^a-z0-9]+', '_', 'g'), '_') AS slug, CASE WHEN length(s) > 70 THEN regexp_replace(left(s, 70), '^\s+|\s+$', '', 'g') || '...' ELSE s END AS short
    FROM (SELECT *, list_filter(regexp_split_to_array(l, '\s+'), lambda x: x <> '') AS w FROM ({_S}))""")
def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = F.col("s"), F.col("category")
    return _said(spark, sf_dir).select(
        "doc_id", "k", extract.motivator(c, s).alias("motivator"), extract.llm_motivator(c, s).alias("llm_motivator"), extract.cuisine(F.lit(None).cast("string"), s, c).alias("cuisine"), extract.group_friendly(s, c).alias("group_friendly"),
        text.category_hint(s).alias("hint"), F.round(text.quality(s), 9).alias("quality"), text.slug(c).alias("slug"), text.shorten(s).alias("short"))


_DOLLARS = "length(s) - length(replace(s, '$', ''))"


@query("text_gates", rf"""SELECT doc_id, k, regexp_matches(l, {_either(vocab.MEMBERSHIP)}) AS membership, regexp_matches(s, '(?i)\b\d{{1,2}}(:\d\d)?\s*[ap]m\b[^\n]*\b\d{{1,2}}(:\d\d)?\s*[ap]m\b') AS hours, contains(s, '$') OR contains(l, '% off') AS price,
    {_DOLLARS} >= 2 AND regexp_matches(l, '\b(gluten.?free|vegetarian|vegan|entree|appetizer|salad|soup|pasta|burger|sandwich|tacos?|pizza|sushi|steak|chicken|salmon|shrimp|fries|dessert|brunch menu|add.on|sides?|combo|platter)\b') AND NOT regexp_matches(l, {_either(vocab.DEALS)}) AS menu,
    {_DOLLARS} >= 2 AND regexp_matches(l, {_either(vocab.CHUNK_FOOD)}) AND NOT regexp_matches(l, {_either(vocab.CHUNK_DEALS)}) AS chunk_menu,
    regexp_matches(l, {_either(vocab.NOISE)}) OR (len(w) > 8 AND len(list_distinct(w)) / len(w)::DOUBLE < 0.35) AS noise,
    {_count("l", vocab.CHUNK_KEYWORDS)} + CASE WHEN regexp_matches(s, '\$\s?\d') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(s, '\d\s?%') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(l, '\b(mon|tue|wed|thu|fri|sat|sun|daily|weekly)\b') THEN 1 ELSE 0 END AS chunk_score,
    array_to_string(list_sort(list_filter([{", ".join(map(_quoted, vocab.CHUNK_KEYWORDS))}], lambda k: contains(l, k))), ',') AS hits, len(w) >= 20 AND len(list_filter(w, lambda x: regexp_full_match(x, '\p{{L}}'))) / len(w)::DOUBLE > 0.35 AS spaced,
    CASE WHEN length(s) > 36 THEN left(s, 36) || '…' ELSE s END AS cut FROM (SELECT *, list_filter(regexp_split_to_array(l, '\s+'), lambda x: x <> '') AS w FROM ({_S}))""")
def text_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filters and scores of blocks, chunks and teasers."""
    s = F.col("s")
    return _said(spark, sf_dir).select(
        "doc_id", "k", chunks.is_membership(s, F.lit(None).cast("string")).alias("membership"), chunks.has_hours(s).alias("hours"), chunks.has_price(s).alias("price"), text.is_menu_block(s).alias("menu"), chunks.is_chunk_menu(s).alias("chunk_menu"),
        chunks.is_noise(s).alias("noise"), chunks.chunk_score(s).alias("chunk_score"), _joined(chunks.keyword_hits(s)).alias("hits"), text.has_spaced_chars(s).alias("spaced"), chunks.truncated(s).alias("cut"))


@query("cleaned_texts", rf"""SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS collapsed, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', '', 'g'), '\s+', ' ', 'g'), '\b\w(?:\s\w){{4,}}\b', ' ', 'g'), ' {{2,}}', ' ', 'g'))) AS ascii FROM documents""")
def cleaned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(chunks.clean_text(t).cast("binary")).alias("collapsed"), F.md5(text.ascii_clean(t).cast("binary")).alias("ascii"))


_WORDS = "len(list_filter(regexp_split_to_array(teaser, '\\s+'), lambda x: x <> ''))"


@query("teasers", f"""SELECT doc_id, k, CASE WHEN {_WORDS} > 7 AND length(short) BETWEEN 1 AND length(teaser) - 1 AND (NOT (contains(teaser, '$') OR contains(lower(teaser), '% off')) OR contains(short, '$') OR contains(lower(short), '% off')) THEN short ELSE teaser END AS teaser,
    {_WORDS} > 7 AS asked FROM (SELECT doc_id, k, s AS teaser, left(s, 30) AS short FROM ({_S}))""")
def teasers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which teasers are sent to be shortened, and which answers are taken (the answer here: the first 30 characters)."""
    s = F.col("s")
    p = job.rewrite_prompt(s)
    return _said(spark, sf_dir).select("doc_id", "k", F.when(p.isNotNull(), job.rewritten(s, F.substring(s, 1, 30))).otherwise(s).alias("teaser"), p.isNotNull().alias("asked"))


@query("answers", """SELECT doc_id, k, CASE WHEN n % 4 = 0 OR c IN ('No Incentive', 'Unknown') THEN 'No Incentive' ELSE c END AS category, CASE WHEN n % 4 = 0 OR c IN ('No Incentive', 'Unknown') THEN 'No incentive found' ELSE 'from ' || doc_id END AS teaser,
    CASE WHEN n % 4 = 0 OR c IN ('No Incentive', 'Unknown') THEN 'no_result' ELSE 'llm' END AS source FROM (""" + _S + ")")
def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractors' answers as results: talk around the JSON, bad JSON, unknown categories."""
    raw = F.concat(F.lit("Sure: {"), F.when(F.col("n") % 4 == 0, F.lit('"category": ')).otherwise(F.concat(F.lit('"category": "'), F.col("category"), F.lit('", "teaser": " from '), F.col("doc_id").cast("string"), F.lit(' "'))), F.lit("} Done."))
    return _said(spark, sf_dir).select("doc_id", "k", job.result(raw).alias("r")).select("doc_id", "k", "r.category", "r.teaser", "r.source")


def _mentioned() -> str:
    """Mentions in SQL: all matches of all patterns with their places, then the next one that fits, again and again. RE2's word borders know ASCII letters alone, so
    others are matched as x."""
    one = lambda k, p: f"SELECT doc_id, k, {k} AS p, t, regexp_extract_all(x, {_quoted('(?i)' + p)}) AS h, regexp_split_to_array(x, {_quoted('(?i)' + p)}) AS s FROM b WHERE regexp_matches(x, {_quoted('(?i)' + p)})"
    size = lambda of: f"coalesce(list_sum(list_transform({of}, lambda y: length(y))), 0)"
    return rf"""WITH RECURSIVE b AS MATERIALIZED (SELECT doc_id, k, t, regexp_replace(t, '[À-ÖØ-öø-ſ]', 'x', 'g') AS x FROM (SELECT doc_id, k, s || ' ' || {_put(_listed(_TIMES, 'n'), 'n')} AS t FROM ({_S}))),
h AS ({" UNION ALL ".join(one(k, p) for k, p in enumerate(vocab.TIMES))}),
m AS (SELECT *, trim(substr(t, (a + 1)::BIGINT, (b - a)::BIGINT)) AS what FROM (SELECT *, a + length(h[i]) AS b FROM (SELECT *, {size("s[:i]")} + {size("h[:i - 1]")} AS a FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM h)))),
o AS MATERIALIZED (SELECT doc_id, k, a, b, what, row_number() OVER (PARTITION BY doc_id, k ORDER BY p, a) AS o FROM m WHERE what <> ''),
r AS (SELECT doc_id, k, 0::BIGINT AS o, []::VARCHAR[] AS said, []::STRUCT(a HUGEINT, b HUGEINT)[] AS spans FROM b
    UNION ALL SELECT doc_id, k, o.o, list_append(said, what), list_append(spans, {{'a': a::HUGEINT, 'b': b::HUGEINT}}) FROM r JOIN o USING (doc_id, k)
    WHERE len(said) < 6 AND o.o > r.o AND NOT list_contains(list_transform(said, lambda y: lower(y)), lower(what)) AND len(list_filter(spans, lambda y: (y.a <= o.a AND o.a < y.b) OR (y.a < o.b AND o.b <= y.b))) = 0
    QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY o.o) = 1)
SELECT doc_id, k, coalesce(nullif(array_to_string(said, ', '), ''), 'Unknown') AS timing FROM r QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY len(said) DESC) = 1"""


@query("timings", _mentioned())
def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of days and times of every sentence between an offer and a timing, found by match positions."""
    n = F.col("n")
    return _said(spark, sf_dir).select("doc_id", "k", extract.timing(F.concat_ws(" ", "s", _filled(_picked(_TIMES, n), n))).alias("timing"))


def _job(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    venues = d.select(F.col("doc_id").alias("row_idx"), F.col("doc_id").cast("string").alias("venue_id"), F.col("source").alias("venue_name"), F.lit("pub").alias("Business Type"), F.concat(F.lit("http://a.example/"), "doc_id").alias("Source URL"))
    texts = _offers(spark, sf_dir).select(F.col("doc_id").alias("row_idx"), F.concat_ws("\n", "s", "text").alias("text"), F.lit("direct").alias("scrape_source"))
    return job.run(venues, texts, KeywordClient)


@query("job_records")
def job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main job, its extractor answering by the category hints."""
    return _job(spark, sf_dir).select("venue_id", "row", "Incentive Category", "Incentive Teaser", "Group Friendly?", "Psychological Motivator Type", F.size("incentives").alias("n_incentives"), "_meta.extraction_source", "_meta.text_chars")


@query("job_metrics")
def job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.metrics(_job(spark, sf_dir))


@query("relabelled_counts")
def relabelled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.relabel_counts(job.relabelled(_job(spark, sf_dir), partial(KeywordClient, "")))


@query("cascade")
def cascaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confidence cascade over predictions whose confidence the id gives."""
    s = _offers(spark, sf_dir).withColumn("text", F.concat(F.col("s"), F.lit(".\n"), F.col("text"), F.lit(".\nLive band and no cover every Friday from 8pm, doors open early")))
    one = lambda x, k: F.struct(x.alias("sentence"), F.col("category").alias("label"), F.lit("Value").alias("motivator"), F.lit("Dining").alias("cuisine"), ((F.col("doc_id") * 7 + k) % 100 / 100.0).alias("confidence"))
    d = s.withColumn("predictions", F.transform(text.candidates(F.col("text")), one)).withColumn("business_type", F.element_at(F.array(F.lit("Nightclub"), F.lit("Live Music Venue"), F.lit("bar")), (F.col("doc_id") % 3 + 1).cast("int")))
    return cascade.run(d.select("doc_id", "text", "business_type", "predictions"), partial(KeywordClient, "")).select("doc_id", "result.category", "result.description", "result.value", "result.timing", "result.source", F.round("result.model_confidence", 4).alias("confidence"))
