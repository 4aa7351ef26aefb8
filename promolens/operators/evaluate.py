"""Whole comparisons: gold records against a run's, accuracy summaries, disagreements, drop reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import chunks, extract, vocab
from promolens.operators.compare import flag, last_by


def _name(field: str) -> Column:
    return F.col(f"`{field}`")


def matched(gold: DataFrame, records: DataFrame, key: str = "venue_id", order: str = "row_idx") -> DataFrame:
    """(key, g, m): the last gold row of each key and the last record of it."""
    pack = lambda df, as_: last_by(df, key, order).select(key, F.struct(*[_name(c) for c in df.columns if c not in (key, order)]).alias(as_))
    return pack(gold, "g").join(pack(records, "m"), key)


def field_flags(pairs: DataFrame, fields: list[str] = vocab.COMPARED, key: str = "venue_id") -> DataFrame:
    """(key, field, gold, model, flag): a row for each compared field."""
    one = lambda f: F.struct(F.lit(f).alias("field"), F.col("g")[f].cast("string").alias("gold"), F.col("m")[f].cast("string").alias("model"))
    return pairs.select(key, F.explode(F.array(*[one(f) for f in fields])).alias("f")).select(key, "f.*", flag(F.col("f.gold"), F.col("f.model")).alias("flag"))


def categories(pairs: DataFrame, key: str = "venue_id", field: str = "Incentive Category") -> DataFrame:
    """(key, gold, model, broad_gold, broad_model, exact, broad, chars): a row for each pair."""
    g, m = F.col("g")[field], F.col("m")[field]
    bg, bm = extract.broad_category(g, compared=True), extract.broad_category(m, compared=True)
    exact = chunks.same_category(g, m)
    return pairs.select(key, g.alias("gold"), m.alias("model"), bg.alias("broad_gold"), bm.alias("broad_model"), exact.alias("exact"), F.coalesce(bg == bm, F.lit(False)).alias("broad"), F.coalesce(F.col("m")["text_chars"], F.lit(0)).alias("chars"))


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def summary(flags: DataFrame, cats: DataFrame) -> DataFrame:
    """One row: agreeing and counted fields, exact and broad matches, over all pairs and over those with text."""
    f = flags.agg(F.count_if(F.col("flag") == "✓").alias("agree"), F.count_if(F.col("flag") != "~").alias("counted"))
    text = F.col("chars") > 0
    c = cats.agg(F.count(F.lit(1)).alias("n"), F.count_if("exact").alias("exact"), F.count_if("broad").alias("broad"), F.count_if(text).alias("scraped"), F.count_if(text & F.col("exact")).alias("scraped_exact"), F.count_if(text & F.col("broad")).alias("scraped_broad"))
    both = f.crossJoin(c)  # one row each
    return both.select(
        "*", _percent(F.col("agree"), F.col("counted")).alias("field_pct"), *[_percent(F.col(k), F.col("n")).alias(f"{k}_pct") for k in ("exact", "broad")],
        *[_percent(F.col(f"scraped_{k}"), F.col("scraped")).alias(f"scraped_{k}_pct") for k in ("exact", "broad")])


def accuracy(rows: DataFrame, predicted: str, truth: str, times: list[str] = ()) -> DataFrame:
    """One row: rows, matches, their share (0 without rows), average times."""
    hit = chunks.same_category(F.col(predicted), F.col(truth))
    avg = [F.coalesce(F.avg(t), F.lit(0.0)).alias(f"avg_{t}") for t in times]
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("matches"), F.coalesce(F.avg(hit.cast("double")), F.lit(0.0)).alias("accuracy"), *avg)


def agreement_percent(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rows, agreeing ones, and their share in whole percent (null without rows)."""
    same = F.count_if(F.col(a).eqNullSafe(F.col(b)))
    return rows.agg(F.count(F.lit(1)).alias("n"), same.alias("agree"), F.floor(F.try_divide(same * F.lit(100), F.count(F.lit(1)))).cast("long").alias("percent"))


def disagreements(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) where they differ, the most frequent first."""
    return rows.where(~F.col(a).eqNullSafe(F.col(b))).groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), a, b)


def gold_reasons(rows: DataFrame, required: list[str] = vocab.GOLD_FIELDS, url: str = "Source URL", order: str = "row_idx") -> DataFrame:
    """rows with ``reason``: missing_required, bad_url, duplicate_url (not the first of its url), or null for those that stay."""
    blank = reduce(lambda x, y: x | y, [F.coalesce(F.trim(_name(c)), F.lit("")) == "" for c in required])
    u = F.trim(_name(url))
    d = rows.withColumn("__reason", F.when(blank, "missing_required").when(~u.startswith("http") | u.rlike(r"(?U)\s"), "bad_url"))
    first = d.where("__reason IS NULL").groupBy(u.alias("__u")).agg(F.min(order).alias("__first"))
    d = d.withColumn("__u", F.when(F.col("__reason").isNull(), u)).join(first, "__u", "left")
    return d.select(*rows.columns, F.coalesce("__reason", F.when(F.col(order) != F.col("__first"), "duplicate_url")).alias("reason"))


def drop_counts(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
