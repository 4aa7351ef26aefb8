"""SpotSigs fingerprints, in SQL functions only.

A signature is a common word (the anchor) with the two content words that follow it; a document's fingerprint is the
set of its signatures' 32-bit hashes, as ascending 8-digit hex. Navigation and lists have few common words, running text
has many, so the fingerprint follows the text. ``near_pairs`` compares fingerprints: they are partitioned by set length, so
that two sets meet only if their lengths allow the wanted Jaccard likeness, candidates share one of their rarest
signatures (a prefix that two such sets cannot both miss), and likeness is computed for candidates alone.

The query needs each document's successor by id. Ids are cut into ranges of about ROWS documents, by counts alone; in each range a window
orders the documents, and the first document of each range visits the range before it as a guest, so that no range needs
to know another and no sort gathers all rows.

Defined results: a null text is the empty one; the empty text has the empty fingerprint, like itself (1.0) and unlike all others
(0.0); a text without signatures is fingerprinted by its words as a whole, or if it has none by itself. A null id comes before
all others; of rows with equal ids that with the smaller text comes first; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.llm.common import let, table, written

#: Common words of English, French, German and Spanish, the anchors.
COMMON = """
a an and are as at be by for from had has have he in is it its not of on or that the they this to was were which will with
au aux ce ces dans des du elle en est et il la le les leur mais ne nous par pas plus pour que qui sa se ses son sur un une vous
aber als am auch auf aus bei das dass dem den der des die ein eine einem einen er es für hat ich im ist mit nach nicht sich sie so und von vor war wie zu zum
al como con de del el ella ellos era está fue ha hay las lo los más muy no o para pero por porque sin sobre su sus también una y ya
""".split()
#: Documents in a range of ids, and ranges, at most.
ROWS, RANGES = 512, 1 << 16
NEAR = 0.8


def signatures(text: Column) -> Column:
    """The ascending distinct signature hashes of a text, array<bigint>."""
    common = sorted(set(COMMON))
    text = F.coalesce(text, F.lit(""))
    split = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def parts(w):
        spots = F.filter(F.transform(w, lambda x, i: F.when(x.isin(common), i).otherwise(F.lit(-1))), lambda i: i >= 0)
        return F.struct(w.alias("w"), spots.alias("p"), F.filter(w, lambda x: ~x.isin(common)).alias("c"))

    def chains(s):
        # of the words before the j-th anchor, which stands at p, j are anchors; content word p - j is the next
        w, p, c = s["w"], s["p"], s["c"]
        one = lambda at, j: F.when(at - j + 2 <= F.size(c), F.xxhash64(F.get(w, at), F.get(c, at - j), F.get(c, at - j + 1)).bitwiseAND(0xFFFFFFFF))
        found = F.array_sort(F.array_distinct(F.array_compact(F.transform(p, one))))
        return F.struct(found.alias("found"), F.array_join(w, " ").alias("all"))

    def settled(s):
        whole = F.xxhash64(F.when(s["all"] != "", s["all"]).otherwise(text)).bitwiseAND(0xFFFFFFFF)
        return F.when((F.size(s["found"]) > 0) | (text == ""), s["found"]).otherwise(F.array(whole))

    return let(let(let(split, parts), chains), settled)


def fingerprint(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def _ranged(ids: list[int]) -> tuple:
    """Expressions for a __id's range (from 0) and that range's first id, by two looks at ascending lists."""
    g = max(1, math.isqrt(len(ids)))
    groups = [ids[k : k + g] for k in range(0, len(ids), g)]
    longs = lambda c: F.split(c, ",").cast("array<bigint>")
    held = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("__id")))
    group = F.greatest(held(longs(F.lit(",".join(str(x[0]) for x in groups)))), F.lit(1))
    bounds = longs(F.element_at(F.split(F.lit(";".join(",".join(map(str, x)) for x in groups)), ";"), F.col("__group")))
    return group, (F.col("__group") - 1) * g + F.greatest(held(F.col("__bounds")), F.lit(1)) - 1, F.element_at("__bounds", F.greatest(held(F.col("__bounds")), F.lit(1))), bounds


def with_range(d: DataFrame, ids: list[int]) -> DataFrame:
    group, at, first, bounds = _ranged(ids)
    return d.withColumn("__group", group).withColumn("__bounds", bounds).withColumn("__range", at).withColumn("__first", first).drop("__group", "__bounds")


def range_firsts(ids: DataFrame, rows: int = ROWS, ranges: int = RANGES) -> list[int]:
    """The first id of each range, ascending: ranges of at most about 2 * rows rows (more where there would be over
    ``ranges`` of them, or where one id has more). Each look counts the rows of a range where they are, and the driver gets a
    row for each range; ranges with too many rows are cut evenly between their least and greatest id until none is left."""
    firsts: list[int] | None = None
    while True:
        d = ids.withColumn("__range", F.lit(0)) if firsts is None else with_range(ids, firsts)
        got = d.groupBy("__range").agg(F.min("__id").alias("least"), F.max("__id").alias("most"), F.count(F.lit(1)).alias("n")).collect()
        if not got:
            return [0]
        rows = max(rows, -(-sum(r.n for r in got) // ranges))
        cuts, held, more = [], rows + 1, False
        for r in sorted(got, key=lambda r: r.least):
            parts = min(-(-r.n // rows), r.most - r.least + 1) if r.n > 2 * rows else 1
            if parts > 1:
                cuts += [r.least + (r.most - r.least + 1) * k // parts for k in range(parts)]
                held, more = rows + 1, True
            elif held + r.n > rows:
                cuts.append(r.least)
                held = r.n
            else:
                held += r.n
        if not more:
            return cuts
        firsts = cuts


def with_next(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """(doc_id, text, __sigs, __next, __next_sigs): each document with its successor by id, the last with the first."""
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("__id", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("long"))
    firsts = range_firsts(d.select("__id"), rows)
    d = with_range(d, firsts)
    before = F.when(F.col("__range") == 0, F.lit(len(firsts) - 1)).otherwise(F.col("__range") - 1)
    own = F.struct(F.col("__range").cast("long").alias("r"), F.lit(False).alias("guest"))
    guest = F.struct(before.cast("long").alias("r"), F.lit(True).alias("guest"))
    d = d.withColumn("__at", F.explode(F.when(F.col("__id") == F.col("__first"), F.array(own, guest)).otherwise(F.array(own))))
    d = d.select("doc_id", "text", "__id", F.col("__at.r").alias("__r"), F.col("__at.guest").alias("__guest")).repartition("__r")
    d = d.withColumn("__sigs", signatures(F.col("text")))
    w = W.partitionBy("__r").orderBy("__guest", "__id", "text")
    d = d.withColumn("__next", F.lead("text").over(w)).withColumn("__next_sigs", F.lead("__sigs").over(w))
    return d.where(~F.col("__guest")).select("doc_id", "text", "__sigs", "__next", "__next_sigs")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.length("text")
    k = F.floor(n / 4).cast("int")
    d = d.withColumn("__edited", F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("__next"), F.lit(1), k)))
    d = d.withColumn("__edited_sigs", signatures(F.col("__edited")))
    return d.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("__sigs")).alias("fingerprint"), fingerprint(F.col("__edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("__sigs"), F.col("__edited_sigs")).alias("near_edited"), likeness(F.col("__sigs"), F.col("__next_sigs")).alias("near_next"),
    )


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, sigs) of the documents with an id."""
    return docs.where("doc_id IS NOT NULL").select("doc_id", signatures(F.col("text")).alias("sigs"))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): documents of one class have equal fingerprints; the class is its smallest id."""
    return _classes(_signed(docs))


def _classes(signed: DataFrame) -> DataFrame:
    d = signed.select("doc_id", F.md5(fingerprint(F.col("sigs")).cast("binary")).alias("__print"))
    first = d.groupBy("__print").agg(F.min("doc_id").alias("class_id"))
    return d.join(first, "__print").select("doc_id", "class_id")


def _sets(signed: DataFrame) -> DataFrame:
    """(id, sigs, n): the distinct fingerprints with signatures, each with its smallest document."""
    return signed.where(F.size("sigs") > 0).groupBy("sigs").agg(F.min("doc_id").alias("id")).select("id", "sigs", F.size("sigs").alias("n"))


def near_pairs(docs: DataFrame, near: float = NEAR) -> DataFrame:
    """(a, b, likeness) for the representatives (smallest ids) of distinct fingerprints whose likeness is at least ``near``."""
    return _near(written(_sets(_signed(docs)), "sets"), near)


def _near(sets: DataFrame, near: float) -> DataFrame:
    rare = sets.select("id", F.explode("sigs").alias("sig"))
    rare = rare.join(rare.groupBy("sig").agg(F.count(F.lit(1)).alias("df")), "sig")
    ordered = rare.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "sig"))), lambda x: x["sig"]).alias("o"))
    least = F.ceil(F.col("n") * F.lit(near) - 1e-9).cast("int")
    start = sets.join(ordered, "id").withColumn("part", F.floor(F.log(F.col("n").cast("double")) / math.log(1 / near)).cast("int"))
    start = written(start.select("id", "n", "part", F.explode(F.slice("o", F.lit(1), F.col("n") - least + 1)).alias("sig")), "prefixes")
    probe = start.select(F.col("id").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("part", F.col("part") - 1)).alias("part"))
    own = start.select(F.col("id").alias("b"), F.col("n").alias("nb"), "sig", "part")
    # the longer set probes its own length partition and the one below; equal lengths once
    hit = probe.join(own, ["part", "sig"]).where((F.col("nb") >= F.col("na") * F.lit(near) - 1e-9) & ((F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))).select("a", "b").distinct()
    hit = hit.join(sets.select(F.col("id").alias("a"), F.col("sigs").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("sigs").alias("sb")), "b")
    return hit.withColumn("likeness", likeness(F.col("sa"), F.col("sb"))).where(F.col("likeness") >= near - 1e-12).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")


def near_classes(docs: DataFrame, near: float = NEAR) -> DataFrame:
    """(doc_id, class_id, n_links, best_class, best_likeness) of every document with an id: its class of equal fingerprints, how many other classes are near,
    and the most alike of them (ties to the smaller id; null if none is near). Documents of equal fingerprints are no links, and pairs of classes are not returned."""
    signed = written(_signed(docs), "signed")  # signatures are the costly part
    p = written(_near(written(_sets(signed), "sets"), near), "near")
    both = p.select(F.col("a").alias("class_id"), F.col("b").alias("other"), "likeness").unionByName(p.select(F.col("b").alias("class_id"), F.col("a").alias("other"), "likeness"))
    links = both.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"), F.min(F.struct((-F.col("likeness")).alias("d"), "other")).alias("x"))
    links = links.select("class_id", "n_links", F.col("x.other").alias("best_class"), (-F.col("x.d")).alias("best_likeness"))
    return _classes(signed).join(links, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "best_class", "best_likeness")


def classes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near fingerprints of all documents by the length-partitioned, pruned join."""
    return near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES, ORACLES = {"op8_spotsigs": query, "spotsigs_classes": classes_query}, {}
