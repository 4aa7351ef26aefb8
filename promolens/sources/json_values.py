"""Objects of JSON files, each one array, one object or concatenated values: any file is read in many tasks.

Spark's text reader deals a file out by byte ranges, a line's end being a closing brace, so that it works on any store. A task knows neither whether its
range begins in a string nor how deep: a first pass sums each range up (``Summary``: for either beginning, which brackets it closes and leaves
open, and whether it ends in a string), the sums are composed in order, a few bytes for each range, and the second pass cuts each range at the
borders of its objects. Only what a range's first and last border leave over is shuffled, to be put together with its neighbours.

What counts as an object stands at the top or in an array at the top. As a reader would that decodes value after value, what follows a file's first bad value is
left out, and an array that is not whole gives nothing; other files are not touched. Byte-order marks are dropped; scalars and deeper arrays are skipped.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.sources.positions import FEW, kept, offsets

STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
MARK = re.compile(r'["\[\]{}]')
PAIR = {"}": "{", "]": "["}


def scan(text: str, in_string: bool) -> Iterator[tuple[int, str]]:
    """The brackets outside strings with their places; at last (-1, '"') if the text ends in a string."""
    at = 0
    while True:
        if in_string:
            m = STRING.match(text, at)
            if m is None:
                yield -1, '"'
                return
            at, in_string = m.end(), False
        m = MARK.search(text, at)
        if m is None:
            return
        at = m.end()
        if m.group() == '"':
            in_string = True
        else:
            yield m.start(), m.group()


def summary(text: str, in_string: bool) -> tuple[str, str, bool]:
    """(closing brackets that something before opens, brackets left open, whether it ends in a string)."""
    closes, opens, ends = [], [], False
    for at, c in scan(text, in_string):
        if at < 0:
            ends = True
        elif c in "[{":
            opens.append(c)
        elif opens:
            opens.pop()
        else:
            closes.append(c)
    return "".join(closes), "".join(opens), ends


def after(stack: str, in_string: bool, one: tuple[str, str, bool], other: tuple[str, str, bool]) -> tuple[str, bool]:
    """The open brackets behind a range, and whether it ends in a string; one and other: its sums if it begins outside and in a string."""
    closes, opens, ends = other if in_string else one
    return stack[: max(0, len(stack) - len(closes))] + opens, ends


def cut(text: str, stack: str, in_string: bool) -> Iterator[tuple[str, str, str]]:
    """(kind, text, stack before): the parts between the borders, objects (o) and what stands between them (g) by turns."""
    own, base, start, before = list(stack), lambda s: s in ([], ["["]), 0, stack
    inside = len(own) > 0 and (own[0] == "{" or own[1:2] == ["{"])
    for at, c in scan(text, in_string):
        if at < 0:
            break
        if c in "[{":
            if c == "{" and not inside and base(own):
                yield "g", text[start:at], before
                start, before, inside = at, "".join(own), True
            own.append(c)
        else:
            if own:
                own.pop()
            if inside and c == "}" and base(own):
                yield "o", text[start : at + 1], before
                start, before, inside = at + 1, "".join(own), False
    yield "o" if inside else "g", text[start:], before


def problem(text: str) -> str | None:
    """What is wrong with a text that should be one object."""
    try:
        return None if isinstance(json.loads(text), dict) else "no object"
    except ValueError as e:
        return str(e)


def gap_fault(text: str, in_array: bool, opens: bool) -> int:
    """What is wrong with the text between two objects: 0 nothing, 1 what stands behind an array's end or at the top, 2 the array that it begins in.

    in_array: whether the object before stands in an array; opens: whether the one behind does, so that the array's end is still to come."""
    text = ("[0" if in_array else "") + text + ("0]" if opens else "")
    decode, at, first = json.JSONDecoder().raw_decode, 0, True
    while True:
        while at < len(text) and text[at].isspace():
            at += 1
        if at == len(text):
            return 0
        try:
            _, at = decode(text, at)
        except ValueError:
            return 2 if in_array and first else 1
        first = False


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, str]]:
    """Each range's keys (of its first row) and text; a task's rows come range by range, in order. Bytes that are no UTF-8 are replaced."""
    keys, parts = None, []

    def whole() -> str:
        text = "".join(parts)[: -1 if keys["open"] else None]  # the file's last part had no brace
        return text.removeprefix("\ufeff") if keys["block"] == 0 else text

    for b in batches:
        names = [x for x in b.schema.names if x != "value"]
        for value, *row in zip(b.column("value").to_pylist(), *[b.column(x).to_pylist() for x in names], strict=True):
            r = dict(zip(names, row, strict=True))
            if keys is not None and (keys["path"], keys["block"]) != (r["path"], r["block"]):
                yield keys, whole()
                keys, parts = None, []
            keys = keys or r
            parts.append(value.decode("utf-8", "replace") + "}")
    if keys is not None:
        yield keys, whole()


def objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, row_idx, value): the objects' texts, with their position over all files in the order of their paths."""
    return read(spark, path)[0]


def read(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """objects(), and the faults (path, block, reason): for each file with one its first, the byte range that it begins in and what is wrong."""
    m = F.col("_metadata")
    t = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    t = t.select(m["file_path"].alias("path"), m["file_block_start"].alias("block"), m["file_size"].alias("size"), F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("value"))
    # a file's last part may or may not have had its brace: the file's size tells
    n = kept(t.groupBy("path", "block").agg(F.sum(F.octet_length("value") + 1).alias("n"), F.first("size").alias("size")), "json-ranges")
    few = n.count() <= FEW
    small = lambda df: F.broadcast(df) if few else df  # noqa: E731  a few rows for each range
    ends = n.groupBy("path").agg(F.sum("n").alias("n"), F.max("block").alias("last"), F.first("size").alias("size")).where(F.col("n") > F.col("size")).select("path", "last")
    open_ = n.join(ends, "path", "left").select("path", "block", (F.col("block").eqNullSafe(F.col("last"))).alias("open"))

    def with_(states: DataFrame) -> DataFrame:
        """The rows with what is known of their range, range by range, as they were read."""
        d = t.drop("size").join(small(states), ["path", "block"])
        return (d if few else d.repartition("path", "block").sortWithinPartitions("path", "block", "id")).drop("id")

    def summed(batches):
        for keys, text in _ranges(batches):
            a, b = summary(text, False), summary(text, True)
            yield pa.RecordBatch.from_pydict({"path": [keys["path"]], "block": [keys["block"]], "c0": [a[0]], "o0": [a[1]], "e0": [a[2]], "c1": [b[0]], "o1": [b[1]], "e1": [b[2]]})

    sums = with_(open_).mapInArrow(summed, "path string, block long, c0 string, o0 string, e0 boolean, c1 string, o1 string, e1 boolean")

    def composed(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        stack, in_string, out = "", False, []
        for r in rows:
            out.append((r["path"], r["block"], stack, in_string))
            stack, in_string = after(stack, in_string, (r["c0"], r["o0"], r["e0"]), (r["c1"], r["o1"], r["e1"]))
        return pa.table(dict(zip(("path", "block", "stack", "in_string"), map(list, zip(*out, strict=True)), strict=True)))

    begin = kept(sums.groupBy("path").applyInArrow(composed, "path string, block long, stack string, in_string boolean"), "json-states")

    def parts(batches):
        for keys, text in _ranges(batches):
            found = list(cut(text, keys["stack"], keys["in_string"]))
            k = len(found)
            yield pa.RecordBatch.from_pydict({"path": [keys["path"]] * k, "block": [keys["block"]] * k, "seg": list(range(k)), "segs": [k] * k, "kind": [x[0] for x in found], "text": [x[1] for x in found], "stack": [x[2] for x in found]})

    p = with_(begin.join(open_, ["path", "block"])).mapInArrow(parts, "path string, block long, seg long, segs long, kind string, text string, stack string")
    p = kept(p, "json-parts")
    # a range's first part goes on with the part that the nearest range before with a border ends in
    ranges = p.where("seg = 0").select("path", "block", "segs")
    bearing = F.when((F.col("segs") > 1) | (F.col("block") == 0), F.struct("block", (F.col("segs") - 1).alias("seg")))
    earlier = F.last(bearing, ignorenulls=True).over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    from_ = ranges.select("path", "block", earlier.alias("from"))  # a row for each range of a file
    edge = (F.col("seg") == 0) | (F.col("seg") == F.col("segs") - 1)
    at = F.when((F.col("seg") == 0) & F.col("from").isNotNull(), F.col("from")).otherwise(F.struct("block", "seg"))
    loose = p.where(edge).join(small(from_), ["path", "block"], "left").select("path", at.alias("at"), F.struct("block", "seg", "kind", "stack", "text").alias("x"))
    loose = loose.groupBy("path", "at").agg(F.sort_array(F.collect_list("x")).alias("x"))  # one object or gap, however many ranges it covers
    loose = loose.select("path", "at", F.col("x")[0]["kind"].alias("kind"), F.col("x")[0]["stack"].alias("stack"), F.array_join(F.col("x")["text"], "").alias("text"))
    whole = p.where(~edge).select("path", F.struct("block", "seg").alias("at"), "kind", "stack", "text").unionByName(loose)

    def judged(batches):
        for b in batches:
            kinds, texts, stacks = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("kind", "text", "stack"))
            fault, begins, why = [], [], []
            for kind, text, stack in zip(kinds, texts, stacks, strict=True):
                if kind == "o":
                    why.append(problem(text))
                    fault.append(0 if why[-1] is None else 2 if stack else 1)
                    begins.append(False)
                else:
                    closes, opens, _ = summary(text, False)
                    in_array = stack[: max(0, len(stack) - len(closes))] + opens == "["
                    fault.append(gap_fault(text, bool(stack), in_array))
                    begins.append(in_array and len(closes) >= len(stack))
                    why.append(("array without end or with something else in it" if fault[-1] == 2 else f"no JSON between values: {text.strip()[:60]}") if fault[-1] else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fault, pa.int32()), pa.array(begins, pa.bool_()), pa.array(why, pa.string())], [*b.schema.names, "fault", "begins", "why"])

    schema = "path string, at struct<block:bigint,seg:bigint>, kind string, stack string, text string, fault int, begins boolean, why string"
    j = kept(whole.select("path", "at", "kind", "stack", "text").mapInArrow(judged, schema), "json-judged")
    # the first fault ends its file; if it is in an array, from where that array begins
    bad = j.where("fault > 0").groupBy("path").agg(F.min(F.struct("at", "fault", "why")).alias("b")).select("path", F.col("b.at").alias("bad"), F.col("b.fault").alias("how"), F.col("b.why").alias("reason"))
    begins = j.where("begins").join(F.broadcast(bad) if bad.count() <= FEW else bad, "path").where("how = 2 AND at <= bad").groupBy("path").agg(F.max("at").alias("array"))
    limit = bad.join(begins, "path", "left").select("path", F.when(F.col("how") == 2, F.coalesce("array", F.struct(F.lit(-1).cast("long").alias("block"), F.lit(-1).cast("long").alias("seg")))).otherwise(F.col("bad")).alias("limit"))
    good = j.where("kind = 'o' AND fault = 0").join(limit, "path", "left").where("limit IS NULL OR at < limit").select("path", "at.block", "at.seg", "text")
    n = good.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))
    first = offsets(n, ["path", "block"])
    rank = F.row_number().over(W.partitionBy("path", "block").orderBy("seg")) - 1  # a range's objects
    good = good.withColumn("k", rank).join(first, ["path", "block"]).select("path", (F.col("offset") + F.col("k")).alias("row_idx"), F.col("text").alias("value"))
    return good, bad.select("path", F.col("bad.block").alias("block"), "reason")
