"""Structured data in column expressions against a walk in plain Python."""

import json
import random

import pyarrow as pa
from pyspark.sql import functions as F

from promolens.functions import structured
from promolens.sources import html

WORDS = ["", "Bar", "The old river place", "Happy hour", "Lunch menu of the day", "5", "10:00"]


def block(r, depth=0):
    b = {k: r.choice([*WORDS, 7, None]) for k in ("name", "description", "startDate") if r.random() < 0.6}
    some = {
        "@type": ["Event", "MusicEvent", "Bar", ["A", "B"], None], "openingHours": ["Mo-Fr", ["Mo", "Tu 3"], [], "", None], "hasMenu": ["url", {"name": "Lunch"}, {}, {"description": "d"}],
        "openingHoursSpecification": [{"dayOfWeek": "Friday", "opens": "10:00"}, [{"dayOfWeek": ["Mon", "Tue"], "opens": "9:00", "closes": "17:00"}, {"opens": "1"}, {"dayOfWeek": "", "opens": "2"}, 5], "x"],
    }
    b |= {k: r.choice(v) for k, v in some.items() if r.random() < 0.4}
    for k in ("makesOffer", "hasOfferCatalog", "offers"):
        if r.random() < 0.3:
            b[k] = r.choice([[{"name": r.choice(WORDS), "description": r.choice(WORDS), "price": r.choice(["5", 3, 4.25, None, "", 0, "0"])} for _ in range(r.randint(0, 8))], {"name": "one offer"}, "x"])
    for k in ("subOrganization", "department"):
        if depth < structured.LEVELS and r.random() < 0.3:
            b[k] = r.choice([block(r, depth + 1), [block(r, depth + 1), 3, block(r, depth + 1)], "x"])
    return b


def test_blocks_and_texts(spark):
    r, rows = random.Random(4), [(-1, None), (-2, [None, ""]), (-3, ['{"name": "twice here", "name": "or more"}'])]
    for k in range(500):
        scripts = [json.dumps(r.choice([block(r), [block(r), "s", block(r)], {"@graph": [block(r), block(r), 1]}, {"@graph": "x", "name": "Not a graph"}, 5, "str"])) for _ in range(r.randint(0, 3))]
        rows.append((k, [s if r.random() < 0.9 else s[:-1] for s in scripts]))
    d = spark.createDataFrame(rows, "k int, s array<string>").repartition(3).withColumn("b", F.explode(F.array(F.struct(structured.blocks(F.col("s")).alias("b"))))).withColumn("b", F.col("b.b"))
    got = {x.k: (x.said, x.kinds) for x in d.select("k", structured.texts(F.col("b")).alias("said"), F.transform("b", lambda b: structured.kind(b)).alias("kinds")).collect()}
    for k, scripts in rows:
        blocks = [] if k < 0 else html.ld_blocks(scripts)
        kinds = [t if isinstance(t := b.get("@type", "?"), str) else json.dumps(t, separators=(",", ":")) for b in blocks]
        assert got[k] == (html.ld_texts(blocks), kinds), scripts


def test_no_python_worker(spark):
    d = spark.createDataFrame([(["{}"],)], "s array<string>").select(structured.texts(structured.blocks(F.col("s"))))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and d.first()[0] == []


def test_state_texts(spark):
    """Rows with depth and path, equal to a walk by hand; bad and null JSON give none."""
    r = random.Random(3)

    def value(depth=0):
        kind = r.random()
        if depth > 10 or kind < 0.35:
            return r.choice(["a text that is long enough " + str(r.random()), "short", "http://a/" + "x" * 30, "  padded text of more than twenty  ", 5, None, "x" * 1001])
        return {f"k{i}": value(depth + 1) for i in range(r.choice([0, 1, 1, 2]))} if kind < 0.7 else [value(depth + 1) for _ in range(r.randint(0, 2))]

    def walk(v, depth=0, path="$"):
        if depth > 8:
            return []
        if isinstance(v, str):
            t = v.strip()
            return [(depth, path, t)] if 20 <= len(t) <= 1000 and not t.startswith(("http", "/", "{", "<")) else []
        if isinstance(v, list):
            return [x for i, y in enumerate(v) if i < 50 for x in walk(y, depth + 1, f"{path}[{i}]")]
        return [x for k, y in v.items() for x in walk(y, depth + 1, f"{path}.{k}")] if isinstance(v, dict) else []

    deep = "text at the bottom of all"
    for _ in range(8):
        deep = {"d": deep}
    values = [value() for _ in range(200)] + [[f"item number {i} of a long list" for i in range(70)], deep, {"e": deep}]
    rows = [(k, json.dumps({"props": {"pageProps": v}})) for k, v in enumerate(values)] + [(-1, None), (-2, "{"), (-3, "[]"), (-4, "")]
    d = spark.createDataFrame(rows, "k int, raw string").repartition(3)
    got = sorted((x.k, x.ord, x.depth, x.path, x.text) for x in html.state_texts(d, "raw", "props.pageProps").collect())
    want = [(k, i, *t) for k, v in enumerate(values) for i, t in enumerate(walk(v))]
    assert got == want and max(x[2] for x in want) == 8
    assert html.state_texts(d.where("k = 0"), F.col("raw")).count() == len([t for t in walk(json.loads(rows[0][1]))])


def test_page_state_texts(spark, monkeypatch):
    """As by a page's whole tree, wherever its script stands, and the markup is not handed on; batches are small."""
    state = json.dumps({"props": {"pageProps": ["the first text of this page", {"k": "the second text of this page"}, "short"]}})
    script = f'<script id="__NEXT_DATA__">{state}</script>'
    pages = [
        script, f"<p>before<b>{script}", f'<!-- {script} --><p>a</p>{script.replace("first", "third")}', script[:-9], script[:60], f'<script id="__NEXT_DATA__"/>{script}', f"<script>x</script>{script}<p>{script.replace('first', 'third')}",
        f'<div id="__NEXT_DATA__">{state}</div>', f"<SCRIPT type=a ID=__NEXT_DATA__>{state}</SCRIPT >", f'<script id="&#95;_NEXT_DATA__">{state}</script>', f"<textarea>{script}</textarea>", f"</script>{script}</p>", f'<script id="__NEXT_DATA__"></script>{script}', "", None,
    ]
    for p in pages:
        assert html.next_data(p) == html.page(p, ["next_data"])["next_data"], p
    d = spark.createDataFrame(list(enumerate(pages)), "k int, html string").repartition(2)
    got = html.page_state_texts(d, root="props.pageProps")
    want = html.state_texts(html.with_page(d.select("k", F.col("html").alias("p")), F.col("p"), "next_data").select("k", "p.next_data"), "next_data", "props.pageProps").drop("next_data")
    assert got.columns == ["k", "ord", "depth", "path", "text"] and len(rows := got.collect()) > 15 and sorted(rows) == sorted(want.collect())
    monkeypatch.setattr(html, "BATCH", 100)
    b = pa.RecordBatch.from_pydict({"k": [1, 2, 3], "html": [script, None, script]})
    assert [(x.num_rows, x.column(0)[0].as_py()) for x in html._told(iter([b]), "props.pageProps")] == [(3, 1), (1, 3)]


def test_state_texts_query_plan(spark, tmp_path):
    """One Python worker a task for reading and walking."""
    from promolens.plans import web

    spark.createDataFrame([(1, "<p>a</p>")], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = web.state_texts(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "UDTF" not in plan and got.count() == 4
