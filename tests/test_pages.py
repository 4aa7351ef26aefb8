"""Markup, gates of blocks and chunks, links, embedded data, crawl decisions."""

import json

import pytest
from pyspark.sql import functions as F

from promolens.functions import chunks, extract, text, vocab
from promolens.functions.text import block_score
from promolens.operators import crawl
from promolens.sources import html

PAGE = """<html><head><title>T &amp; x</title><meta name="description" content="old"><meta name="description" content="new"><meta property="og:title" content="O"><meta name="robots" content="no">
<script type="application/ld+json">{"@graph":[{"@type":"Bar","name":"The Long Bar","openingHours":["Mo 1-2","Tu 3-4"],"offers":[{"name":"Two","price":5},{"price":1}],"hasMenu":{"name":"M"},"department":{"name":"Kitchen","openingHoursSpecification":[{"dayOfWeek":"Mon","opens":"07:00","closes":"09:00"}]}}]}</script>
<script type="application/ld+json">{bad</script><script id="__NEXT_DATA__">{"props":{"pageProps":{"a":"a text of twenty characters","b":["http://not.this.one.please.thanks","short"]}}}</script></head>
<body><nav><a href="/menu">Our menu</a><a href="/about">About</a><a href="/specials/?x">Specials</a><a href="http://a.b/specials">again</a><a href="http://other.b/deals">deals</a><a href="#x">x</a></nav>
<div class="hero-banner" id="root">Happy hour every day from four</div><div><p>First paragraph of this page</p><p>Happy hour specials from 4pm to 6pm</p><span>ok</span><p>A third paragraph, at last</p><p>Too far away to be told</p></div>
<footer><p>Happy hour in the footer, not told</p></footer><script>var x="</p>";</script></body></html>"""


def values(spark, *columns, **row):
    """One row's columns."""
    d = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in row.items()))
    return tuple(d.select(*columns).first())


def test_markup():
    p = html.page(PAGE)
    assert p["title"] == "T & x" and p["meta"] == {"description": "new", "og:title": "O"} and p["div_ids"] == ["root"]
    assert p["body"].startswith("T & x Happy hour every") and "footer" not in p["body"] and "var x" not in p["text"]
    assert [b["text"] for b in p["blocks"] if b["tag"] == "p"] == ["First paragraph of this page", "Happy hour specials from 4pm to 6pm", "A third paragraph, at last", "Too far away to be told"]
    assert p["blocks"][3]["near"] == ["First paragraph of this page", "A third paragraph, at last"]
    assert [h["kind"] for h in p["heroes"]] == [2, 3]
    assert html.page(None)["blocks"] == [] and html.page("<p>a<br>b<p>c</p></div>")["text"] == "a b c"
    assert html.page("<div>" * 3000 + "deep")["text"] == "deep"  # no recursion


def test_page_columns(spark):
    d = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id int, html string").withColumn("p", html.parsed(F.col("html")))
    p = F.col("p")
    rows = d.select("id", html.relevant_text(p).alias("t"), html.is_shell(p, F.col("html")).alias("shell"), html.internal_links(p, F.lit("http://a.b")).alias("links"), html.candidate_chunks(p).alias("chunks")).orderBy("id").collect()
    hero = "Happy hour every day from four"
    assert rows[0].t == " ".join([hero, hero, hero, "First paragraph of this page Happy hour specials from 4pm to 6pm ok A third paragraph, at last Too far away to be told", "Happy hour specials from 4pm to 6pm", "First paragraph of this page", "A third paragraph, at last"])
    assert not rows[0].shell or len(html.page(PAGE)["text"]) <= 300
    assert [tuple(x) for x in rows[0].links] == [("http://a.b/menu", 1)] or [tuple(x) for x in rows[0].links] == [("http://a.b/specials/", 2), ("http://a.b/specials", 2), ("http://a.b/menu", 1)]
    assert rows[0].chunks[0].keyword_hits == ["happy hour", "special", "specials"] and [c.score for c in rows[0].chunks] == sorted([c.score for c in rows[0].chunks], reverse=True)
    assert all(r.t == "" and not r.shell and r.links == [] and r.chunks == [] for r in rows[1:])
    m = html.mined(d.select("id", "html")).orderBy("id").collect()
    assert m[0].jsonld_types == ["Bar"] and m[0].jsonld_text == ["The Long Bar", "Mo 1-2 | Tu 3-4", "Two:  $5", "Menu: M", "Kitchen", "Mon: 07:00-09:00"]
    assert m[0].has_next_data and m[0].next_data_texts == ["a text of twenty characters"] and not m[1].has_next_data and m[1].jsonld_blocks == 0


def test_whole_references(spark):
    """Titles that break off within a character reference, as page_texts and mined_pages have them in their SQL."""
    t = "<title>a &amp; b&amp</title><p title='&lt &lt;'>c &notit; &copy &#65; &#65 &nosuch;</p><script>x &amp; &amp</script>"
    text = "a & b&amp c &notit; &copy A &#65 &nosuch;"
    p = html.page(t, ["text", "title"], whole=True)
    assert p == {"text": text, "title": "a & b&amp"} and html.page(t, ["title"])["title"] == "a & b&" and html.page("a\ue000&amp", ["text"], whole=True)["text"] == "a\ue000&amp"
    node = [n for n in html.Tree(t, whole=True).root.walk() if n.tag in ("p", "script")]
    assert node[0].attrs == {"title": "&lt <"} and node[1].raw() == "x &amp; &amp"
    d = spark.createDataFrame([(1, t)], "id int, html string")
    assert html.mined(d, whole=True).first().visible_text_preview == text


def test_batches_of_pages(spark):
    """However many pages a batch brings, what they hold is handed on a little at a time; every field is the column form's."""
    import pyarrow as pa

    many = [PAGE, None, "<div>" * 200 + "x" * 3000 + "</div>" * 200] * 40
    got = list(html._batches(iter([pa.RecordBatch.from_arrays([pa.array(range(120)), pa.array(many)], ["id", "p"])]), ["blocks", "meta", "state"], False))
    assert [k for b in got for k in b.column(0).to_pylist()] == list(range(120)) and len(got) > 10
    assert max(sum(map(html._size, b.column(1).to_pylist())) for b in got) < 2 * html.BATCH + 4_000_000
    d = spark.createDataFrame([(1, PAGE, [1]), (2, None, None)], "id int, html string, `odd name` array<int>")
    want = d.withColumn("p", html.parsed(F.col("html"))).orderBy("id").collect()
    assert html.with_page(d, F.col("html"), *html.FIELDS).orderBy("id").collect() == want


def test_embedded_walk():
    assert list(html.walked({"a": ["x" * 20] * 60})) == ["x" * 20] * 50
    deep = "y" * 20
    for _ in range(9):
        deep = [deep]
    assert list(html.walked(deep)) == []
    assert html.ld_blocks(['[{"@type":"A"},1]', '{"@type":"B"}', "x"]) == [{"@type": "A"}, {"@type": "B"}]
    assert html.ld_texts([{"@type": "Event", "name": "Gig", "startDate": "2026"}]) == ["Event: Gig 2026"]
    assert json.loads(html.page("<script>window.__NUXT__ = {\"a\": 1};</script>")["nuxt"]) == {"a": 1}


def test_gates(spark):
    c = F.col("x")
    got = lambda f, x: values(spark, f(c), x=x)[0]
    assert got(chunks.has_hours, "open 10am, closed 5:30 PM") and not got(chunks.has_hours, "from 10am\nto 5pm")
    assert got(chunks.is_noise, "Subscribe now") and got(chunks.is_noise, "a a a a a a a a b") and not got(chunks.is_noise, "a a a a a a a b")
    assert got(chunks.is_chunk_menu, "pizza $5 salad $6") and not got(chunks.is_chunk_menu, "pizza special $5 salad $6") and not got(chunks.is_chunk_menu, None)
    assert got(chunks.chunk_score, "Happy hour mon $5, 20 % off") == 3 + 2 + 2 + 1  # happy hour, $ and % off
    assert got(chunks.truncated, "x" * 40) == "x" * 36 + "…" and got(chunks.truncated, None) == "—"
    assert got(lambda x: chunks.extra_paths(x), "Night Club") == vocab.EXTRA_PATHS["nightclub"] and got(chunks.extra_paths, "Bar & Restaurant") == []
    assert got(chunks.clean_text, " a \n\t b ") == "a b" and got(chunks.clean_text, None) == ""
    assert got(chunks.price_terms, "Free") == "cover charge admission price tickets" and got(chunks.price_terms, None) == vocab.OTHER_PRICE_TERMS
    assert got(chunks.split_chunks, "a ||| b|||  ||| c") == ["a", "b", "c"] and got(chunks.split_chunks, None) == []
    assert got(chunks.url_key, "http://a.b/c;p=1?q#f") == "http://a.b/c"
    assert got(text.ascii_clean, "S u n d a y  ok é x") == "S u n d a y ok x" or got(text.ascii_clean, "S u n d a y ok é") in ("ok", "S u n d a y ok")
    assert got(text.has_spaced_chars, "a b c d e f g h i j k l m n o p q r s t") and not got(text.has_spaced_chars, "a b c")
    assert values(spark, chunks.bar(F.col("x").cast("double") / 4), x=1)[0] == "█" * 5 + "░" * 15
    assert got(chunks.fetch_failure, "DNS lookup failed") == "dns_unresolved" and got(chunks.fetch_failure, "SSL oops") == "ssl_error"
    own = lambda link, title, snippet: values(spark, chunks.is_own_result(F.lit("Joe's"), F.col("a"), F.col("b"), F.col("c")), a=link, b=title, c=snippet)[0]
    assert own("http://joes.com", "Joe's", "deals") and not own("http://www.yelp.com/x", "Joe's", "deals") and not own("http://x.yelp.com", "Joe's", "d")
    assert not own("http://a.b", "Best bars near Joe's", "d") and not own("http://a.b", "Jane's", "d") and not own("http://a.b", "Joe's", "") and not own("http://a.b", "Does Joe's have a happy hour?", "d")


def test_borders_of_words(spark):
    """Words end at letters beyond ASCII, as in the SQL of text_gates."""
    got = lambda f, x: values(spark, f(F.col("x")), x=x)[0]
    assert got(text.is_menu_block, "$5 prize $6 Ñtaco mente") and got(text.is_menu_block, "$5 $6 soupé") and not got(text.is_menu_block, "$5 $6 staco")
    assert got(chunks.has_hours, "é4pm to 5pmñ") and not got(chunks.has_hours, "x4pm to 5pm") and got(chunks.chunk_score, "ñmoné") == 1 and got(chunks.chunk_score, "mont") == 0


@pytest.mark.parametrize(
    ("text_", "want"),
    [("Happy hour Monday - Friday 4pm-7pm, daily; every Tuesday at 17:00", "Monday - Friday, Tuesday, 4pm-7pm, 17:00, Happy hour, daily"), ("Mon to Wed", "Mon to Wed"), ("", "Unknown"), (None, "Unknown"), ("noon NOON midnight Jan 5", "noon, midnight, Jan 5")],
)
def test_timing(spark, text_, want):
    assert values(spark, extract.timing(F.col("x")), x=text_)[0] == want


def test_label_maps(spark):
    c = F.col("x")
    one = lambda f, x: values(spark, f(c), x=x)[0]
    assert one(extract.broad_category, " Taco Tuesday ") == "Happy Hour" and one(extract.broad_category, "Group Friendly") is None
    assert one(lambda x: extract.broad_category(x, compared=True), "Group Friendly") == "Group Booking"
    assert one(extract.venue_type, "Dining & Nightclub") == "Nightclub" and one(lambda x: extract.venue_type(x, training=True), "Dining & Nightclub") == "Dining" and one(extract.venue_type, None) == "Other"
    assert one(extract.relabel_motivator, "Early Entry") == "Urgency" and one(extract.relabel_motivator, "?") == "Value" and one(extract.motivator_class, "Unknown") is None
    assert one(extract.llm_status, "ends soon") == "Ongoing" and one(extract.status, "ends soon") == "Limited Time"


def test_crawl(spark):
    rows = [("v", "/menu", 1, 1, "x"), ("v", "/menu", 1, 2, "happy hour"), ("v", "/menu", 1, 3, "discount"), ("v", "/deals", 2, 1, "happy hour discount deal special"), ("v", "/events", 3, 1, None), ("w", "", 1, 1, "y" * 400)]
    p = crawl.replaced(spark.createDataFrame(rows, "venue string, path string, ord int, attempt int, text string"))
    assert {(r.venue, r.path): (r.text, r.score) for r in p.collect()} == {("v", "/menu"): ("happy hour", 1), ("v", "/deals"): ("happy hour discount deal special", 4), ("v", "/events"): (None, 0), ("w", ""): ("y" * 400, 0)}
    assert sorted(r.path for r in crawl.until_good(p, vocab.STOP_PATHS).collect()) == ["", "/deals", "/menu"]
    assert [r.venue for r in crawl.unsettled(p).collect()] == ["w"]
    assert [(r.venue, r.path) for r in crawl.sparse_paths(p).orderBy("k").collect()] == [("v", "/deals"), ("v", "/events"), ("v", "/menu")]
    v = spark.createDataFrame([("w", "Sports bar"), ("v", "Casino")], "venue string, business_type string")
    assert [r.path for r in crawl.next_paths(p, v).orderBy("k").collect()] == vocab.EXTRA_PATHS["bar"]
    assert [(r.venue, r.text) for r in crawl.archived_text(p).orderBy("venue").collect()] == [("v", "happy hour discount deal special"), ("w", "y" * 400)]
    found = spark.createDataFrame([("J", 2, "http://j.x", "J two", "b"), ("J", 1, "http://j.x", "J one", "a"), ("J", 3, "http://yelp.com", "J", "c")], "venue string, pos int, link string, title string, snippet string")
    box = spark.createDataFrame([("J", "answer")], "venue string, answer string")
    assert crawl.search_text(found, box).first().text == "answer J one. a J two. b"
    assert values(spark, crawl.search_query(F.col("n"), F.col("c")), n="J", c=None)[0] == '"J"  happy hour specials deals'


def test_links_are_read_once(spark):
    """the page's address and a link's words are worked out once, not for every keyword and every other link."""
    plan = spark.createDataFrame([(PAGE, "http://a.b/x")], "html string, url string").select(html.internal_links(html.parsed(F.col("html")), text.clean_url(F.col("url"))).alias("c"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(";[^/]*$") == 1 and plan.count("lower(") == 1


def test_chunks_are_lowered_once(spark):
    """a chunk is put in lower case and cut into words once, not for every keyword."""
    d = spark.createDataFrame([("Happy hour: $5 beers, 20 % off daily from four to six",), ("a " * 20,), (None,)], "t string")
    plan = lambda c: d.select(c.alias("c"))._jdf.queryExecution().analyzed().toString()
    t = F.col("t")
    assert [plan(c).count("lower(") for c in (chunks.chunk_score(t), block_score(t))] == [1, 1] and plan(chunks.is_noise(t)).count("split(") == 1
    assert [tuple(r) for r in d.select(chunks.chunk_score(t) > 4, chunks.is_noise(t), chunks.is_chunk(t)).collect()] == [(True, False, True), (False, True, False), (False, False, False)]


def test_mined_columns(spark):
    """F8, F10: only the fields that the wanted columns need are read, with the same values."""
    d = spark.createDataFrame([(1, PAGE), (2, None)], "id int, html string")
    for only in (["jsonld_types", "jsonld_text"], ["html_size", "has_next_data", "visible_text_preview"], ["html_size"]):
        got = html.mined(d, only=only)
        assert sorted(got.collect()) == sorted(html.mined(d).select("id", *only).collect()) and got.columns == ["id", *only]
    plan = html.mined(d, only=["jsonld_text"])._jdf.queryExecution().analyzed().toString()
    assert "visible" not in plan and "meta" not in plan


def test_items_list_every_chunk(spark, tmp_path):
    """No chunk of a page is left out of its item or cut, however many there are and however long; what lies in a template alone counts too."""
    from promolens.plans.web import scraped_items

    long = "Happy hour special " + " ".join(f"w{i}" for i in range(900))
    each = [f"Chunk {i} of this page has a discount" for i in range(25)]
    day = "mon is when you come here, as all of us do"
    sheet = "Karaoke on monday, for $5 a song and more"
    rows = [(5, "<body>" + "".join(f"<li>{t}</li>" for t in each) + f"<p>{long}</p><p>Nothing to be told here, in thirty letters</p></body>"), (10, f"<p>An offer in thirty letters or more</p><template><p>{sheet}</p></template>"), (12, None), (15, f"<p>x{day} it was</p><template><p>{day}</p></template>")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in scraped_items(spark, str(tmp_path)).collect()}
    assert got[5].all_candidate_chunks.split(" ||| ") == [long, *each] and got[5].top_candidate_text == long and got[5].top_candidate_score == 2 and got[5].failure_type == "ok"
    assert got[10].all_candidate_chunks.split(" ||| ") == [sheet, "An offer in thirty letters or more"] and got[10].top_candidate_score == 5 and got[10].incentive_score == 1 and got[10].keyword_hits == "offer"
    assert (got[12].all_candidate_chunks, got[12].top_candidate_text, got[12].top_candidate_score, got[12].failure_type) == ("", "", 0, "blocked_or_forbidden")
    assert (got[15].all_candidate_chunks, got[15].top_candidate_score, got[15].incentive_score) == (day, 1, 0)
    d = html.with_page(spark.createDataFrame(rows, "page_id long, html string").withColumn("status", F.lit(200)), F.col("html"), "text", "title", "chunks")
    cut = {r.page_id: r for r in crawl.crawled_item(d, listed=8, chars=1000).collect()}  # the reference's item
    assert cut[5].all_candidate_chunks.split(" ||| ") == [long[:1000], *each[:7]] and cut[5].top_candidate_text == long[:1000]
    assert [c.text for c in d.where("page_id = 5").select(html.candidate_chunks(F.col("p")).alias("c")).first().c] == [long[:1000], *each[:19]]


@pytest.mark.parametrize("t", ["Happy hour mon $5, 20 % off", "xmon monx mon_", "ñmoné", "(WEEKLY) $ 7", "Free deals, groups: group discount 5%", "", None, "KKweekly weeKly"])
def test_told(spark, t):
    """What a text tells is what its score and hits count, also when only that of a longer text is looked for."""
    one = chunks.told(F.col("x"))
    within = chunks.told(F.col("x"), chunks.told(F.concat(F.lit("Early bird special daily, $9 or 9% "), F.coalesce("x", F.lit("")))))
    score, keys, *found = values(spark, chunks.chunk_score(F.col("x")), chunks.keyword_hits(F.col("x")), one.alias("a"), within.alias("b"), chunks.told_score(one), x=t)
    assert found[2] == score and found[0].hits == keys and found[0] == found[1]
