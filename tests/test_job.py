"""The main job, the cascade, comparisons, the TF-IDF report, training data, readers and writers."""

import json

from pyspark.sql import functions as F

from promolens.operators import cascade, evaluate, job, tfidf_report, training
from promolens.operators.clients import KeywordClient
from promolens.sources.positions import sliced
from promolens.sources import lists, sinks

VENUES = "row_idx long, venue_id string, venue_name string, city string, `Business Type` string, `Source URL` string"


class Broken:
    def __call__(self, prompt):
        raise OSError("no network")


def short(prompt):
    return "short $5"


def test_job(spark, tmp_path):
    venues = spark.createDataFrame([(0, "a", "A", "LA", "pub", "http://a"), (1, "b", "B", None, None, "http://b"), (2, "c", None, "SF", "Bar", "http://c")], VENUES)
    pages = spark.createDataFrame([(0, "Welcome. Happy hour daily 4pm to 6pm with five tasty small snacks at the bar. Bye"), (1, "Nothing here at all"), (2, "")], "row_idx long, text string")
    pricing = spark.createDataFrame([(0, "beers $4 off"), (1, "$9")], "row_idx long, pricing_text string")
    got = {r.venue_id: r for r in job.run(venues, pages, KeywordClient, pricing=pricing).collect()}
    a = got["a"]
    assert (a["Incentive Category"], a.row, a["Group Friendly?"], a["Estimated Perceived Value ($ range)"]) == ("Happy Hour", 1, "Yes", "$4 off") and a.Notes.endswith("[value: pricing search]")
    assert a._meta.extraction_source == "llm" and a._meta.model_confidence == 1.0 and a.incentives[0].title == "Happy Hour" and a.incentives[0].type == "always"
    assert got["b"]["Incentive Category"] == "No Incentive" and got["b"].incentives == [] and got["b"]["Incentive Teaser"] == "No incentive found"
    assert got["c"].venue_name == "Unknown" and got["c"]._meta.text_chars == 0
    m = job.metrics(job.run(venues, pages, KeywordClient)).first()
    assert (m.n, m.scraped, m.by_source) == (3, 2, {"llm": 1, "no_result": 2}) and abs(m.avg_model_confidence - 1 / 3) < 1e-9
    assert {r._meta.extraction_source for r in job.run(venues, pages, Broken).collect()} == {"no_result"}
    teaser = {r.venue_id: r["Incentive Teaser"] for r in job.run(venues, pages, KeywordClient, rewriter=lambda: short).collect()}
    assert teaser["a"] == "short $5" and teaser["b"] == "No incentive found"
    path = f"{tmp_path}/out.json"
    assert sinks.json_array(job.run(venues, pages, KeywordClient), path, "row") == 3
    back = json.load(open(path))
    assert back[0]["incentives"][0]["priority"] is None and "schedule" not in back[0]["incentives"][0] and back[1]["incentives"] == []
    sinks.json_array(venues.limit(0), path)
    assert json.load(open(path)) == []
    relabelled = job.relabelled(spark.createDataFrame([("n", "Bar", "Free", ("happy hour " * 12,)), ("s", "Bar", "Free", ("short",))], "venue_name string, `Business Type` string, `Incentive Category` string, _meta struct<scraped_text:string>"), lambda: KeywordClient(""))
    assert [(r["Incentive Category"], r["Psychological Motivator Type"], r._meta.old_category) for r in relabelled.collect()] == [("Happy Hour", "Value", "Free")]
    assert tuple(job.relabel_counts(relabelled).first()) == (1, 1, 0, 1)


def test_answers(spark):
    d = spark.createDataFrame([("```json\n{\"category\": \"Free\", \"teaser\": \"t\"}\n```",), ("{\"value\": \"1\"}",), ("no",), (None,)], "raw string")
    assert [(r.a.category, r.a.teaser, r.a.value) for r in d.select(job.parsed_fenced(F.col("raw")).alias("a")).collect()] == [("Free", "t", ""), ("No Incentive", "", "1"), ("No Incentive", "", ""), ("No Incentive", "", "")]
    turns = d.limit(1).select(job.chat_turns(F.lit("x" * 5000), F.lit("Bar"), [("a", "b")]).alias("t")).first().t
    assert [t.role for t in turns] == ["user", "assistant", "user"] and turns[2].content == "[Venue type: Bar]\n\n" + "x" * 4000


def test_cascade(spark):
    p = lambda s, label, conf: (s, label, "Value", "Dining", conf)
    happy, cover, low = "Happy hour with $5 off cocktails every Friday", "No cover charge before ten with the guest list", "Live music tonight with special guests"
    rows = [
        (1, None, "Bar", []), (2, "Nothing to tell anyone here", "Bar", []),
        (3, f"{happy}. {cover}", "Nightclub", [p(happy, "Happy Hour", 0.9), p(cover, "Free", 0.4)]),
        (4, happy, "Bar", [p(happy, "Happy Hour", 0.6)]), (5, happy, "Bar", [p(happy, "Free", 0.6)]), (6, happy, "Bar", [p(happy, "Happy Hour", 0.2)]),
        (7, "Save on the annual pass, special members rate", "Bar", [p("Become a member and save with a special pass", "Discount", 0.8)]), (8, low, "Bar", [p(low, "No Incentive", 0.9)]),
    ]
    d = spark.createDataFrame(rows, "id int, text string, business_type string, predictions array<struct<sentence string, label string, motivator string, cuisine string, confidence double>>")
    got = {r.id: r.result for r in cascade.run(d, lambda: KeywordClient("")).collect()}
    assert got[1].notes == "Could not scrape source" and got[2].notes == "No incentive keywords found on page"
    assert (got[3].category, got[3].description, got[3].motivator) == ("Early Entry", cover, "FOMO") and got[3].notes.endswith("[btype-prior: Early Entry]") and got[3].value == "$5 off"
    assert (got[4].source, round(got[4].model_confidence, 2), got[4].value, got[4].timing) == ("ml_model_hinted", 0.75, "$5 off", "Friday, Happy hour")
    assert (got[5].source, got[5].category, got[5].cuisine, got[5].model_confidence) == ("fallback", "Happy Hour", "Dining", 0.6)
    assert (got[6].source, got[6].model_confidence) == ("fallback", 1.0) and got[7].notes.startswith("Membership") and got[8].source == "fallback"
    none = {r.id: r.result for r in cascade.run(d, Broken).collect()}
    assert none[5].source == "ml_model_fallback" and none[6].notes == "No incentive detected"


def test_evaluate(spark):
    rows = [(1, "Happy Hour", None, 0), (1, "Taco Tuesday", "x", 1), (2, "Free", "Unknown", 2), (None, "Free", "y", 3), (3, "Odd", "z", 4)]
    gold = spark.createDataFrame(rows, "venue_id int, `Incentive Category` string, `Group Friendly?` string, row_idx int")
    run = spark.createDataFrame([(1, "happy hour", "X ", 5, 10), (2, "Discount", "—", 6, 0), (9, "Free", "y", 7, 1)], "venue_id int, `Incentive Category` string, `Group Friendly?` string, row_idx int, text_chars int")
    pairs = evaluate.matched(gold, run)
    flags = evaluate.field_flags(pairs, ["Incentive Category", "Group Friendly?"])
    assert sorted((r.venue_id, r.field, r.flag) for r in flags.collect()) == [(1, "Group Friendly?", "✓"), (1, "Incentive Category", "✗"), (2, "Group Friendly?", "~"), (2, "Incentive Category", "✗")]
    s = evaluate.summary(flags, evaluate.categories(pairs)).first()
    assert (s.agree, s.counted, s.n, s.exact, s.broad, s.scraped, s.scraped_broad) == (1, 3, 2, 0, 0, 1, 0) and abs(s.field_pct - 100 / 3) < 1e-9
    none = evaluate.summary(flags.limit(0), evaluate.categories(pairs).limit(0)).first()
    assert none.n == 0 and none.exact_pct == 0.0
    d = spark.createDataFrame([(" Free", "free", 1.0), ("a", "b", 3.0)], "p string, t string, sec double")
    assert tuple(evaluate.accuracy(d, "p", "t", ["sec"]).first()) == (2, 1, 0.5, 2.0) and evaluate.accuracy(d.limit(0), "p", "t").first().accuracy == 0.0
    assert tuple(evaluate.agreement_percent(d, "p", "t").first()) == (2, 0, 0) and evaluate.agreement_percent(d.limit(0), "p", "t").first().percent is None


def test_gold_csv(spark, tmp_path):
    open(f"{tmp_path}/g.csv", "w", encoding="utf-8-sig").write(
        "venue_name,Source URL,Business Type,Incentive Category,Incentive Teaser,Full Incentive Description\n"
        'A,http://a,Bar,Free,t,"two\nlines, ""quoted"""\nB,http://a,Bar,Free,t,d\nC,ftp://c,Bar,Free,t,d\nD,http://d d,Bar,Free,t,d\nE, ,Bar,Free,t,d\nF,http://f,Bar,Free,t,d\n'
    )
    d = lists.csv(spark, f"{tmp_path}/g.csv")
    assert d.columns[0] == "venue_name" and {r.reason: r.n for r in evaluate.drop_counts(evaluate.gold_reasons(d)).collect()} == {"kept": 2, "duplicate_url": 1, "bad_url": 2, "missing_required": 1}
    g = lists.gold(spark, f"{tmp_path}/g.csv").collect()
    assert {r.venue_name for r in g} == {"A", "F"} and [r.venue_name for r in g] == [r.venue_name for r in lists.gold(spark, f"{tmp_path}/g.csv").collect()] and len(lists.gold(spark, f"{tmp_path}/g.csv", 1).collect()) == 1
    assert next(r for r in g if r.venue_name == "A")["Full Incentive Description"] == 'two\nlines, "quoted"'
    open(f"{tmp_path}/labels.txt", "w").write("b\n\na\n")
    assert [tuple(r) for r in lists.labels(spark, f"{tmp_path}/labels.txt").collect()] == [(0, "b"), (1, "a")]
    v = spark.createDataFrame([(0, None), (1, "Free"), (2, "Unknown"), (3, "Discount")], "row_idx int, `Incentive Category` string")
    assert [r.row_idx for r in lists.known_first(v, limit=3).collect()] == [1, 3, 0] and [r.row_idx for r in sliced(v, 1, 2).orderBy("row_idx").collect()] == [1, 2] and sliced(v, 3).count() == 1
    assert lists.projected(v, []) is None and lists.projected(v, ["Incentive Category"]).columns == ["Incentive Category"]
    assert sinks.unique_csv(v, f"{tmp_path}/o").endswith("o.csv") and sinks.unique_csv(v, f"{tmp_path}/o").endswith("o_1.csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/o_1.csv").count() == 4
    assert sinks.collapsed(spark.createDataFrame([(" a \n b ", 1)], "x string, y int")).first() == ("a b", 1)


def test_records(spark, tmp_path):
    json.dump([{"a": 1}, {"a": 2}], open(f"{tmp_path}/x.json", "w"))
    json.dump([{"a": 3}], open(f"{tmp_path}/x_relabeled.json", "w"))
    assert lists.records(spark, str(tmp_path), schema="a int").count() == 3 and lists.records(spark, str(tmp_path), schema="a int", relabelled=False).count() == 2
    s = lists.sampled(spark.createDataFrame([(str(k), f"http://{k}") for k in range(30)] + [(None, "http://x"), ("y", "http://x y")], "n string, u string"), ["n"], "u")
    assert s.count() == 10 and s.collect() == s.collect()


def test_tfidf_report(spark):
    rows = [
        (0, "u", "V", "Free", "t", "cold beer and pizza", "Pizza night", "cold beer on tap ||| PIZZA   night ||| ", "timeout"), (1, "u", "W", "x", "x", "x", None, "cold beer on tap|||other", "ssl"),
        (2, None, None, None, None, None, "lone", None, "ok"), (3, "w", "Z", "c", "t", "gold", None, None, None),
    ]
    d = spark.createDataFrame(rows, "row_idx long, source_url string, venue_name string, incentive_category_gold string, teaser_gold string, description_gold string, top_candidate_text string, all_candidate_chunks string, failure_type string")
    got = {r.source_url: r for r in tfidf_report.report(d, ["and", "on"]).collect()}
    assert (got["u"].best_chunk, got["u"].num_chunks, got["u"].failure_types, got["u"].best_failure_type, got["u"].venue_name) == ("cold beer on tap", 3, "ssl, timeout", "ssl", "V") and got["u"].tfidf_similarity > 0
    assert (got[None].best_chunk, got[None].tfidf_similarity, got[None].num_chunks, got[None].best_failure_type) == ("", 0.0, 1, "ok") and (got["w"].num_chunks, got["w"].best_failure_type) == (0, "")


def test_training(spark, tmp_path):
    texts = {"Happy Hour": "five dollar beers from four to six", "Free": "free entry for all kids on sunday", "No Incentive": "we are open every day, call us now"}
    rows = [(f"{t} number {k}", c, "Value" if k % 2 else "Free", "Dining", "Dining", "presplit") for c, t in texts.items() for k in range(12)] + [("short", "Free", "Free", None, None, "x"), (None, "Free", "Free", None, None, "x"), (" ".join("abcdefghijklmnopqrstuvw"), "Free", "Free", "a", "b", "x")]
    d = training.dataset(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in training.COLUMNS)))
    assert d.count() == 36
    fitted = training.classifier(200).fit(training.weighted(d))
    assert training.labels_of(fitted)["category"] == ["Free", "Happy Hour", "No Incentive"]
    new = training.predicted(fitted, spark.createDataFrame([("beers from four", "Dining"), ("kids on sunday", "Casino")], "text string, btype string")).collect()
    assert [r.label for r in new] == ["Happy Hour", "Free"] and [r.cuisine for r in new] == ["Dining"] * 2 and all(0.3 < r.confidence < 1.0001 for r in new), new
    sinks.model(fitted, f"{tmp_path}/m")
    assert sinks.is_saved(spark, f"{tmp_path}/m") and not sinks.is_saved(spark, f"{tmp_path}/n")
    assert [r.value for r in spark.read.text(f"{tmp_path}/m/labels_category").collect()] == ["Free", "Happy Hour", "No Incentive"]
    pages = [(c, m, "Bar", "Bar", "t", "d" * k, (("p" * n), s, n)) for k, (c, m, s, n) in enumerate([("Taco Tuesday", "Savings", "claude", 60), ("Free", "Free", "llama", 60), ("x", "x", "no_result", 300), ("x", "x", "no_result", 100), ("Free", "Free", "claude", 3000), ("No Incentive", "Value", "claude", 90)])]
    r = spark.createDataFrame(pages, "`Incentive Category` string, `Psychological Motivator Type` string, `Cuisine / Experience Category` string, `Business Type` string, `Incentive Teaser` string, `Full Incentive Description` string, _meta struct<scraped_text:string, extraction_source:string, text_chars:int>")
    assert sorted((x.source, x.category, len(x.text)) for x in training.run_rows(r).collect()) == [("pipeline", "Free", 2000), ("pipeline", "Happy Hour", 60), ("pipeline", "No Incentive", 90), ("pipeline_neg", "No Incentive", 300)]
    assert sorted(x.category for x in training.relabelled_rows(r).collect()) == ["Free", "Free", "Happy Hour"] and training.gold_rows(r).count() == 0
    assert training.run_rows(r, negatives=0).where("source = 'pipeline_neg'").count() == 0


def test_training_reads_texts_once(spark, monkeypatch):
    texts = {"Happy Hour": "five dollar beers from four to six", "No Incentive": "we are open every day, call us now"}
    d = training.dataset(spark.createDataFrame([(f"{t} number {k}", c, "Value" if k % 3 else "FOMO", "ab"[k % 2], "Dining", "x") for c, t in texts.items() for k in range(20)], ", ".join(f"{c} string" for c in training.COLUMNS)))
    assert d._jdf.queryExecution().optimizedPlan().toString().count("[^\\x00-\\x7F]") == 1  # each filter had cleaned the text anew
    train = training.weighted(d)
    names, kept = [], training.kept
    monkeypatch.setattr(training, "kept", lambda df, name: names.append(name) or kept(df, name))
    model = training.fitted(train, 50)
    assert names == ["counts", "features"]
    told = lambda m: sorted(training.predicted(m, d.select("text", "btype")).select("text", "label", "motivator", "cuisine").collect())
    assert told(model) == told(training.classifier(50).fit(train)) and training.labels_of(model)["cuisine"] == ["a", "b"]
