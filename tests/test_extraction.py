"""Extraction through models, requests in bulk, index upkeep, sinks and sources against fixed cases."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions import formula, text
from folioflow.operators import analysis, history, labels, records, resolution
from folioflow.plans import extraction as X
from folioflow.plans import requests as Q
from folioflow.sources import documents as S
from folioflow.sources import sinks


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def paras(spark):
    data = [
        ("p1", 0, "T1", "Abstract", "We made alloys.", False, []), ("p1", 1, "T1", "1. Introduction", "First intro.", False, []), ("p1", 2, "T1", "1. Introduction", "Last intro on HEA.", False, []),
        ("p1", 3, "T1", "2. Methods", "Arc melting was used.", True, []), ("p1", 4, "T1", "3. Results", "It has 500 MPa.", False, ["strength"]), ("p1", 5, "T1", "table", "a,b", False, ["strength"]),
        ("p2", 0, "T2", "3. Results", "FCC HEA phase.", False, ["phase"]), ("p3", 0, "T3", "", "nothing", False, []),
    ]
    return spark.createDataFrame(data, "source string, para_id int, title string, sub_titles string, page_content string, is_synthesis boolean, property_types array<string>")


# chunks, formulas


def test_chunk_rules():
    s = lambda n, c="x": " ".join([c] * (n - 1) + [c + "."])
    sizes = lambda *n: [len(c.split()) for c in text.chunk(" ".join(s(k) for k in n))]
    assert sizes(381, 251) == [632]  # never cut before the last sentence
    assert sizes(300, 200, 100) == [300, 300] and sizes(300, 150, 40) == [490]  # at least 200 must be left
    assert sizes(450, 10) == [460] and sizes(450, 300, 10) == [450, 310] and sizes(100, 100) == [200]
    assert text.chunk("a b c", most=2, count=len, split=lambda t: ["a", "b", "c"]) == ["a b c"]


def test_token_chunks():
    assert text.token_chunks("one two. three four five six", 2) == ["one two.", "three four", "five six"]
    words = " ".join(f"w{k}." if k % 7 == 6 else f"w{k}" for k in range(100))
    got = text.token_chunks(words, 10)
    assert " ".join(got) == words and all(5 <= len(c.split()) <= 15 for c in got[:-1])
    assert text.token_chunks("", 5) == [] and text.token_chunks("approx. ca. 5 " * 3, 4)[0]


@pytest.mark.parametrize(("said", "want"), [("5Al10Ti", "Al33.333 Ti66.667"), ("Al5–Ti10", "Al33.333 Ti66.667"), ("Al-5 Ti10", "Al33.333 Ti66.667"), ("(CoCr)Ni", "Co33.333 Cr33.333 Ni33.333"), ("(CoCrNi)94Al6", "Al6 Co31.333 Cr31.333 Ni31.333"), ("(Co1.5Cr)2Ni", "Co50 Cr33.333 Ni16.667"), ("Xx5", None), ("(Co", None), ("", None)])
def test_formula_cases(said, want):
    assert formula.normalise(said) == want


@pytest.mark.parametrize(("said", "want"), [("((CoCr2)3Al3)2", "Al0.5 Co0.167 Cr0.333"), ("Fe2O3-doped", None), ("FeNi", None), ("a-b-c", None), ("Fe-Ni-Al", "Al0.333 Fe0.333 Ni0.333")])
def test_material_cases(said, want):
    assert formula.normalise_share(said) == want


def test_phase_and_strength_letters(spark):
    from folioflow.functions import normalize as N

    df = spark.createDataFrame([("𝛾 matrix",), ("𝛾' phase",), ("𝛽",), ("𝜎",), ("𝜇",)], "p string")
    assert [r[0] for r in df.select(N.phase_name(F.col("p"))).collect()] == ["FCC", "𝛾' phase", "BCC", "IM", "IM"]
    df = spark.createDataFrame([("5 Nmm2",), ("5 N/mm2",), ("5 kPa",)], "p string")
    assert [r[0] for r in df.select(N.strength_mpa(F.col("p"))).collect()] == [5.0, 5.0, 0.005]


# models


def test_answers_errors_and_retries(spark):
    df = spark.createDataFrame([(1, "two"), (2, "none"), (3, "bad"), (4, None)], "id int, t string")

    def model(t):
        if t == "bad":
            raise ValueError("no")
        return [{"v": 1}, {"v": 2}] if t == "two" else None

    got = {r.id: (r.answers, r.error) for r in X.answers(df, "t", model).collect()}
    assert got[1] == (['{"v": 1}', '{"v": 2}'], None) and got[2] == ([], None) and got[3] == ([], "ValueError: no") and got[4] == ([], None)
    assert rows(X.extracted(df, "t", model), "id", "answer_id") == [(1, 0), (1, 1)]


def test_bucket_and_pauses():
    now, waits = [0.0], []
    sleep = lambda s: (waits.append(round(s, 6)), now.__setitem__(0, now[0] + s))
    bucket = X.Bucket(2.0, 10.0, lambda: now[0], sleep)
    bucket.take(10), bucket.take(4), bucket.take(100)
    assert waits == [2.0, 5.0] and bucket.have == 0
    bucket.reset(50)
    assert bucket.have == 10
    asked = []

    def model(t):
        asked.append(t)
        if len(asked) == 1:
            raise X.TooMany
        return "ok"

    waits.clear()
    assert X.limited(model, 100.0, 1000.0, clock=lambda: now[0], sleep=sleep)("a b") == "ok" and waits == [10.0]
    calls, waits2 = [], []
    failing = X.retrying(lambda t: calls.append(t) or 1 / 0, 4, 2.0, 10.0, waits2.append)
    with pytest.raises(ZeroDivisionError):
        failing("x")
    assert len(calls) == 4 and waits2 == [2.0, 4.0, 8.0]


def test_checked(spark):
    said = ['{"ys": "5", "n": 2}', '{"n": 2}', '{"ys": "5", "n": "x"}', '{"ys": "5", "more": 1}', "[1]", "oops", None, '{"ys": "6"}']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, s string")
    c = X.checked(F.col("s"), {"ys": ("string", True), "n": ("int", False)}, {"ys": ["5"]})
    got = {r.i: (r.c.value is not None, sorted(r.c.errors)) for r in df.select("i", c.alias("c")).collect()}
    assert got[0] == (True, []) and got[1] == (False, ["ys is missing"]) and got[2] == (False, ["n is no int"]) and got[3] == (False, ["more is not known"])
    assert all(not got[i][0] and "not an object" in got[i][1] for i in (4, 5, 6)) and got[7] == (False, ["ys is none of the allowed values"])
    valid = X.valid_answers(df, "s", lambda t: json.loads(t) if t.startswith("{") else None, {"ys": ("string", True), "n": ("int", False)})
    assert rows(valid, "i", "ys", "n") == [(0, "5", 2), (1, None, None), (7, "6", None)][:1] + [(7, "6", None)]


def test_shown_and_properties(spark, paras):
    got = {r.source: r.text for r in X.shown(paras, labels.has_label("strength")).collect()}
    assert got == {"p1": "Title: T1\nAbstract\nWe made alloys.\n1. Introduction\nLast intro on HEA.\n3. Results\nIt has 500 MPa.\nTables:\na,b"}

    def broken(t):
        raise RuntimeError("off")

    found = X.extract_properties(paras, {"strength": lambda t: {"n": t.count("MPa")}, "phase": broken}, synthesis=True)
    assert rows(found, "source", "property", "answer", "error") == [("p1", "strength", '{"n": 1}', None), ("p2", "phase", None, "RuntimeError: off")]
    both = X.isolated(paras, {"strength": lambda t: {"v": 1}, "phase": lambda t: {"v": 2}}, lambda t: "melted" if "melting" in t else None)
    assert rows(both, "source", "property", "answer", "synthesis") == [("p1", "strength", '{"v": 1}', "melted"), ("p2", "phase", '{"v": 2}', None)]
    assert rows(X.contextualised(paras, broken, ["phase"]), "source", "status") == [("p1", "FAILED"), ("p2", "FAILED")]
    picked = X.select_paragraphs(paras, labels.has_label("phase") | labels.has_label("strength"), paras.where("para_id < 5"), title=True, abstract=True)
    assert rows(picked, "source", "text") == [("p1", "T1\nWe made alloys.\nIt has 500 MPa."), ("p2", "T2\n\nFCC HEA phase.")]


def test_prompt_and_examples(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(X.prompt("x={x}, {{y}}={y}!", x=F.col("x"), y=F.col("y"))).first()[0] == "x=a, {y}=!"
    with pytest.raises(ValueError):
        X.prompt("{x}", x=F.lit(1), y=F.lit(2))
    messages = X.example_messages([("t", [{"a": 1}, {"a": 2}])])
    assert [m["role"] for m in messages] == ["user", "assistant", "tool", "tool"] and len(messages[1]["tool_calls"]) == 2
    assert X.record_schema({"strength": ["ys"]}).fieldNames() == ["metadata", "strength"]


def test_names_and_reactions(spark, paras):
    found = spark.createDataFrame([("HEA", "1.5"), ("x", "2"), ("Fe", "unknown"), ("y", "3")], "material string, band_gap string")
    acronyms = spark.createDataFrame([("HEA", "high entropy alloy")], "acronym string, full string")
    kept = X.standard_names(found, spark.createDataFrame([("x",)], "name string"), acronyms, value="band_gap")
    assert rows(kept, "material", "band_gap") == [("high entropy alloy", "1.5"), ("y", "3")]
    named = X.resolved_names(found, paras, lambda t: t.upper(), lambda t: "full of " + t.split("\n")[1] if t.startswith("HEA") else None)
    assert rows(named, "material") == [("FE",), ("X",), ("Y",), ("full of Last intro on HEA.",)]
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    made = [{"reaction_type": "solid-state", "precursors": ["A"], "target": "B"}, {"reaction_type": "other", "precursors": ["A"], "target": "C"}, {"reaction_type": "solid-state", "precursors": [], "target": "D"}]
    got = X.reactions(docs, "t", lambda t: made if t == "a" else [], lambda t: [{**r, "target": r["target"].lower()} for r in json.loads(t)], json.loads)
    assert [(r.id, [(x.target, x.precursors) for x in r.reactions]) for r in got.collect()] == [(1, [("b", ["A"])])]


def test_optimise(spark):
    dev = spark.createDataFrame([(i,) for i in range(4)], "i int")
    run = lambda p, df: df.select(F.lit(len(p)).alias("tp"), F.lit(3).alias("fp"), F.lit(1).alias("fn"))
    best = X.optimise(["a", "bb"], dev, run, lambda p, worst: [p + "x"] if len(worst) else [], rounds=2, keep=2)
    assert [p for p, _ in best] == ["bbxx", "bbx"] and best[0][1] > best[1][1]
    judged = X.accepted(dev.select(F.col("i").cast("string").alias("t")), "t", lambda t: {"valid": t == "1"} if t in "01" else "yes" if t == "2" else None)
    assert rows(judged, "t") == [("1",), ("2",)]


# requests


def test_requests_redo_and_lines(spark):
    docs = spark.createDataFrame([("f2", "b"), ("f1", "a"), ("f3", "c")], "file_name string, text string")
    asked = Q.requests(docs, ["file_name"], "sys", "text", "Read ")
    assert [json.loads(r.request)["messages"][1]["content"] for r in asked.orderBy("task_id").collect()] == ["Read ```a```", "Read ```b```", "Read ```c```"]
    turn = [0]

    def responder(df):
        turn[0] += 1
        bad = "b" if turn[0] == 1 else "none"
        return Q.respond(df, lambda t, bad=bad: {} if f"```{bad}```" in t else {"said": json.loads(t)["metadata"]["task_id"]}, attempts=1)

    store = {}
    done = Q.controlled(asked, responder, lambda df, k: store.setdefault(k, spark.createDataFrame(df.collect(), df.schema)), 2)
    assert rows(store[0], "task_id", "status") == [(0, "done"), (1, "failed"), (2, "done")] and rows(done, "task_id", "response") == [(k, json.dumps({"said": k})) for k in range(3)]
    lines = [json.loads(r.value) for r in Q.response_lines(store[0]).collect()]
    assert sorted(str(x[1]) for x in lines) == ["Failed", "{'said': 0}", "{'said': 2}"] and all(x[2]["file_name"].startswith("f") for x in lines)
    assert Q.succeeded(store[0]).count() == 2 and Q.probe(asked, lambda df: Q.respond(df, lambda t: None, attempts=1), 2)[0] is False
    assert rows(analysis.status_counts(store[0], "status"), "status", "n") == [("done", 2), ("failed", 1)]


def test_places_zip_and_bulk(spark):
    df = spark.range(100).withColumn("k", F.col("id") * 37 % 101).repartition(7)
    got = S.with_places(df, "k").orderBy("k").collect()
    assert [r.place for r in got] == list(range(100))
    both = Q.zipped(df.select("k"), spark.range(10).select(F.col("id").alias("v")), ["k"], ["v"])
    assert rows(both, "place", "v") == [(i, i) for i in range(10)]
    assert Q.bulk(df, lambda pdf: pdf[["id"]].assign(n=len(pdf)), "id long, n long", 9).agg(F.max("n")).first()[0] <= 9
    assert rows(Q.ordered_map(df.limit(0), lambda a: a, ["k"], ["id"], "long"), "place") == []
    mapped = Q.ordered_map(spark.range(3), lambda a, b: a + b, ["id"], ["id", "id"], "long")
    assert rows(mapped, "place", "result") == [(0, 0), (1, 2), (2, 4)]
    with pytest.raises(ValueError):
        Q.customised(lambda pdf: pdf, "id long", "fast")
    assert Q.customised(lambda pdf: pdf, "id long", "thread")(spark.range(3)).count() == 3
    keys, past = spark.range(5).select(F.col("id").alias("key0")), spark.createDataFrame([("0", "n")], "key string, namespace string")
    assert rows(Q.limited_keys(keys, past, "key0", "n", 2, "key0"), "key0") == [(1,)] and rows(Q.limited_keys(keys, past, "key0", "n", 2, "key0", before=False), "key0") == [(1,), (2,)]
    f = Q.counted(lambda x: x)
    f(1), f(2)
    assert f.calls == 2 and f.seconds >= 0
    texts = spark.createDataFrame([(1, 0, "first"), (1, 1, "second")], "task_id int, pos int, text string")
    assert rows(Q.verdict_texts(spark.createDataFrame([(1, True)], "task_id int, ok boolean"), texts), "text") == [("first",)]


def test_similar_requests(spark):
    texts = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")], "source string, para_id int, page_content string")
    vectors = spark.createDataFrame([("a", 0, [1.0]), ("a", 1, [2.0]), ("b", 0, [3.0])], "source string, para_id int, embedding array<float>")
    got = Q.similar_requests(vectors, texts, [1.0], "s", "", 1)
    assert [json.loads(r.request)["messages"][1]["content"] for r in got.orderBy("task_id").collect()] == ["```y```", "```z```"]


# index, sinks, sources


def test_index_upkeep(spark, tmp_path):
    store, record = f"file://{tmp_path}/store", f"file://{tmp_path}/record"
    docs = lambda *r: spark.createDataFrame(list(r), "source string, page_content string")
    update = lambda df, **o: history.update_index(spark, df, store, record, "n", F.lit("2024-01-01 00:00:00"), **o)
    assert update(docs(("a", "1"), ("a", "1"), ("a", "2"), ("b", "3"))) == {"added": 3, "updated": 0, "skipped": 0, "deleted": 0}
    assert update(docs(("a", "1"), ("a", "4"))) == {"added": 1, "updated": 0, "skipped": 1, "deleted": 1}
    assert rows(spark.read.parquet(store), "source", "page_content") == [("a", "1"), ("a", "4"), ("b", "3")]
    assert update(docs(("a", "1")), force=True, cleanup=None) == {"added": 0, "updated": 1, "skipped": 0, "deleted": 0}
    assert update(docs(("a", "1")), cleanup="full") == {"added": 0, "updated": 0, "skipped": 1, "deleted": 2}
    assert rows(spark.read.parquet(store), "source", "page_content") == [("a", "1")] and spark.read.parquet(record).count() == 1


PAGE = '<html><head><title>A study</title><p>doi: <a>10.1/x</a></p></head><body><div id="abstract"><p>Short.</p></div><div id="sections"><h2>One</h2><p>Text one.</p><table><caption>C</caption><tr><td>a</td><td>b</td></tr></table></div></body></html>'


def test_loaders_and_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text(PAGE)
    (tmp_path / "in" / "b.txt").write_text("no")
    (tmp_path / "list.json").write_text(json.dumps([f"file://{tmp_path}/in/a.html"]))
    for where in (f"file://{tmp_path}/in", f"file://{tmp_path}/list.json"):
        raw = S.article_files(spark, where)
        assert rows(raw, "source") == [("a.html",)]
    with pytest.raises(ValueError):
        S.article_files(spark, f"file://{tmp_path}/in/b.txt")
    full = S.load(raw, full_text=True).collect()
    assert [(r.type_, r.page_content) for r in full] == [("table", "C\na,b"), ("text", "Title: A study\nShort.\nOne\nText one.")]
    assert [r.sub_titles for r in S.load(raw).collect()] == ["Abstract", "One", "table"]
    assert S.full_texts(raw, include_table=False).count() == 1 and S.count_files(spark, f"file://{tmp_path}/in") == 2
    assert S.collected(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/in").count() == 1
    good, failed = sinks.parsed_articles(raw.unionByName(spark.createDataFrame([("c.pdf", "x")], "source string, content string")), lambda r: S.load(r), spark.createDataFrame([("10.1/X",)], "doi string"))
    assert good.count() == 0 and failed.count() == 0
    for p, a in (("acs", "x"), ("acs", "y"), ("rsc", "z")):
        (tmp_path / "tree" / p / a).mkdir(parents=True)
        for f in ("2.txt", "1.txt", "0.xml"):
            (tmp_path / "tree" / p / a / f).write_text(f"{a}{f}")
    tree = S.article_tree(spark, f"file://{tmp_path}/tree", 2)
    assert rows(S.first_texts(tree), "article", "content") == [("x", "x1.txt"), ("y", "y1.txt")]


def test_spreadsheet(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Title</t></si><si><t>DOI</t></si><si><r><t>10.1</t></r><r><t>/a</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>5</v></c><c r="C2" t="s"><v>2</v></c></row><row><c r="A3" t="inlineStr"><is><t>no "doi", here</t></is></c></row></sheetData></worksheet>')
    where = f"file://{tmp_path}/w.xlsx"
    assert rows(S.listed_dois(spark, where), "doi") == [("10.1/a",)]
    S.spreadsheet_to_csv(spark, where, f"file://{tmp_path}/csv")
    assert sorted(r.value for r in spark.read.text(f"file://{tmp_path}/csv").collect()) == sorted(["Title,,DOI", "5,,10.1/a", '"no ""doi"", here"'])


def test_further_sources(spark, tmp_path):
    (tmp_path / "q.csv").write_text('metal organic,"gas & air"\n')
    assert rows(S.search_queries(spark, f"file://{tmp_path}/q.csv"), "query") == [("gas+%26+air",), ("metal+organic",)]
    (tmp_path / "r.json").write_text('[{"model_name": "m"}, {"doi": "1", "x": {"y": 2}}]')
    assert [(r.pos, json.loads(r.record)) for r in S.result_records(spark, f"file://{tmp_path}/r.json").collect()] == [(1, {"doi": "1", "x": {"y": 2}})]
    (tmp_path / "c.json").write_text('{"examples": [{"a": "1", "b": "2", "c": "3"}]}')
    assert rows(S.curated_examples(spark, f"file://{tmp_path}/c.json", ["a", "b"], ["a"]), "a", "b") == [("1", "2")]
    with pytest.raises(ValueError):
        S.curated_examples(spark, f"file://{tmp_path}/c.json", ["a", "b", "c"], ["a"])
    (tmp_path / "si.csv").write_text("publisher,url\nacs,u\nacs,v\n")
    assert S.supplement_metadata(spark, f"file://{tmp_path}/si.csv").count() == 2
    vectors = spark.createDataFrame([("a", 1), (None, 2)], "source string, n int")
    assert rows(S.located(vectors, source="a"), "n") == [(1,)]
    lines = spark.createDataFrame([('{"input": "txt", "metadata": {"file_name": "f", "task_id": 3}}',)], "value string")
    got = json.loads(S.requests_from_embeddings(lines, "s", "p ").first()[0])
    assert got["messages"][1]["content"] == "p ```txt```" and got["metadata"] == {"file_name": "f", "task_id": 3}
    assert json.loads(spark.range(1).select(S.embedding_request(F.lit("t"), F.lit("f"), F.col("id"))).first()[0])["input"] == "t"


def test_further_sinks(spark, paras, tmp_path):
    t = spark.createDataFrame([("C & D", [["a", "b"], ["1", None]], ["n<"])], "c string, r array<array<string>>, n array<string>")
    html = t.select(sinks.table_html(F.col("c"), F.col("r"), F.col("n"))).first()[0]
    assert html == "<table><caption>C &amp; D</caption><tr><th>a</th><th>b</th></tr><tr><td>1</td><td></td></tr></table><p>n&lt;</p>"
    assert json.loads(t.select(sinks.table_json(F.col("c"), F.col("r"), F.col("n"))).first()[0])["footnotes"] == ["n<"]
    spans = spark.createDataFrame([("p1", 1, 0, 5, "X"), ("p1", 0, 3, 7, "Y")], "source string, para_id int, start int, end int, label string")
    got = {r.source: json.loads(r.value) for r in sinks.spans_jsonl(paras, spans).collect()}
    assert [got["p1"]["text"][s["start"] : s["end"]] for s in got["p1"]["spans"]] == ["made", "First"] and got["p3"]["spans"] == []
    m = spark.createDataFrame([("a <b> c", [(2, 5, "B")])], "t string, s array<struct<start: int, end: int, label: string>>")
    assert m.select(sinks.marked(F.col("t"), F.col("s"))).first()[0] == 'a <mark title="B">&lt;b&gt;</mark> c'
    report = sinks.label_html(paras).collect()
    assert sum(r.html.count("<p>") for r in report if r.property == "strength") == 2 and {r.property for r in report} == {"phase", "strength"}
    assert [r.html for r in report if r.property == "phase" and r.source is None] == ["<h2>phase</h2>"]
    sinks.write_label_html(paras, f"file://{tmp_path}/pages")
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/pages/property=strength").collect()][0] == "<h2>strength</h2>"
    sinks.labelled(paras, f"file://{tmp_path}/l")
    assert spark.read.parquet(f"file://{tmp_path}/l").where("labels.is_synthesis").count() == 1
    sinks.merged_records(spark.createDataFrame([("1", ["r"]), ("2", [])], "doi string, records array<string>"), "doi", "records", f"file://{tmp_path}/m")
    assert [json.loads(r.value) for r in spark.read.text(f"file://{tmp_path}/m").collect()] == [{"DOI": "1", "records": ["r"]}]
    p = spark.createDataFrame([('{"a":1}',), ("no",)], "v string").select(sinks.pretty_json(F.col("v"))).collect()
    assert json.loads(p[0][0]) == {"a": 1} and "\n" in p[0][0] and p[1][0] == "no"
    (tmp_path / "out").mkdir()
    assert sinks.rotate(spark, f"file://{tmp_path}/out", "1_2") is None
    (tmp_path / "out" / "f").write_text("x")
    assert sinks.rotate(spark, f"file://{tmp_path}/out", "1_2").endswith("temp/out_1_2") and not (tmp_path / "out").exists()
    status = spark.createDataFrame([("b", "failed"), ("a", "failed"), ("c", "done")], "key string, status string")
    assert sorted(map(tuple, sinks.status_report(status).collect()), key=str) == [("done", 1, None), ("failed", 2, None), ("failed", None, "a"), ("failed", None, "b")]
    assert sinks.filled(paras, "property_types").count() == 3 and Q.has_content(paras) and Q.write_mode(spark, f"file://{tmp_path}/l") == "append"


def test_resolution_is_whole(spark):
    data = [("p", i, "Fe Ni", "A,", ["900 C"]) for i in range(3)]
    recs = spark.createDataFrame(data, "paper string, pos int, composition string, label string, processing_kw array<string>")
    parts = spark.createDataFrame([("p", [2, 0]), ("p", [1]), ("p", [])], "paper string, members array<int>")
    assert rows(resolution.finalize(recs, parts), "comp", "label", "kw", "members") == [("FeNi", "A", ["900C"], [0, 1, 2])]
    bad = resolution.resolve(recs, lambda r: [[0, 0], [1]])[0].collect()
    assert len(bad) == 1 and bad[0].members is None and "exactly one" in bad[0].error
    cover = lambda *p: records.covers(spark.createDataFrame([("p", list(m)) for m in p], "paper string, members array<int>"), recs).first()[1]
    assert cover([0, 1], [2]) and not cover([0, 0], [1]) and not cover([0, 1], [2, 5]) and not cover([0], [1])


def test_labeled_document_needs_labels(spark):
    df = spark.createDataFrame([("x", (None,))], "page_content string, metadata struct<labels: struct<is_synthesis: boolean, property_types: array<string>>>")
    with pytest.raises(Exception, match="without labels"):
        labels.labelled_documents(df.withColumn("metadata", F.struct(F.lit("s").alias("source"), F.col("metadata.labels").alias("labels")))).collect()
    with pytest.raises(ValueError):
        labels.apply(df, [labels.Labeler("a", query=[1.0])])


def test_schemas(spark):
    assert schemas.extended(schemas.RESULT, model_name="string").names == ["document_id", "result", "model_name"]
    with pytest.raises(ValueError):
        schemas.extended(schemas.RESULT, result="string")
    for name in (n for n in dir(schemas) if n.isupper() and n not in ("T", "METADATA", "STRENGTH")):
        assert schemas.struct(getattr(schemas, name)).names


def test_f1_and_samples(spark):
    df = spark.createDataFrame([(2, 1, 1, 3), (0, 2, 3, 3)], "tp int, fp int, fn int, n int")
    assert [r.f1 for r in analysis.f1_each(df, "tp", "fp", "fn").collect()] == [0.67, 0.0]
    assert analysis.checked_counts(df, "tp", "fn", "n").count() == 2
    with pytest.raises(Exception, match="must sum"):
        analysis.checked_counts(df.withColumn("n", F.lit(9)), "tp", "fn", "n").collect()
    a = rows(analysis.seeded_sample(spark.range(100).repartition(5), 7, 3, "id"), "id")
    assert a == rows(analysis.seeded_sample(spark.range(100), 7, 3, "id"), "id") != rows(analysis.seeded_sample(spark.range(100), 7, 4, "id"), "id")
    with pytest.raises(Exception, match="no JSON"):
        spark.createDataFrame([("none",)], "t string").select(text.required_json(F.col("t"))).collect()
    offsets = spark.createDataFrame([("One two. Three? Four",)], "t string").select(text.sentence_offsets(F.col("t"))).first()[0]
    assert [(o.token, o.start) for o in offsets] == [("One two.", 0), ("Three?", 9), ("Four", 16)]
