"""Stores that change: what a merge rewrites, what an index finds, what a model is asked, what a batch does when it runs again."""

import glob
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.plans import verdicts
from folioflow.sources import keyed, vector_index
from folioflow.streaming import history


def files(path):
    return set(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_merge_rewrites_only_the_buckets_it_hits(spark, tmp_path):
    path = str(tmp_path / "table")
    old = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    assert keyed.upsert(path, old, buckets=16) == {"added": 1000, "replaced": 0, "deleted": 0}
    before = files(path)
    change = spark.createDataFrame([(5, -1), (2000, -2), (2000, -3)], "id long, v long")
    gone = spark.createDataFrame([(7,), (9999,)], "id long")
    assert keyed.upsert(path, change, buckets=16, gone=gone, order=F.col("v")) == {"added": 1, "replaced": 1, "deleted": 1}
    hit = {r[0] for r in spark.createDataFrame([(5,), (2000,), (7,)], "id long").select(keyed.bucket("id", 16)).collect()}
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in hit}
    assert kept and kept == before & files(path)
    want = {i: 2 * i for i in range(1000)} | {5: -1, 2000: -2}
    del want[7]
    assert {r.id: r.v for r in keyed.read(spark, path).collect()} == want
    assert keyed.upsert(path, change, buckets=16, gone=gone, order=F.col("v")) == {"added": 0, "replaced": 2, "deleted": 0}
    assert {r.id: r.v for r in keyed.read(spark, path).collect()} == want


def test_merge_of_nothing_of_all_and_of_other_columns(spark, tmp_path):
    path = str(tmp_path / "table")
    keyed.upsert(path, spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), buckets=4)
    assert keyed.upsert(path, spark.createDataFrame([], "id long, v string"), buckets=4) == {"added": 0, "replaced": 0, "deleted": 0}
    with pytest.raises(Exception, match="a row without id"):
        keyed.upsert(path, spark.createDataFrame([(None, "x")], "id long, v string"), buckets=4)
    empty = spark.createDataFrame([], "id long, v string")
    assert keyed.upsert(path, empty, buckets=4, gone=spark.createDataFrame([(1,)], "id long"))["deleted"] == 1
    assert [tuple(r) for r in keyed.read(spark, path).select("id", "v").collect()] == [(2, "b")]


def test_ids_come_from_content(spark):
    rows = spark.createDataFrame([(None, "x", "s"), ("own", "x", "s"), (None, "x", "s"), (None, "x", None), (None, None, None)], "id string, page_content string, source string")
    got = [r.id for r in keyed.with_ids(rows, "id", "page_content", "source").collect()]
    assert got[1] == "own" and got[0] == got[2] and len(set(got)) == 4
    assert got == [r.id for r in keyed.with_ids(rows.repartition(1), "id", "page_content", "source").collect()]


def test_only_rows_without_a_vector_are_embedded(spark):
    asked = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<float>")
    def embed(texts):
        asked.add(len(texts))
        return texts.map(lambda t: [float(len(t))])

    rows = spark.createDataFrame([(1, "abc", [9.0]), (2, "ab", None), (3, "", None)], "id long, page_content string, embedding array<float>")
    assert {r.id: r.embedding for r in keyed.with_vectors(rows, embed).collect()} == {1: [9.0], 2: [2.0], 3: [0.0]} and asked.value == 2


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=8)).tolist(), i % 3) for i in range(1200)]
    rows += [(5000 + i, centres[0].tolist(), 0) for i in range(20)]  # equal vectors
    return spark.createDataFrame(rows + [(9000, None, 1), (9001, [1.0], 1), (9002, [None] * 8, 1)], "id long, embedding array<float>, label int")


def brute(rows, queries, k, keep=lambda r: True):
    own = [(r.id, np.array(r.embedding, float)) for r in rows if r.embedding and len(r.embedding) == 8 and None not in r.embedding and keep(r)]
    out = {}
    for q, v in queries:
        out[q] = [i for _, i in sorted((-round(float(np.dot(v, x)), 9), i) for i, x in own)[:k]]
    return out


def found(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    return got


def test_index_is_exact_with_all_cells_and_close_with_some(spark, vectors, tmp_path, monkeypatch):
    rows = vectors.where("id < 9001").collect()
    index = vector_index.build(vectors.where("id < 9001"), str(tmp_path / "index"))
    asked = [(r.id, np.array(r.embedding, float)) for r in rows if r.embedding and r.id % 40 == 0]
    queries = spark.createDataFrame([*((q, v.tolist()) for q, v in asked), (1, None), (2, [1.0])], "query_id long, embedding array<double>")
    assert found(index.search(queries, 7)) == brute(rows, asked, 7)
    monkeypatch.setattr(vector_index, "BLOCK", 8)
    monkeypatch.setattr(vector_index, "ROWS", 50)
    assert found(index.search(queries, 7)) == brute(rows, asked, 7)
    assert found(index.search(queries, 4, where=F.col("label") == 2)) == brute(rows, asked, 4, lambda r: r.label == 2)
    monkeypatch.undo()
    want = brute(rows, asked, 10)
    probes = index.tuned(queries, 10, 0.97)
    got = found(index.search(queries, 10, probes))
    hits = sum(len(set(want[q]) & set(got.get(q, ()))) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values())) and probes < len(index.centres) / 2
    plan = index.search(queries, 10, 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "cell#" in plan.split("PartitionFilters")[1].split("]")[0]
    again = vector_index.VectorIndex(spark, str(tmp_path / "index"))
    assert found(again.search(queries, 7)) == brute(rows, asked, 7)
    assert {r.id for r in again.located(label=1).collect()} == {r.id for r in rows if r.label == 1 and r.embedding}


def test_index_upsert_rewrites_the_cells_hit(spark, vectors, tmp_path):
    index = vector_index.build(vectors.where("id < 9000"), str(tmp_path / "index"))
    before = files(f"{tmp_path}/index/vectors")
    moved = vectors.where("id = 13").select("id", F.transform("embedding", lambda x: -x).alias("embedding"), F.lit(7).alias("label"))
    cells = lambda: {r.id: r.cell for r in index.vectors.select("id", "cell").collect()}
    old = cells()
    assert index.upsert(moved, spark.createDataFrame([(14,)], "id long")) == {"added": 0, "replaced": 1, "deleted": 1}
    new = cells()
    assert new.keys() == old.keys() - {14} and len(new) == index.vectors.count()
    touched = {old[13], new[13], old[14]}
    assert {f for f in before if int(f.split("cell=")[1].split("/")[0]) not in touched} == before & files(f"{tmp_path}/index/vectors")
    assert index.located(label=7).first().id == 13


def test_empty_index(spark, tmp_path):
    none = spark.createDataFrame([], "id long, embedding array<float>")
    index = vector_index.build(none, str(tmp_path / "index"))
    assert index.search(spark.createDataFrame([(1, [1.0])], "query_id long, embedding array<double>")).count() == 0


def test_each_text_is_asked_about_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def model(text):
        calls.add(1)
        if "bad" in text:
            raise ValueError("not this one")
        return len(text) % 2 == 0

    store = str(tmp_path / "answers")
    texts = ["aa", "b", "bad", None, ""] * 40
    random.Random(1).shuffle(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(7)
    for run in (1, 2):
        got = verdicts.ask_once(rows, "text", "even", model, store, attempts=2)
        answers = {(r.text, r.answer, r.error) for r in got.collect()}
        assert answers == {("aa", "True", None), ("b", "False", None), ("", "True", None), ("bad", None, "ValueError: not this one"), (None, None, None)}
        assert got.count() == len(texts)
        assert calls.value == (5 if run == 1 else 7)  # three texts and two attempts; then the one that failed, twice
    other = verdicts.ask_once(rows, "text", "even, second version", lambda s: 1, store)
    assert other.where("answer = '1'").count() == 160


def test_models_are_asked_about_candidates_only(spark, tmp_path):
    rows = [("p", 0, "t", "table", "Composition in at. %, 500 MPa"), ("p", 1, "t", "Results", "It reached 450 MPa."), ("p", 2, "t", "Methods", "It was melted."), ("p", 3, "t", "Results", "nothing")]
    paras = spark.createDataFrame(rows, "source string, para_id int, title string, sub_titles string, page_content string")
    asked = {q: spark.sparkContext.accumulator(0) for q in (*verdicts.TABLE_QUESTIONS, "strength", "synthesis")}

    def model(q, answer):
        def run(text):
            asked[q].add(1)
            return answer

        return run

    models = {q: model(q, q != "strength_table") for q in asked}
    for _ in range(2):
        got = {r.para_id: (r.property_types, r.is_synthesis) for r in verdicts.label_paper_by_models(paras, models, str(tmp_path / "a")).collect()}
        assert got == {0: (["composition", "processing_parameters"], False), 1: (["strength"], False), 2: ([], True), 3: ([], False)}
    assert {q: a.value for q, a in asked.items()} == dict.fromkeys(asked, 1)
    with pytest.raises(ValueError, match="no model for synthesis"):
        verdicts.label_paper_by_models(paras, {q: m for q, m in models.items() if q != "synthesis"}, str(tmp_path / "a"))


def plan(rows):
    return rows.select("key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"), F.when(F.col("n") > 2, "FAILED").otherwise("OK").alias("status"))


def state(spark, out):
    rows = history.results(spark, out, "ns")
    return sorted((r.key, r.i) for r in rows.collect()), sorted(r.key for r in history.results(spark, out, "ns", "done").collect())


def test_a_batch_that_runs_again_doubles_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    keys = lambda *rows: spark.createDataFrame(list(rows), "key string, n int")
    assert history.run_batch(keys(("a", 1), ("b", 2), ("a", 1), (None, 1)), 0, plan, out, "key", "ns", status="status") == {"new": 2, "again": 0, "done": 2, "failed": 0}
    want = state(spark, out)
    real, written = history._written, []

    def killed(rows, path, batch):
        written.append(path)
        if len(written) == 2:
            raise RuntimeError("killed")
        real(rows, path, batch)

    second = keys(("b", 2), ("c", 1), ("d", 3))
    monkeypatch.setattr(history, "_written", killed)
    with pytest.raises(RuntimeError):
        history.run_batch(second, 1, plan, out, "key", "ns", status="status")
    monkeypatch.undo()
    for _ in range(2):
        assert history.run_batch(second, 1, plan, out, "key", "ns", status="status") == {"new": 2, "again": 0, "done": 1, "failed": 1}
        assert state(spark, out) == (sorted([*want[0], ("c", 1)]), ["a", "b", "c"])
    assert history.run_batch(keys(), 2, plan, out, "key", "ns", attempts=2, status="status") == {"new": 0, "again": 1, "done": 0, "failed": 1}
    assert history.run_batch(keys(), 3, plan, out, "key", "ns", attempts=2, status="status") == {"new": 0, "again": 0, "done": 0, "failed": 0}
    mended = lambda rows: plan(rows.withColumn("n", F.lit(1)))
    assert history.run_batch(keys(("d", 3)), 4, mended, out, "key", "ns", attempts=2, status="status")["done"] == 1
    with pytest.raises(ValueError, match="no key of ns is left"):
        history.run_all(keys(("a", 1), ("d", 9)), plan, out, "key", "ns", status="status")
    assert history.run_all(keys(("e", 2)), plan, out, "key", "ns", status="status")["done"] == 1


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    rows = lambda *x: spark.createDataFrame(list(x), "key string, n int").coalesce(1)

    def run():
        stream = spark.readStream.schema("key string, n int").option("maxFilesPerTrigger", 1).parquet(source)
        history.run_stream(stream, plan, out, checkpoint, "key", "ns", status="status").awaitTermination()
        return state(spark, out)

    rows(("a", 1), ("f", 5)).write.parquet(source)
    assert run() == ([("a", 1)], ["a"])
    rows(("a", 1), ("b", 2)).write.mode("append").parquet(source)
    assert run() == ([("a", 1), ("b", 1), ("b", 2)], ["a", "b"])
    assert history.results(spark, out, "ns", "failed").where("key = 'f'").agg(F.max("tries")).first()[0] == 2
