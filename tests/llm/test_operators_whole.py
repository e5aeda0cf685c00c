"""Training-data operators on inputs of which they once did a part."""

import inspect

import pandas as pd
import pytest

from folioflow.llm import mixing, secrets, token_files
from folioflow.llm.common import Workspace


def test_secret_parts_link_in_the_whole_scope(spark):
    weak, secret = "AKIAABCDEFGHIJ", "aB3dEfGhIjKlMnOpQrStUvWxYz0"
    cases = [(1, f"{weak} {'x ' * 5000}{secret} {'y ' * 5000}https://a.example.com/x"), (2, f"{weak} {'x ' * 5000}\n\n{secret}")]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    assert got[1] == "weak_access:0:14,weak_secret:10015:10042,endpoint:20043:20066"
    assert got[2] == ""


def test_both_raking_paths_stop_alike_and_say_so(spark, monkeypatch):
    slow = pd.DataFrame([("a", "x", 1, 1000), ("a", "y", 1, 1), ("b", "x", 1, 1), ("b", "y", 1, 1000)], columns=[*mixing.DIMS, "tokens"])
    goals = {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}, "topic": {1: 1.0}}
    with pytest.warns(RuntimeWarning, match="after 2 sweeps"):
        want = mixing.rake(slow, goals, sweeps=2, budget=1000.0)
    cells = spark.createDataFrame(slow, "source string, lang string, topic int, tokens long")
    tables = {d: spark.createDataFrame(list(g.items()), f"{d} {'int' if d == 'topic' else 'string'}, goal double") for d, g in goals.items()}
    with pytest.warns(RuntimeWarning, match="after 2 sweeps"):
        got = mixing._rake_in_cluster(cells, tables, 1000.0, Workspace(spark, "rake-test"), sweeps=2, tol=1e-10).toPandas()
    assert got.sort_values(["source", "lang"]).mass.tolist() == pytest.approx(want.tolist())

    used = {}

    def spy(*args, **more):
        bound = inspect.signature(real).bind(*args, **more)
        bound.apply_defaults()
        used.update(bound.arguments)
        return real(*args, **more)

    real = mixing._rake_in_cluster
    monkeypatch.setattr(mixing, "_rake_in_cluster", spy)
    docs = spark.createDataFrame([(1, "one two", "en", "s"), (2, "three", "de", "t")], "doc_id long, text string, lang string, source string")
    assert mixing.mixture(docs, driver_cells=0).count() == 2
    own = inspect.signature(mixing.rake).parameters
    assert (used["sweeps"], used["tol"]) == (own["sweeps"].default, own["tol"].default)


def test_documents_without_an_id_are_written(spark, tmp_path):
    rows = [(3, "three words here"), (None, "no id"), (-5, "before"), (None, None), (0, "zero"), (None, "also none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_files.token_output(docs, str(tmp_path / "ids")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, None, -5, 0, 3]
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(6)] and got[0].n_tokens == 1
