"""The pipeline's stages on the smallest tables, each against brute force or its operator's SQL."""

import duckdb
import pytest

import corpus_pipeline
from folioflow.llm import decontaminate, toxicity

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        where = f"file://{tmp_path_factory.mktemp('p')}/{name}"
        stage(spark, docs, DATA).write.parquet(where)
        docs = spark.read.parquet(where)
        out.append(docs)
    return out


def test_stages(spark, stages):
    from tests.llm.test_operators import brute_near

    assert all(d.columns == corpus_pipeline.COLUMNS for d in stages[1:-1])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:-1], strict=False)) and ids[-1] == ids[-2]
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(stages[0], spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
    assert ids[1] == {i for i in ids[0] if not scores[i]}
    near = brute_near({r.doc_id: r.text for r in stages[1].collect()})
    assert ids[2] == {i for i, v in near.items() if v[2]}
    con = duckdb.connect()
    con.register("documents", stages[2].select("doc_id", "text").toPandas())
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{DATA}/benchmark.parquet'")
    clean = con.execute(f"SELECT doc_id FROM ({decontaminate.ORACLE}) WHERE NOT contaminated").fetchall()
    assert ids[3] == {r[0] for r in clean}
    last = stages[-1].orderBy("doc_id").collect()
    assert [r.start for r in last] == [sum(x.n_tokens for x in last[:k]) for k in range(len(last))]
