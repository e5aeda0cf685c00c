"""Steps whose work must grow with their input, on inputs that are large for a test."""

import re
import time
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import catalogue, catalogue_flows, catalogue_plans  # noqa: F401
from folioflow.functions import text, tokens
from folioflow.plans import models
from folioflow.sources import articles, vector_index

from .test_catalogue import DATA


def test_word_offsets_of_a_long_text(spark):
    own = " ".join(f"wörd{k}, a-b" for k in range(40_000)) + "\x0bend😀.".encode("utf-16", "surrogatepass").decode("utf-16")
    docs = spark.createDataFrame([(0, own), (1, None), (2, " ")], "id int, t string").withColumn("w", text.word_offsets(F.col("t")))
    began = time.perf_counter()
    got = {r.id: r for r in docs.select("id", "w", text.stand_in_place(F.col("t"), F.col("w")).alias("exact")).collect()}
    assert time.perf_counter() - began < 30
    want = [(m[0], m.start()) for m in re.finditer(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\f\r]", own)]
    assert [(w.token, w.start) for w in got[0].w] == want
    assert got[0].exact and got[1].w is None and got[1].exact and got[2].w == [] and got[2].exact


def test_words_out_of_place(spark):
    place = "array<struct<token: string, start: int>>"
    rows = spark.createDataFrame([(0, "ab c", [("ab", 0), ("c", 3)]), (1, "ab c", [("ab", 0), ("c", 2)]), (2, "ab c", [("ab", 0), ("d", 3)]), (3, "ab c", [("ab", 0)]), (4, "ab c", [("ab", 1), ("c", 3)])], f"id int, t string, w {place}")
    got = dict(rows.select("id", text.stand_in_place(F.col("t"), F.col("w"))).collect())
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False}


@pytest.mark.parametrize("name", ["full_text_rows", "publisher_xml"])
def test_pages_of_a_small_file_are_read_in_several_tasks(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).select(F.spark_partition_id()).distinct().count() > 4


@pytest.mark.parametrize("name", ["publisher_layouts", "table_forms"])
def test_pages_that_are_joined_are_read_in_several_tasks(spark, name):
    plan = catalogue.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Repartition" in below[: below.index("Relation")]


def test_a_worker_holds_the_rows_of_few_files():
    class Raw:
        def mapInArrow(self, run, schema):
            return list(run(iter([pa.RecordBatch.from_pydict({"source": [str(k) for k in range(1000)], "content": ["x"] * 1000})])))

    def read(source, content):
        if source == "7":
            raise ValueError("seven")
        return [(source, 0, None), (source, 1, None)]

    got = articles.read_files(Raw(), "source string, pos int, error string", read, lambda source, _, error: (source, None, error))
    assert len(got) > 4 and max(b.num_rows for b in got) <= 256
    rows = [r for b in got for r in b.to_pylist()]
    assert len(rows) == 1999 and [r for r in rows if r["error"]] == [{"source": "7", "pos": None, "error": "ValueError: seven"}]


def test_a_search_holds_only_the_best():
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(size=(5000, 16)) * 2)  # many equal products
    asked = np.round(rng.normal(size=(1024, 16)) * 2)
    peak = []

    class Rows:
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("cell", T.IntegerType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            batches = [pa.RecordBatch.from_pydict({"id": pa.array(range(a, a + 2500), pa.int64()), "cell": pa.array([0] * 2500, pa.int32()), "embedding": pa.array(list(vectors[a : a + 2500]))}) for a in (0, 2500)]
            tracemalloc.start()
            out = list(run(iter(batches)))
            peak.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            return pa.Table.from_batches(out)

    class Session:
        read = SimpleNamespace(parquet=lambda path: Rows())
        sparkContext = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))

    index = vector_index.VectorIndex(Session(), "", centres=np.zeros((1, 16)))
    got = index._block(pa.table({"query_id": pa.array(range(1024), pa.int64()), "q": pa.array(list(asked))}), 10, None, None).to_pydict()
    score = asked @ vectors.T
    want = {(q, int(i)) for q in range(1024) for i in np.lexsort((np.arange(5000), -score[q]))[:10]}
    assert set(zip(got["query_id"], got["id"], strict=True)) == want and len(got["id"]) == 10 * 1024
    assert peak[0] < 60e6


def test_a_worker_encodes_a_word_once(monkeypatch):
    import public_tokenizers

    path, asked = public_tokenizers.path("byte_bpe_50k.json"), []
    texts = ["The naïve word, it's here:\nnext line!\n\nAnd  two blanks ... 3,14 e.g.\n x\n", "", "Größe;ß.\n a b,c ́.", "word" * 40 + ", end."]
    want = [len(tokens.tokenizer(path).encode(t, add_special_tokens=False).ids) for t in texts]
    encoded = tokens._encoded
    monkeypatch.setattr(tokens, "_encoded", lambda fresh, own: asked.extend(fresh) or encoded(fresh, own))
    tokens._sizes(path).clear()
    for _ in range(3):  # batches
        assert tokens.counts(texts, path).tolist() == want
    short = [a for a in asked if len(a) <= 64]
    assert len(short) == len(set(short)) and " word," in short and all(len(a) <= 64 for a in tokens._sizes(path))


def test_a_text_is_embedded_in_one_product(monkeypatch):
    calls, log = [], np.log
    docs = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))))
    monkeypatch.setattr(models, "word_weights", lambda docs, text: np.ones(1 << 16, np.float32))
    monkeypatch.setattr(models.F, "pandas_udf", lambda kind: lambda f: f)
    monkeypatch.setattr(models, "_REMEMBERED", 4)
    embed = models.learned_embedder(docs, "t", 8)
    monkeypatch.setattr(models.np, "log", lambda x: calls.append(1) or log(x))
    own = ["a b a", "c d e", "f g h i j k", "", None, "b a a"]
    got = np.array(next(embed(iter([pd.Series(own)]))).tolist())
    assert len(calls) <= len(own)
    for text_, v in zip(own, got, strict=True):
        total = sum(((1 + log(n)) * models._signs(w, 8) for w, n in Counter((text_ or "").split()).items()), np.zeros(8))
        assert np.allclose(v, total / (np.linalg.norm(total) or 1), atol=1e-6)
