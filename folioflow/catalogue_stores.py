"""Registered queries of stores that change: vector index, keyed tables, answers asked once, history of a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalogue import query
from .catalogue_articles import _LABELLED, JUDGED, _paper
from .plans import verdicts as V
from .sources import keyed as K
from .sources import vector_index as I
from .sources.store import dropped_at_end, shared_folder
from .streaming import history as H

_BEST = (
    "p AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS s FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS r FROM p)"
)


def _folder(df: DataFrame, name: str) -> str:
    """A folder of this run beside the other intermediate tables."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    dropped_at_end(df.sparkSession, path)
    return path


def _index(t, name: str) -> tuple[I.VectorIndex, DataFrame]:
    rows = t("embeddings").select(F.col("vec_id").alias("id"), "label", "embedding")
    return I.build(rows, _folder(rows, name)), t("embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query(f"WITH {_BEST} SELECT query_id, id, CAST(r AS INTEGER) AS rank, round(s, 6) AS similarity FROM b WHERE r <= 10")
def vector_search(t):
    """The ten best of all vectors for every hundredth: all cells probed, so the answer is exact."""
    index, asked = _index(t, "search")
    return index.search(asked, 10).select("query_id", "id", "rank", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {_BEST} SELECT query_id, CAST(r AS INTEGER) AS rank, id, round(s, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS r FROM p WHERE id IN (SELECT vec_id FROM embeddings WHERE label = 3)) WHERE r <= 3"
       .replace(", b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS r FROM p)", ""))
def vector_search_within(t):
    """The three best of the vectors with one label."""
    index, asked = _index(t, "within")
    return index.search(asked, 3, where=F.col("label") == 3).select("query_id", "rank", "id", F.round("similarity", 6).alias("similarity"))


@query("SELECT count(*) AS queries, true AS enough, true AS pruned FROM embeddings WHERE vec_id % 100 = 0")
def vector_probes(t):
    """Probes tuned on other queries find at least 90 of 100 of the ten best, with cells left out."""
    index, asked = _index(t, "probes")
    probes = index.tuned(t("embeddings").where("vec_id % 10 = 5").select(F.col("vec_id").alias("query_id"), "embedding"), 10, 0.96)
    exact, found = (index.search(asked, 10, n).select("query_id", "id") for n in (None, probes))
    both = exact.join(found.withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return both.agg(F.countDistinct("query_id").alias("queries"), (F.sum("hit") >= 0.9 * F.count(F.lit(1))).alias("enough"), F.lit(probes < len(index.centres)).alias("pruned"))


@query("SELECT vec_id AS id, CASE WHEN vec_id % 50 = 1 THEN 99 ELSE label END AS label, CASE WHEN vec_id % 50 = 1 THEN -round(CAST(embedding[1] AS DOUBLE), 6) ELSE round(CAST(embedding[1] AS DOUBLE), 6) END AS first FROM embeddings WHERE vec_id % 50 <> 2")
def vector_upsert(t):
    """Vectors turned round, which moves them to other cells, and vectors taken out of the index."""
    index, _ = _index(t, "upsert")
    rows = t("embeddings").where("vec_id % 50 = 1").select(F.col("vec_id").alias("id"), F.lit(99).alias("label"), F.transform("embedding", lambda x: -x).alias("embedding"))
    index.upsert(rows, t("embeddings").where("vec_id % 50 = 2").select(F.col("vec_id").alias("id")))
    return index.located().select("id", "label", F.round(F.col("embedding")[0].cast("double"), 6).alias("first"))


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 1 THEN 'new' ELSE source END AS source, n_chars FROM documents WHERE doc_id % 7 <> 2 UNION ALL SELECT -1 - doc_id, 'added', n_chars FROM documents WHERE doc_id % 7 = 3")
def keyed_upsert(t):
    """A keyed table after rows were replaced, added and deleted, the same change made twice."""
    docs, path = t("documents").select("doc_id", "source", "n_chars"), _folder(t("documents"), "keyed")
    K.upsert(path, docs, "doc_id")
    new = docs.where("doc_id % 7 = 1").withColumn("source", F.lit("new")).unionByName(docs.where("doc_id % 7 = 3").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit("added").alias("source"), "n_chars"))
    for _ in range(2):
        K.upsert(path, new, "doc_id", gone=docs.where("doc_id % 7 = 2").select("doc_id"))
    return K.read(docs.sparkSession, path).select("doc_id", "source", "n_chars")


@query("SELECT count(*) AS n, count(DISTINCT text || coalesce(source, '')) AS ids, count(*) AS embedded FROM (SELECT DISTINCT coalesce(text, '') AS text, source FROM documents)")
def upsert_without_ids(t):
    """Documents without ids get theirs from their content, and a vector; what is equal is one row."""
    rows, path = t("documents").select(F.coalesce("text", F.lit("")).alias("page_content"), "source"), _folder(t("documents"), "ids")
    embed = lambda c: F.array(F.length(c).cast("float"))
    K.upsert(path, K.with_vectors(K.with_ids(rows, "id", "page_content", "source"), embed))
    got = K.read(rows.sparkSession, path)
    return got.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.count("embedding").alias("embedded"))


@query(f"WITH {_LABELLED} SELECT source, para_id, array_to_string(labels, ',') AS labels, is_synthesis FROM l")
def labels_asked_once(t):
    """Labels whose judgements come from models, asked in a first run about half of the papers and in a second about the rest."""
    import re

    says = lambda pattern: lambda text: bool(re.search(pattern, text))
    models = {**{name: says(pattern) for name, pattern in JUDGED.items()}, "strength": lambda text: "yes"}
    store, paras = _folder(t("conversations"), "answers"), _paper(t)
    V.label_paper_by_models(paras.where("CAST(source AS BIGINT) % 2 = 0"), models, store).count()
    return V.label_paper_by_models(paras, models, store).select("source", "para_id", F.array_join("property_types", ",").alias("labels"), "is_synthesis")


@query("SELECT lang, count(*) AS n, count(DISTINCT text) AS asked, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS words FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang")
def answers_once(t):
    """A model's answers on texts of which many are copies; asked counts the rows of the store."""
    rows, store = t("documents").where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text"), _folder(t("documents"), "once")
    got = V.ask_once(rows, "text", "words", lambda s: len(s.split(" ")), store)
    n = got.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("answer").cast("long")).alias("words"))
    kept = rows.sparkSession.read.schema(V.SCHEMA).parquet(store).select("text").join(rows.select("lang", "text").distinct(), "text").groupBy("lang").agg(F.count(F.lit(1)).alias("asked"))
    return n.join(kept, "lang").select("lang", "n", "asked", "words")


@query("SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN n_chars >= 1000 THEN 'done' ELSE 'failed' END AS state, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS results, CASE WHEN n_chars >= 1000 THEN 1 ELSE 2 END AS tries FROM documents WHERE n_chars IS NOT NULL")
def history_stream(t):
    """Keys that arrive in three files, one batch each, and a fourth with keys that were there before: a key is done once; one that
    fails is tried in two batches."""
    docs = t("documents").where("n_chars IS NOT NULL").select(F.col("doc_id").cast("string").alias("key"), "n_chars")
    spark, base = docs.sparkSession, _folder(docs, "stream")
    for k in range(3):
        docs.where(F.pmod(F.xxhash64("key"), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(f"{base}/in")
    docs.where(F.col("n_chars") >= 1000).coalesce(1).write.mode("append").parquet(f"{base}/in")
    plan = lambda rows: rows.select("key", (F.col("n_chars") * 2).alias("twice"), F.when(F.col("n_chars") < 1000, "FAILED").otherwise("OK").alias("status"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    H.run_stream(stream, plan, f"{base}/out", f"{base}/checkpoint", "key", "ns", attempts=2, status="status").awaitTermination()
    H.run_batch(docs.where("n_chars < 0"), 9, plan, f"{base}/out", "key", "ns", attempts=2, status="status")  # what the last batch has left
    done, failed, results = (H.results(spark, f"{base}/out", "ns", kind) for kind in ("done", "failed", "results"))
    lost = failed.groupBy("key").agg(F.max("tries").alias("tries")).select("key", F.lit("failed").alias("state"), "tries").join(done.select("key"), "key", "left_anti")
    rows = done.select("key", F.lit("done").alias("state"), F.lit(1).alias("tries")).unionByName(lost)
    n = results.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("results"))
    return rows.join(n, "key", "left").select("key", "state", F.coalesce("results", F.lit(0)).alias("results"), "tries")
