"""Paragraph retrieval by words: an inverted index of terms, BM25 ranking within papers and their sections, phrases, and the
fusion of rankings.

Everything is an equi-join on terms and an aggregation that combines map-side: a term that a third of all paragraphs hold adds
rows to the tasks that hold its postings, and no paragraph meets another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.keyed import bucket
from .labels import RESULT

#: Fixed values of the ranking: saturation of counts, weight of lengths; and of the fusion.
K1, B, RANK_SHIFT = 1.2, 0.75, 60
BUCKETS = 64
#: Query terms up to here are broadcast.
FEW = 100_000
_KEY = ["source", "para_id"]


def terms(text: Column) -> Column:
    """The words of a text in order: letters and digits of any script, lower-cased."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def postings(paras: DataFrame, text: str = "page_content") -> DataFrame:
    """(term, source, para_id, n, n_terms, positions): the words of every paragraph with their places, counted from 0."""
    words = paras.select(*_KEY, terms(F.col(text)).alias("_t")).select(*_KEY, F.size("_t").alias("n_terms"), F.posexplode("_t").alias("_at", "term"))
    got = words.groupBy("term", *_KEY, "n_terms").agg(F.array_sort(F.collect_list("_at")).alias("positions"))  # as many as the paragraph has
    return got.select("term", *_KEY, F.size("positions").alias("n"), "n_terms", "positions")


def write_index(paras: DataFrame, path: str, text: str = "page_content") -> None:
    """The postings by bucket of the term, and the numbers that ranking needs: paragraphs with words and their mean length."""
    found = postings(paras, text).withColumn("bucket", bucket("term", BUCKETS))
    found.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    # The mean over all paragraphs that have words; each is counted at its first word.
    at_first = F.array_contains("positions", 0)
    spark = paras.sparkSession
    own = spark.read.parquet(f"{path}/postings").where(at_first)
    own.agg(F.count(F.lit(1)).alias("paragraphs"), F.avg("n_terms").alias("mean")).write.mode("overwrite").parquet(f"{path}/lengths")


def _asked(spark: SparkSession, path: str, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms of the queries, their postings): only the buckets of these terms are read."""
    wanted = queries.select("query_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    buckets = [r[0] for r in wanted.select(bucket("term", BUCKETS)).distinct().collect()]  # BUCKETS at most
    found = spark.read.parquet(f"{path}/postings")
    return (F.broadcast(wanted) if wanted.count() <= FEW else wanted), found.where(F.col("bucket").isin(buckets))


def bm25(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, within: DataFrame | None = None, per: str | None = "source") -> DataFrame:
    """(query_id, source, para_id, score, rank): the k best paragraphs of each source (of all with per=None) for queries(query_id,
    text) that share a word with it, ties by source and para_id.

    within(source, para_id) restricts what is ranked; how rare a word is, and how long paragraphs are, counts all of the index.
    """
    wanted, found = _asked(spark, path, queries)
    lengths = spark.read.parquet(f"{path}/lengths")
    total, mean = (lengths.select(c).scalar() for c in ("paragraphs", "mean"))
    asked = wanted.select("term").distinct()
    rare = found.join(asked, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rare = rare.select("term", F.log1p((total - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    hits = found.select("term", *_KEY, "n", "n_terms").join(wanted.join(rare, "term"), "term")
    if within is not None:
        hits = hits.join(within.select(*_KEY).distinct(), _KEY, "left_semi")
    share = F.col("idf") * F.col("n") * (K1 + 1) / (F.col("n") + K1 * (1 - B + B * F.col("n_terms") / mean))
    scored = hits.groupBy("query_id", *_KEY).agg(F.round(F.sum(share), 9).alias("score"))
    return ranked(scored, k, per)


def ranked(scored: DataFrame, k: int, per: str | None = "source", score: str = "score") -> DataFrame:
    best = Window.partitionBy("query_id", *([per] if per else [])).orderBy(F.desc(score), *_KEY)
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def phrases(spark: SparkSession, path: str, queries: DataFrame) -> DataFrame:
    """(query_id, source, para_id, n): where the words of a query stand one after the other, and how often."""
    words = queries.select("query_id", F.posexplode(terms(F.col("text"))).alias("_i", "term"), F.size(terms(F.col("text"))).alias("_m"))
    _, found = _asked(spark, path, queries)
    starts = found.join(words, "term").select("query_id", *_KEY, "_m", "_i", F.explode("positions").alias("_at")).groupBy("query_id", *_KEY, "_m", (F.col("_at") - F.col("_i")).alias("_start"))
    return starts.agg(F.count(F.lit(1)).alias("_n")).where("_n = _m").groupBy("query_id", *_KEY).agg(F.count(F.lit(1)).alias("n"))


def sections(paras: DataFrame, pattern: str = RESULT, titles: str = "sub_titles") -> DataFrame:
    """(source, para_id) under titles that match; all of a source that has no such title."""
    inside = F.coalesce(F.col(titles).rlike(pattern), F.lit(False))
    has = paras.where(inside).select("source").distinct()
    return paras.where(inside).select(*_KEY).unionByName(paras.join(has, "source", "left_anti").select(*_KEY))


def fused(k: int, *rankings: DataFrame, per: str | None = "source") -> DataFrame:
    """(query_id, source, para_id, score, rank) of several rankings(query_id, source, para_id, rank) together: a paragraph's score is
    the sum of 1 / (RANK_SHIFT + rank) over those that have it."""
    every = None
    for r in rankings:
        own = r.select("query_id", *_KEY, (1 / (F.lit(RANK_SHIFT) + F.col("rank"))).alias("_s"))
        every = own if every is None else every.unionByName(own)
    return ranked(every.groupBy("query_id", *_KEY).agg(F.round(F.sum("_s"), 9).alias("score")), k, per)


def retrieve(spark: SparkSession, path: str, paras: DataFrame, queries: DataFrame, vectors: DataFrame | None = None, k: int = 3, pattern: str | None = RESULT) -> DataFrame:
    """The k paragraphs of each source that answer each of queries(query_id, text, and with vectors an embedding): ranked by words
    and, with vectors(source, para_id, embedding), by similarity, both fused, in the sections that the pattern finds."""
    from .labels import similar

    within = sections(paras, pattern) if pattern else paras.select(*_KEY)
    words = bm25(spark, path, queries.select("query_id", "text"), 10 * k, within)
    if vectors is None:
        return ranked(words.drop("rank"), k)
    near = None
    for q in queries.select("query_id", "embedding").collect():  # questions to the papers, written by hand
        own = similar(paras.join(within, _KEY, "left_semi"), vectors, q["embedding"], 10 * k).select(F.lit(q["query_id"]).alias("query_id"), *_KEY, "similarity")
        near = own if near is None else near.unionByName(own)
    return fused(k, words, ranked(near, 10 * k, score="similarity"))
