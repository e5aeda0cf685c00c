"""Requests to a service in bulk: batches, retries, redo cycles, response lines, and what came of them."""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.articles import parse_articles
from ..sources.documents import chat_request, fenced, with_places
from .extraction import Model, retrying
from .pipeline import Pipeline, Step

FAILED = "Failed"


def requests(df: DataFrame, order: list[str], system: str, text: str, prompt: str = "", file_name: str = "file_name", model: str = "default") -> DataFrame:
    """(task_id, request): a chat request for each row, numbered in the given order."""
    rows = with_places(df, *order)
    return rows.select(F.col("place").alias("task_id"), chat_request(F.lit(system), fenced(F.lit(prompt), F.col(text)), F.col(file_name), F.col("place"), model=model).alias("request"))


def respond(asked: DataFrame, model: Model, valid: Callable[[object], bool] = bool, attempts: int = 3, batch: int = 12) -> DataFrame:
    """(task_id, request, response, status): the model on each request(task_id, request); a response that never comes or is not
    valid is "Failed". Tasks work off their rows in batches of `batch`."""

    def judged(text: str):
        got = model(text)
        if not valid(got):
            raise ValueError("not valid")
        return got

    ask = retrying(judged, attempts)

    def run(batches):
        for pdf in batches:
            for k in range(0, len(pdf), batch):
                part, rows = pdf.iloc[k : k + batch], []
                for task, request in zip(part["task_id"], part["request"], strict=True):
                    try:
                        got = ask(request)
                        rows.append((task, request, got if isinstance(got, str) else json.dumps(got, sort_keys=True), "done"))
                    except Exception:
                        rows.append((task, request, FAILED, "failed"))
                yield pd.DataFrame(rows, columns=["task_id", "request", "response", "status"])

    return asked.select("task_id", "request").mapInPandas(run, "task_id long, request string, response string, status string")


def probe(asked: DataFrame, respond_to: Callable[[DataFrame], DataFrame], n: int = 10) -> tuple[bool, DataFrame]:
    """(go on, responses to the first n requests): not, if every one of them failed."""
    first = respond_to(asked.orderBy("task_id").limit(n))
    return not first.where("status <> 'failed'").isEmpty(), first


def response_lines(done: DataFrame) -> DataFrame:
    """[request, response, metadata] as JSON lines."""
    meta = F.coalesce(F.get_json_object("request", "$.metadata"), F.lit("{}"))
    response = F.when(F.col("response") == FAILED, F.concat(F.lit('"'), "response", F.lit('"'))).when(F.json_object_keys("response").isNotNull() | F.col("response").startswith("["), F.col("response")).otherwise(F.regexp_extract(F.to_json(F.struct(F.col("response").alias("r"))), r'(?s)^\{"r":(.*)\}$', 1))
    return done.select(F.concat(F.lit("["), "request", F.lit(","), response, F.lit(","), meta, F.lit("]")).alias("value"))


def redo(done: DataFrame) -> DataFrame:
    """The requests to ask again."""
    return done.where(F.col("response") == FAILED).select("task_id", "request")


def merged(done: DataFrame, again: DataFrame) -> DataFrame:
    """done with the successes of a second round in place of the failures."""
    better = again.where(F.col("response") != FAILED)
    return done.join(better.select("task_id"), "task_id", "left_anti").unionByName(better)


def controlled(asked: DataFrame, respond_to: Callable[[DataFrame], DataFrame], store: Callable[[DataFrame, int], DataFrame], most_redo: int = 3, cool: float = 0.0, sleep=time.sleep) -> DataFrame:
    """All requests, failures asked again for up to most_redo rounds with a pause between; store writes a round and reads it
    back, so that a round is asked once and survives lost executors."""
    done = store(respond_to(asked), 0)
    for k in range(1, most_redo + 1):
        left = redo(done)
        if left.isEmpty():
            break
        if cool:
            sleep(cool)
        done = store(merged(done, respond_to(left)), k)
    return done


def succeeded(lines: DataFrame) -> DataFrame:
    """Response rows that did not fail."""
    return lines.where(F.coalesce(F.col("response"), F.lit(FAILED)) != FAILED)


def zipped(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str]) -> DataFrame:
    """Rows of a and b side by side by their places in order; the longer one's rest is left out."""
    return with_places(a, *order_a).join(with_places(b, *order_b), "place")


def verdict_texts(verdicts: DataFrame, corpus: DataFrame) -> DataFrame:
    """Verdicts with the text of their task: the first one of a task_id that comes more than once."""
    first = corpus.groupBy("task_id").agg(F.min_by("text", "pos").alias("text"))
    return verdicts.join(first, "task_id")


def similar_requests(vectors: DataFrame, texts: DataFrame, query: list[float], system: str, prompt: str, k: int = 10) -> DataFrame:
    """For every file its k chunks most similar to the query, as chat requests (task_id, request)."""
    from ..operators.labels import similar

    top = similar(texts.select("source", "para_id"), vectors, query, k)
    rows = texts.join(top, ["source", "para_id"]).withColumn("_r", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("similarity"), "para_id")))
    return requests(rows.withColumnRenamed("source", "file_name"), ["file_name", "_r"], system, "page_content", prompt)


def limited_keys(keys: DataFrame, history: DataFrame, key: str, namespace: str, n: int | None, order: str, before: bool = True) -> DataFrame:
    """The keys to work off, at most n: counted before the done ones go (before) or after."""
    from ..operators.history import not_done

    cut = lambda df: df if n is None else df.orderBy(order).limit(n)
    return not_done(cut(keys), history, key, namespace) if before else cut(not_done(keys, history, key, namespace))


def bulk(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: int = 100, partitions: int | None = None) -> DataFrame:
    """function over batches of at most `batch` rows, in `partitions` tasks at a time if that is given."""

    def run(batches):
        for pdf in batches:
            for k in range(0, len(pdf), batch):
                yield function(pdf.iloc[k : k + batch])

    return (df if partitions is None else df.repartition(partitions)).mapInPandas(run, schema)


def ordered_map(df: DataFrame, function: Callable, order: list[str], columns: list[str], kind: str) -> DataFrame:
    """df with its place in order and result: function of the columns, given one by one."""

    @F.pandas_udf(kind)
    def call(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([function(*row) for row in rows.itertuples(index=False)], dtype=object)

    return with_places(df, *order).withColumn("result", call(F.struct(*columns)))


def customised(function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, mode: str = "normal") -> Step:
    """A step of one's own. The modes of waiting (async, thread, normal) are all the tasks' business; another is an error."""
    if mode not in ("async", "thread", "normal"):
        raise ValueError(f"the mode is async, thread or normal, not {mode}")
    return lambda df: bulk(df, function, schema)


def document_chain(raw: DataFrame, *steps: Step, view: str | None = None) -> DataFrame:
    """Raw articles parsed, kept as a view if it has a name, and taken through the steps."""
    rows = parse_articles(raw)
    if view:
        rows.createOrReplaceTempView(view)
    return Pipeline(*steps)(rows)


def write_mode(spark: SparkSession, path: str, replace: bool = False) -> str:
    """append where there is something already, unless it is to be replaced."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    return "append" if there and not replace else "overwrite"


def has_content(df: DataFrame) -> bool:
    return not df.isEmpty()


def counted(function):
    """A function that knows how often it was called (calls) and how long that took in all (seconds)."""

    @functools.wraps(function)
    def call(*args, **kwargs):
        began = time.perf_counter()
        try:
            return function(*args, **kwargs)
        finally:
            call.calls, call.seconds = call.calls + 1, call.seconds + time.perf_counter() - began

    call.calls, call.seconds = 0, 0.0
    return call


def observed(df: DataFrame, name: str, status: Column) -> DataFrame:
    """df whose run reports rows and failures under a name, without another pass."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(status == "failed").alias("failed"))
