"""Runs over keys that arrive as a stream, each key done once.

A batch of keys goes through a plan; its results, the keys done and the keys that failed lie under the batch's number, so a batch
that was killed and runs again writes over what it had written. Keys that failed come again with the batches after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import Step
from ..sources.keyed import exists
from ..sources.store import stored

#: A batch of so many keys at most is sent to the history's tasks; a larger one is joined by shuffle.
FEW = 100_000


def _earlier(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """What batches before this one have written."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").parquet(path).where(F.col("batch") < batch)


def _written(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def run_batch(keys: DataFrame, batch: int, plan: Step, out: str, key: str, namespace: str, attempts: int = 3, status: str | None = None, few: int = FEW) -> dict[str, int]:
    """Run the plan over the rows of keys whose key is not done in the namespace, and over those that have failed in fewer than
    `attempts` batches; the counts of keys that were new, came again, were done and failed.

    plan gives any number of rows for a key, all with the key column; with status, a key with a row that says FAILED has failed and
    has no results. Under out: results/, done/ and failed/ by batch. Of equal keys in a batch the first by all columns counts, rows
    without a key are left out. Batches must come in the order of their numbers; a number that comes again replaces itself and
    sees what it saw before.
    """
    spark = keys.sparkSession
    base = f"{out}/{namespace}"
    own = F.col(key).cast("string")
    rows = keys.where(F.col(key).isNotNull()).withColumn("_k", own)
    first = rows.groupBy("_k").agg(F.min(F.to_json(F.struct(*keys.columns), {"ignoreNullFields": "false"})).alias("row"), F.lit(0).alias("tries"))
    # The last batch's list of failed keys has those that failed before it, too.
    failed = _earlier(spark, f"{base}/failed", "key string, row string, tries int", batch)
    last = failed.agg(F.max("batch")).first()[0]
    again = failed.where((F.col("batch") == last) & (F.col("tries") < attempts)) if last is not None else failed
    again = again.select(F.col("key").alias("_k"), "row", "tries")
    todo = again.unionByName(first.join(again.select("_k"), "_k", "left_anti"))
    todo = stored(todo, "batch-keys")
    n = todo.count()
    history = _earlier(spark, f"{base}/done", "key string, namespace string", batch).select(F.col("key").alias("_k"))
    sent = todo.select("_k")
    seen = history.join(F.broadcast(sent) if n <= few else sent, "_k", "left_semi").distinct()
    todo = stored(todo.join(seen, "_k", "left_anti"), "batch-todo")
    asked = todo.select("_k", F.from_json("row", keys.schema).alias("_row")).select("_row.*")
    result = stored(plan(asked), "batch-results")
    bad = result.where(F.col(status) == "FAILED").select(own.alias("_k")).distinct() if status else result.limit(0).select(own.alias("_k"))
    still = todo.join(bad, "_k", "left_semi").select(F.col("_k").alias("key"), "row", (F.col("tries") + 1).cast("int").alias("tries"))
    given_up = failed.where((F.col("batch") == last) & (F.col("tries") >= attempts)).select("key", "row", "tries") if last is not None else still.limit(0)
    good = todo.join(bad, "_k", "left_anti")
    _written(result.withColumn("_k", own).join(bad, "_k", "left_anti").drop("_k"), f"{base}/results", batch)
    _written(still.unionByName(given_up.join(still.select("key"), "key", "left_anti")), f"{base}/failed", batch)
    _written(good.select(F.col("_k").alias("key"), F.lit(namespace).alias("namespace")), f"{base}/done", batch)
    tried = todo.agg(F.count_if(F.col("tries") == 0), F.count_if(F.col("tries") > 0)).first()
    return {"new": tried[0], "again": tried[1], "done": good.count(), "failed": still.count()}


def results(spark: SparkSession, out: str, namespace: str, kind: str = "results") -> DataFrame:
    """What all batches have written: results, done, or failed (as of each batch)."""
    return spark.read.parquet(f"{out}/{namespace}/{kind}")


def run_stream(stream: DataFrame, plan: Step, out: str, checkpoint: str, key: str, namespace: str, attempts: int = 3, status: str | None = None, **trigger) -> StreamingQuery:
    """run_batch() for each batch of a stream of keys; with the checkpoint every key comes once, and once is how often it is done."""
    sink = stream.writeStream.foreachBatch(lambda df, batch: run_batch(df, batch, plan, out, key, namespace, attempts, status) and None)
    return sink.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def run_all(keys: DataFrame, plan: Step, out: str, key: str, namespace: str, attempts: int = 3, status: str | None = None) -> dict[str, int]:
    """run_batch() of a table of keys as the batch after the last; an error when no key is left to do."""
    spark, base = keys.sparkSession, f"{out}/{namespace}"
    last = spark.read.parquet(f"{base}/done").agg(F.max("batch")).first()[0] if exists(spark, f"{base}/done") else None
    counts = run_batch(keys, 0 if last is None else last + 1, plan, out, key, namespace, attempts, status)
    if not counts["new"] + counts["again"]:
        raise ValueError(f"no key of {namespace} is left to do")
    return counts

