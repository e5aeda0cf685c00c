"""Incremental work: extraction history, and the index that only stores what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_uuid


def not_done(keys: DataFrame, history: DataFrame, key: str, namespace: str) -> DataFrame:
    """Keys without an entry in the namespace."""
    return keys.join(history.where(F.col("namespace") == namespace).select(F.col("key").alias(key)), key, "left_anti")


def done_flags(keys: DataFrame, history: DataFrame, key: str, namespace: str) -> DataFrame:
    seen = history.where(F.col("namespace") == namespace).select(F.col("key").alias("_k")).distinct()
    return keys.join(seen, F.col(key) == F.col("_k"), "left").withColumn("done", F.col("_k").isNotNull()).drop("_k")


def record_done(keys: DataFrame, key: str, namespace: str, status: str | None = None) -> DataFrame:
    """History rows to append: failed keys are left out, keys without a result are kept."""
    rows = keys.where(F.col(status) != "FAILED") if status else keys
    return rows.select(F.col(key).cast("string").alias("key"), F.lit(namespace).alias("namespace"))


def hashed(docs: DataFrame, text: str, order: str) -> DataFrame:
    """First row of each distinct text, with its uid; rows are combined where they are read, so copies gather in no task."""
    keyed = docs.select(content_uuid(F.col(text)).alias("uid"), F.struct(*docs.columns).alias("_row"), F.col(order).alias("_o"))
    return keyed.groupBy("uid").agg(F.min_by("_row", "_o").alias("_row")).select("_row.*", "uid")


def index_diff(new: DataFrame, old: DataFrame, cleanup: str | None = "incremental", source: str = "source") -> DataFrame:
    """(uid, source, action) of new(uid, source) against old(uid, source): added, skipped, and deleted - of all sources (full), of the sources seen in new (incremental) or none (None)."""
    a, b = new.select("uid", F.col(source).alias("s1")), old.select(F.col("uid").alias("uid2"), F.col(source).alias("s2"))
    both = a.join(b, F.col("uid") == F.col("uid2"), "full")
    rows = both.select(F.coalesce("uid", "uid2").alias("uid"), F.coalesce("s1", "s2").alias(source), F.when(F.col("uid2").isNull(), "added").when(F.col("uid").isNotNull(), "skipped").otherwise("deleted").alias("action"))
    if cleanup is None:
        return rows.where("action <> 'deleted'")
    if cleanup == "full":
        return rows
    seen = new.select(F.col(source).alias("_s")).distinct()
    return rows.join(seen, F.col(source) == F.col("_s"), "left").where("action <> 'deleted' OR _s IS NOT NULL").drop("_s")


def index_counts(diff: DataFrame) -> DataFrame:
    """added, updated, skipped and deleted of a diff."""
    return diff.agg(*(F.count_if(F.col("action") == a).alias(a) for a in ("added", "updated", "skipped", "deleted")))


def update_index(spark: SparkSession, docs: DataFrame, store: str, record: str, namespace: str, now: Column, cleanup: str | None = "incremental", force: bool = False, text: str = "page_content", source: str = "source") -> dict[str, int]:
    """Bring a store of documents and its record (Parquet folders) up to docs(source, page_content, ...); the counts of what was done.

    Equal texts of a source are one. Texts the record has are skipped - their time is renewed - or, with force, written
    again (updated). What is gone goes: of all sources (full), of the sources in docs (incremental), or nothing (None).
    The new store is written beside the old before its record, and both are swapped by name, so a run that dies leaves
    the old ones or can be run again.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(store).getFileSystem(spark._jsc.hadoopConfiguration())
    new = docs.withColumn("uid", content_uuid(F.concat_ws("|", F.col(source), F.col(text)))).dropDuplicates(["uid"])
    there = fs.exists(fs_path(record))
    schema = f"uid string, {source} string, namespace string, updated_at timestamp"
    old = spark.read.schema(schema).parquet(record) if there else spark.createDataFrame([], schema)
    own = old.where(F.col("namespace") == namespace)
    diff = index_diff(new.select("uid", source), own, cleanup, source)
    if force:
        diff = diff.withColumn("action", F.when(F.col("action") == "skipped", "updated").otherwise(F.col("action")))
    counts = index_counts(diff).first().asDict()
    gone = diff.where("action = 'deleted'").select("uid")
    changed = new.join(diff.where("action IN ('added', 'updated')").select("uid"), "uid", "left_semi")
    kept = spark.read.parquet(store) if fs.exists(fs_path(store)) else None
    rows = changed if kept is None else kept.join(gone, "uid", "left_anti").join(changed.select("uid"), "uid", "left_anti").unionByName(changed, allowMissingColumns=True)
    seen = new.select("uid", source, F.lit(namespace).alias("namespace"), now.cast("timestamp").alias("updated_at"))
    records = old.where(F.col("namespace") != namespace).unionByName(own.join(gone, "uid", "left_anti").join(seen.select("uid"), "uid", "left_anti")).unionByName(seen)
    for path, df in ((store, rows), (record, records)):
        df.write.mode("overwrite").parquet(f"{path}.new")
    for path in (store, record):
        fs.delete(fs_path(path), True)
        fs.rename(fs_path(f"{path}.new"), fs_path(path))
    return counts


def build_index(spark: SparkSession, raw: DataFrame, load, store: str, embed=None) -> None:
    """Articles loaded (sections or full texts) and written: as vectors where there is an embedding, else as plain documents,
    which a second run adds again."""
    rows = load(raw).where("error IS NULL").drop("error")
    if embed is not None:
        rows = rows.withColumn("embedding", embed(F.col("page_content")))
    rows.write.mode("append").parquet(store)
