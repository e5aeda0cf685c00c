"""Keyed Parquet tables that change by rewriting only the partitions a change touches.

A table is a folder partitioned by one column (its place): a hash bucket of the key, or anything else that a row's content
decides. A merge reads the places that hold an incoming key or get one, puts the new rows in, and overwrites just these
partitions; the files of all others stay as they are. Running the same merge twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import content_uuid
from .store import stored

BUCKETS = 64


def bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def with_ids(rows: DataFrame, key: str, *content: str) -> DataFrame:
    """rows with an id for each that has none: a UUID of its content, so that a task that runs twice makes the same one and
    equal rows without an id are one row."""
    made = content_uuid(F.to_json(F.struct(*(F.col(c) for c in content))))
    if key not in rows.columns:
        return rows.withColumn(key, made)
    if rows.schema[key].dataType.simpleString() != "string":
        return rows  # ids that are numbers must be given
    return rows.withColumn(key, F.coalesce(key, made))


def with_vectors(rows: DataFrame, embed: Callable[[Column], Column], text: str = "page_content", column: str = "embedding") -> DataFrame:
    """rows with an embedding for each that has none; only those go through the model."""
    if column not in rows.columns:
        return rows.withColumn(column, embed(F.col(text)))
    bare = rows.where(F.col(column).isNull())
    return rows.where(F.col(column).isNotNull()).unionByName(bare.withColumn(column, embed(F.col(text)).cast(rows.schema[column].dataType)))


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _files(spark, path)
    return fs.exists(at) and len(fs.listStatus(at)) > 0


def _write(rows: DataFrame, path: str, place: str, mode: str = "overwrite") -> None:
    """Each place's rows in files of about the advisory partition size, however many rows one place has."""
    rows.hint("rebalance", place).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(place).parquet(path)


def newest(rows: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """One row of each key: the last by `order`, then by all columns."""
    keys = [*([order] if order is not None else []), *(F.col(c).cast("string") for c in rows.columns)]
    last = Window.partitionBy(key).orderBy(*(k.desc_nulls_last() for k in keys))
    return rows.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def merge(path: str, new: DataFrame, key: str, place: str, gone: DataFrame | None = None, moves: bool = True, order: Column | None = None) -> dict[str, int]:
    """Put new rows (with their place) into the table at path, in place of rows of the same key, and take out the keys of
    gone(key); counts of rows added, replaced and deleted.

    Of several new rows of a key the last counts (see newest); a key that is also in gone goes. Rows without a key are an error.
    With moves, a key may have another place than before, and the old places are looked up by key, which reads only the key and
    no other column; without, the place is a function of the key. Columns that only one side has are null on the other.
    """
    spark = new.sparkSession
    bare = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a row without {key}"))).otherwise(F.col(key))
    incoming = newest(new.withColumn(key, bare), key, order)
    if gone is not None:
        incoming = incoming.join(gone.select(key).distinct(), key, "left_anti")
    incoming = stored(incoming, "merge-new")
    if not exists(spark, path):
        _write(incoming, path, place)
        return {"added": incoming.count(), "replaced": 0, "deleted": 0}
    old = spark.read.parquet(path)
    changed = incoming.select(key, place)
    if gone is not None:
        # Where the place is no function of the key, a deleted key's place is found below.
        changed = changed.unionByName(gone.select(key).distinct().withColumn(place, F.lit(None).cast(old.schema[place].dataType)))
    keys = stored(changed, "merge-keys")
    if moves or gone is not None:
        held = old.select(key, F.col(place).alias("_old")).join(keys.select(key), key, "left_semi").select("_old")
        held = held.unionByName(incoming.select(F.col(place).cast(old.schema[place].dataType).alias("_old")))
    else:
        held = incoming.select(F.col(place).cast(old.schema[place].dataType).alias("_old"))
    touched = [r[0] for r in held.distinct().collect()]  # places, of which a table has thousands at most
    inside = old.where(F.col(place).isin(touched)) if touched else old.limit(0)
    dropped = inside.select(key).join(keys.select(key), key, "left_semi")
    replaced = dropped.join(incoming.select(key), key, "left_semi").count()
    deleted = dropped.join(incoming.select(key), key, "left_anti").count()
    rows = stored(inside.join(keys.select(key), key, "left_anti").unionByName(incoming, allowMissingColumns=True), "merge-rows")
    left = {r[0] for r in rows.select(place).distinct().collect()}
    _write(rows, path, place)
    at, fs = _files(spark, path)
    for value in touched:  # a partition without rows is not overwritten
        if value not in left:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{place}={value}"), True)
    return {"added": incoming.count() - replaced, "replaced": replaced, "deleted": deleted}


def upsert(path: str, new: DataFrame, key: str = "id", buckets: int = BUCKETS, gone: DataFrame | None = None, order: Column | None = None) -> dict[str, int]:
    """merge() into a table whose rows lie in hash buckets of their key; a table keeps the number of buckets it began with."""
    spot = lambda df: df.withColumn("bucket", bucket(key, buckets))
    return merge(path, spot(new), key, "bucket", gone, moves=False, order=order)


def read(spark: SparkSession, path: str, place: str = "bucket") -> DataFrame:
    return spark.read.parquet(path).drop(place)
