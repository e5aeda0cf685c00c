"""Tables written on the way: what is computed once and read more than once, so that both reads see the same rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
#: Tasks for each core where rows are dealt out.
_TASKS = 4


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a temporary folder on one machine, the warehouse on several."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.folioflow"
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="folioflow-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return f"file://{_own[0]}"


def dropped_at_end(spark: SparkSession, where: str) -> None:
    """The folder goes when the session's file system closes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read back; the files go when the session's file system closes."""
    spark = df.sparkSession
    where = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    dropped_at_end(spark, where)
    df.write.parquet(where)
    return spark.read.schema(df.schema).parquet(where)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df's rows dealt by their keys over several tasks for each core: for narrow rows that cost much work each, which Spark reads in
    one task or a few where their files are small."""
    return df.repartition(_TASKS * df.sparkSession.sparkContext.defaultParallelism, *keys)
