"""Incremental indexing as a stream: files that arrive are hashed and only unseen texts reach the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import content_uuid


def unseen(stream: DataFrame, text: str = "page_content") -> DataFrame:
    """Rows whose text has not come before; the hashes seen are the query's state."""
    return stream.withColumn("uid", content_uuid(F.col(text))).dropDuplicates(["uid"])


def index_stream(stream: DataFrame, out: str, checkpoint: str, text: str = "page_content") -> StreamingQuery:
    """Append unseen rows to Parquet at out; with the checkpoint every row arrives once."""
    return unseen(stream, text).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
