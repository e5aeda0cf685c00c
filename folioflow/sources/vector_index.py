"""A vector store with an inverted-file index: vectors lie in cells, a search reads the cells nearest to its queries.

Cells are the clusters of k-means over a bounded sample; they are the partitions of a Parquet table, so a probe of some cells
is a scan of some partitions. A search takes queries in blocks: each task multiplies its vectors with the queries that probe
their cell and hands on the best k of each query; these meet in one ranking. With all cells probed the result is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.documents import with_places
from . import keyed
from .store import stored

#: Cells at most, sampled vectors a cell for k-means, queries of a block, vectors multiplied at once.
CELLS, SAMPLE, BLOCK, ROWS = 4096, 256, 1024, 512


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(rows: DataFrame, column: str, dims: int | None = None) -> DataFrame:
    """Rows whose vector is whole and, where dims is given, of that length."""
    x = F.col(column)
    rows = rows.where(x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)))
    return rows if dims is None else rows.where(F.size(x) == dims)


def cell_centres(rows: DataFrame, column: str, key: str, cells: int | None = None, seed: int = 7) -> np.ndarray:
    """Centres of at most `cells` clusters (the root of the number of vectors if not given) of the SAMPLE * cells vectors whose
    keys have the smallest hashes."""
    n = rows.count()
    cells = min(CELLS, max(1, round(math.sqrt(n)))) if cells is None else cells
    some = rows.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(SAMPLE * cells).select(array_to_vector(F.col(column).cast("array<double>")).alias("v"))
    if not n:
        return np.zeros((0, 0))
    if cells == 1:  # k-means takes two at least
        return np.zeros((1, rows.select(F.size(column)).first()[0]))
    return np.array(KMeans(k=cells, featuresCol="v", seed=seed, maxIter=10).fit(stored(some, "sample")).clusterCenters())


def _nearness(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Larger for a nearer centre."""
    return vectors @ centres.T - (centres**2).sum(1) / 2


def with_cell(rows: DataFrame, column: str, centres: np.ndarray) -> DataFrame:
    at = rows.columns.index(column)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "cell int"])

    def assigned(batches):
        for batch in batches:
            near = _nearness(_matrix(batch.column(at), centres.shape[1]), centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.argmax(1).astype(np.int32))], names=[*batch.schema.names, "cell"])

    return rows.mapInArrow(assigned, schema)


def _kept(query: np.ndarray, names: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, id, similarity) the k most similar of each query, ties by id, in this order."""
    order = np.lexsort((np.unique(names, return_inverse=True)[1], -score, query))
    first = np.flatnonzero(np.diff(query[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    order = order[place < k]
    return query[order], names[order], score[order]


@dataclass
class VectorIndex:
    """An index at a path: vectors/ by cell, and the centres of the cells."""

    spark: SparkSession
    path: str
    key: str = "id"
    column: str = "embedding"
    centres: np.ndarray = field(default=None, repr=False)

    def __post_init__(self):
        if self.centres is None:
            rows = self.spark.read.parquet(f"{self.path}/centres").orderBy("cell").collect()  # CELLS rows at most
            self.centres = np.array([r["centre"] for r in rows])

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def located(self, **metadata) -> DataFrame:
        """Rows with the given metadata; these are pushed to the scan."""
        rows = self.vectors
        for name, value in metadata.items():
            rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
        return rows.drop("cell")

    def upsert(self, new: DataFrame, gone: DataFrame | None = None, embed=None, text: str = "page_content") -> dict[str, int]:
        """Rows put in or replaced by id; rows without an id get one from their content, rows without a vector one from embed.

        Only the cells that hold one of the ids or get one are rewritten.
        """
        new = keyed.with_ids(new, self.key, *(c for c in new.columns if c not in (self.key, self.column)))
        new = keyed.with_vectors(new, embed, text, self.column) if embed is not None else new
        rows = with_cell(usable(new, self.column, self.centres.shape[1]), self.column, self.centres)
        return keyed.merge(f"{self.path}/vectors", rows, self.key, "cell", gone)

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None, where: Column | None = None) -> DataFrame:
        """(query_id, id, similarity, rank): for each of queries(query_id, embedding) the k vectors with the largest dot products
        in the `probes` cells nearest to it (all if not given), of those that `where` lets through; ties by id.

        Queries without a whole vector of the index's length find nothing.
        """
        asked = usable(queries.select("query_id", F.col(self.column).cast("array<double>").alias("q")), "q", self.centres.shape[1])
        n = asked.count()
        if not len(self.centres) or not n:
            kind = self.vectors.schema[self.key].dataType.simpleString() if len(self.centres) else "string"
            return asked.limit(0).select("query_id", F.lit(None).cast(kind).alias("id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("rank"))
        found = None
        numbered = stored(with_places(asked, "query_id"), "queries") if n > BLOCK else asked
        for b in range(-(-n // BLOCK)):
            block = numbered.where((F.col("place") >= b * BLOCK) & (F.col("place") < (b + 1) * BLOCK)) if n > BLOCK else numbered
            own = self._block(block.select("query_id", "q").toArrow(), k, probes, where)  # BLOCK queries
            found = own if found is None else found.unionByName(own)
        return self._ranked(found, k)

    def tuned(self, queries: DataFrame, k: int = 10, recall: float = 0.95) -> int:
        """The fewest probes at which these queries, BLOCK at most, find that share of their exact k best: each of these lies in a
        cell that is so many-th in its query's order."""
        asked = usable(queries.select("query_id", F.col(self.column).cast("array<double>").alias("q")), "q", self.centres.shape[1]).orderBy(F.xxhash64("query_id")).limit(BLOCK)
        table = asked.toArrow()
        exact = self._ranked(self._block(table, k, None, None), k)
        cells = exact.join(self.vectors.select(F.col(self.key).alias("id"), "cell"), "id").select("query_id", "cell").toPandas()  # k * BLOCK rows
        near = _nearness(_matrix(table.column("q").combine_chunks(), self.centres.shape[1]), self.centres)
        place = np.argsort(np.argsort(-near, axis=1, kind="stable"), axis=1)
        row = {q: i for i, q in enumerate(table.column("query_id").to_pylist())}
        places = np.sort([place[row[q], c] for q, c in zip(cells["query_id"], cells["cell"], strict=True)])
        return int(places[max(0, math.ceil(recall * len(places)) - 1)]) + 1 if len(places) else len(self.centres)

    @staticmethod
    def _ranked(found: DataFrame, k: int) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def _block(self, table: pa.Table, k: int, probes: int | None, where: Column | None) -> DataFrame:
        dims, ids = self.centres.shape[1], table.column("query_id").to_numpy()
        asked = _matrix(table.column("q").combine_chunks(), dims)
        near = _nearness(asked, self.centres)
        wanted = np.zeros(near.shape, bool)
        np.put_along_axis(wanted, np.argsort(-near, axis=1, kind="stable")[:, : probes or near.shape[1]], True, 1)
        rows = self.vectors
        rows = rows.where(where) if where is not None else rows
        if not wanted.all():
            rows = rows.where(F.col("cell").isin(np.flatnonzero(wanted.any(0)).tolist()))
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
        id_kind = np.int64 if kinds[self.key] in ("bigint", "int", "smallint", "tinyint") else object
        sent, query_kind = self.spark.sparkContext.broadcast((asked, ids, wanted)), "long" if ids.dtype.kind in "iu" else "string"

        def best(batches):
            asked, ids, wanted = sent.value
            held = np.zeros(0, np.int64), np.zeros(0, id_kind), np.zeros(0)  # query, id, similarity: the best k of each query
            bound = np.full(len(asked), -np.inf)
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    part = batch.slice(a, ROWS)
                    score = asked @ _matrix(part.column(2), dims).T
                    score[~wanted[:, part.column(1).to_numpy()]] = -np.inf
                    if part.num_rows > k:  # what is below the k best of these rows, or of those before, is out
                        least = np.maximum(bound, np.partition(score, part.num_rows - k, axis=1)[:, part.num_rows - k])
                    else:
                        least = bound
                    query, row = np.nonzero((score >= least[:, None]) & (score > -np.inf))
                    if not len(row):
                        continue
                    names = part.column(0).to_numpy(zero_copy_only=False)
                    held = _kept(np.concatenate([held[0], query]), np.concatenate([held[1], names[row]]), np.concatenate([held[2], score[query, row]]), k)
                    first = np.flatnonzero(np.diff(held[0], prepend=-1))
                    size = np.diff(first, append=len(held[0]))
                    bound[held[0][first[size == k]]] = held[2][first[size == k] + k - 1]
            if len(held[0]):
                yield pa.RecordBatch.from_arrays([pa.array(ids[held[0]]), pa.array(held[1].tolist()), pa.array(held[2])], names=["query_id", "id", "similarity"])

        return rows.select(self.key, "cell", self.column).mapInArrow(best, f"query_id {query_kind}, id {kinds[self.key]}, similarity double")


def build(rows: DataFrame, path: str, key: str = "id", column: str = "embedding", cells: int | None = None) -> VectorIndex:
    """An index of rows (key, vector, any other columns) at a path that is not there yet; rows without a whole vector are left out.

    Vectors must be of one length, ids must be unique (upsert() makes them so).
    """
    spark = rows.sparkSession
    rows = usable(rows, column)
    centres = cell_centres(rows, column, key, cells)
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>").coalesce(1).write.parquet(f"{path}/centres")
    if len(centres):
        keyed._write(with_cell(rows, column, centres), f"{path}/vectors", "cell", "errorifexists")
    return VectorIndex(spark, path, key, column, centres)
