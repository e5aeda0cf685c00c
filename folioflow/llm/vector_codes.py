"""Vector code compression: each part of a vector becomes the index of its nearest entry in that part's codebook.

Components are scaled to integers first, so distances, sums and floors are exact and no result depends on the order of rows.
A round broadcasts one kd-tree per codebook (entries x components integers, whatever the number of vectors). Tasks search all
their parts in step: the child on a part's own side first, then every node whose box is no farther than the best distance so
far; boxes at just that distance are visited too, so that of equally near entries the lower index wins. Each task sums the
parts it has assigned to each entry; the sums meet in one aggregation that combines map-side, and the driver gets one row for
each codebook entry and position.
"""

from __future__ import annotations

from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers up to here have squared distances that fit 64 bits in parts of up to 512 components; beyond it Python's integers are used.
_PLAIN = 1 << 26
_LEAF = 2
#: Sums by label that are broadcast; more are joined by shuffle.
_LABELS = 100_000


class KdTree:
    """A kd-tree over the entries of one codebook: nodes with their boxes, split at the median of the widest axis."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.nodes = entries, []
        if len(entries):
            self._grow(np.arange(len(entries)))

    def _grow(self, own: np.ndarray) -> int:
        at, points = len(self.nodes), self.entries[own]
        low, high = points.min(0), points.max(0)
        self.nodes.append(None)
        wide = int(np.argmax(high - low)) if len(low) else 0
        if len(own) <= _LEAF or not len(low) or high[wide] == low[wide]:
            self.nodes[at] = (low, high, np.sort(own), 0, 0, 0, 0)
            return at
        order = own[np.argsort(points[:, wide], kind="stable")]
        half = len(order) // 2
        split = self.entries[order[half], wide]
        left, right = self._grow(order[:half]), self._grow(order[half:])
        self.nodes[at] = (low, high, None, wide, split, left, right)
        return at

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row; the lower index at a tie."""
        n = len(points)
        index = np.full(n, len(self.entries), np.int64)
        best = np.full(n, None if points.dtype == object else np.iinfo(np.int64).max, points.dtype)
        if points.dtype == object:
            best[:] = np.inf
        stack = [(0, np.arange(n))]
        while stack:
            at, rows = stack.pop()
            if not len(rows):
                continue
            low, high, own, axis, split, left, right = self.nodes[at]
            q = points[rows]
            out = np.maximum(np.maximum(low - q, q - high), 0)
            rows = rows[(out * out).sum(1) <= best[rows]]
            if own is None:
                there = points[rows, axis] >= split
                here, far = rows[~there], rows[there]
                # The last one pushed is visited first: each row's own side before the other.
                stack += [(right, here), (left, far), (left, here), (right, far)]
                continue
            for e in own:
                off = points[rows] - self.entries[e]
                d = (off * off).sum(1)
                better = (d < best[rows]) | ((d == best[rows]) & (e < index[rows]))
                best[rows[better]], index[rows[better]] = d[better], e
        return index, best


def _points(column: pa.Array, width: int) -> np.ndarray:
    """The integer vectors of a list column as rows of the given width, shorter ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _assigned(trees: list[KdTree], points: np.ndarray):
    """Yield (part, its columns, index, squared distance) of every part of the rows."""
    step = points.shape[1] // len(trees)
    wide = points.size and (points.max() > _PLAIN or points.min() < -_PLAIN) or any(t.entries.dtype == object for t in trees)
    points = points.astype(object) if wide else points
    for k, tree in enumerate(trees):
        own = points[:, k * step : (k + 1) * step]
        yield k, own, *tree.nearest(own)


def vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, v): the rows whose vector is whole and finite, components as floor(scale * x)."""
    x = F.col(vec_col)
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    ints = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    return rows.where(whole).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), ints.alias("v"))


def _trees(books: list[np.ndarray]) -> list[KdTree]:
    return [KdTree(b.astype(object) if b.size and (b.max() > _PLAIN or b.min() < -_PLAIN) else b) for b in books]


def codebooks(points: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The learned codebooks, one array (entries x components) for each part, from a table that vectors() made."""
    spark = points.sparkSession
    longest = points.agg(F.max(F.size("v")).alias("n")).first()["n"]
    step = max(1, -(-(longest or 0) // parts))
    seeds = points.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    start = np.zeros((len(seeds), step * parts), np.int64)
    for i, r in enumerate(seeds):
        start[i, : len(r["v"])] = r["v"]
    books = [start[:, k * step : (k + 1) * step].copy() for k in range(parts)]
    for _ in range(rounds if seeds else 0):
        sent = spark.sparkContext.broadcast(_trees(books))

        def sums(batches, sent=sent, step=step, parts=parts):
            trees = sent.value
            count = np.zeros((parts, len(trees[0].entries)), np.int64)
            total = np.zeros((parts, len(trees[0].entries), step), object)
            for batch in batches:
                for k, own, index, _ in _assigned(trees, _points(batch.column(0), step * parts)):
                    count[k] += np.bincount(index, minlength=count.shape[1])
                    if own.dtype == object:
                        np.add.at(total[k], index, own)
                    else:
                        some = np.zeros(total[k].shape, np.int64)
                        np.add.at(some, index, own)
                        total[k] += some
            k, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int32()), pa.array(e, pa.int32()), pa.array(count[k, e], pa.int64()),
                 pa.array([[Decimal(int(x)) for x in row] for row in total[k, e]], pa.list_(pa.decimal128(38, 0)))],
                names=["part", "entry", "n", "total"],
            )

        got = (
            points.select("v").mapInArrow(sums, "part int, entry int, n long, total array<decimal(38,0)>")
            .select("part", "entry", "n", F.posexplode("total").alias("at", "x")).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
        )
        for r in got:
            books[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
        sent.unpersist()
    return books


def digest_of(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' integers by part, entry and position, joined by commas."""
    return sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(points: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error): every vector by the given codebooks. An error beyond 64 bits is null."""
    sent, width = points.sparkSession.sparkContext.broadcast(_trees(books)), sum(b.shape[1] for b in books)
    label = points.schema["label"].dataType.simpleString()

    def codes(batches):
        for batch in batches:
            n = batch.num_rows
            code, error = np.zeros((n, len(sent.value)), np.uint8), np.zeros(n, object)
            for k, _, index, d in _assigned(sent.value, _points(batch.column(2), width)):
                code[:, k] = index
                error += d
            text = code.tobytes().hex()
            size = 2 * code.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([text[i * size : (i + 1) * size] for i in range(n)], pa.string()), pa.array([int(x) if x < 1 << 63 else None for x in error], pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return points.select("vec_id", "label", "v").mapInArrow(codes, f"vec_id long, label {label}, code string, error long")


def compress(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """One row per whole vector: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds a null or non-finite component are dropped. Vectors are filled with zeros to the longest
    length, and that to a multiple of `parts`: zeros in all vectors change no distance. Scaled components beyond 64 bits are
    taken at the ends of that range. Rows without an id are encoded; they start no codebook before rows with one, and of repeated ids the
    vector that comes first as a list starts it first. With fewer vectors than `entries` the codebooks are shorter; of an empty table the result is
    empty. Equal vectors get equal codes. Labels may be of any type that can be compared, nulls are one label. Other columns of
    rows are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    ws = Workspace(rows.sparkSession, "codes")
    points = ws.table(vectors(rows, id_col, vec_col, label_col, scale), "points")
    books = codebooks(points, parts, entries, rounds)
    coded = ws.table(encode(points, books), "coded")
    ws.drop("points")
    sums = ws.table(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "sums")
    few = sums.count() <= _LABELS
    out = coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest_of(books)).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of the query: the rounds written out one after the other, each entry compared with each part."""
    floor = "(x - ((x % n) + n) % n) // n"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, part, min(struct_pack(d := d, e := entry)) AS b FROM (SELECT p.vec_id, p.part, c.entry, "
            f"list_sum(list_transform(range(1, len(p.w) + 1), lambda j: (p.w[j] - c.w[j]) * (p.w[j] - c.w[j])))::BIGINT AS d FROM p JOIN c{i} c USING (part)) GROUP BY ALL)"
        )
        if i < rounds:
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(u.w, c.w) AS w FROM c{i} c LEFT JOIN (SELECT part, entry, list({floor} ORDER BY pos) AS w FROM ("
                f"SELECT part, b.e AS entry, pos, sum(w[pos])::BIGINT AS x, count(*) AS n FROM a{i} JOIN p USING (vec_id, part), unnest(range(1, len(w) + 1)) AS t(pos) GROUP BY ALL) GROUP BY ALL) u USING (part, entry))"
            )
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), p AS MATERIALIZED (SELECT vec_id, part::INT AS part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS w FROM k, range({parts}) t(part)),
c0 AS MATERIALIZED (SELECT p.part, (row_number() OVER (PARTITION BY p.part ORDER BY vec_id) - 1)::INT AS entry, p.w FROM p JOIN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}) USING (vec_id)),
{", ".join(steps)},
r AS (SELECT vec_id, string_agg(lower(printf('%02x', b.e)), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT r.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM r JOIN k USING (vec_id)
"""


ORACLE = oracle()
