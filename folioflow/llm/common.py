"""What the training-data operators share: the shared work folder, Arrow text access, byte-level word hashing."""

from __future__ import annotations

import uuid
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..sources.store import shared_folder

_U = np.uint64


class Workspace:
    """Intermediate tables of one operator run, as Parquet in the shared folder.

    A written table cuts lineage and survives lost executors; drop() frees the disk of one no longer needed, and
    what is left goes when the driver's file system closes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        path, fs = self._fs(self.root)
        fs.deleteOnExit(path)

    def _fs(self, where: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back."""
        where = f"{self.root}/{name}"
        df.write.parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = self._fs(f"{self.root}/{name}")
            fs.delete(path, True)


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks_of(offs: np.ndarray, most: int):
    """Row ranges (a, b) whose bytes stay within most, or single rows beyond it."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_lower = np.arange(256)
_lower[65:91] += 32
LOWER_VALUES = BYTE_VALUES[_lower]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_base = 0x5851F42D4C957F2D
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, 1 << 20)
        for key, value in (("p", _base), ("q", pow(_base, -1, 1 << 64))):
            steps = np.full(size, value, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["p"][:n], _powers["q"][:n]


def prefix_hash(raw: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Running sums whose difference over a range, scaled by an inverse power, is that range's hash."""
    total = np.zeros(len(raw) + 1, np.uint64)
    if len(raw):
        np.cumsum(values[raw] * powers(len(raw))[0], out=total[1:])
    return total


def word_hashes(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every white-space-free run of the given texts, A-Z lower-cased, and the n + 1 word offsets per text."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    word = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    end = word
    end[:-1] &= ~word[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    total = prefix_hash(raw, LOWER_VALUES)
    h = (total[e] - total[s]) * powers(n)[1][s]
    return mix64(h + (e - s).astype(np.uint64) * _U(0x9E3779B97F4A7C15)), np.searchsorted(s, offs)


def word_digests(texts: pa.Array, most: int = 4 << 20):
    """Yield (row numbers a to b, hashes of their words, the b - a + 1 word offsets): words are runs without ASCII white space, A-Z
    lower-cased, each distinct one hashed once (64 bits of BLAKE2). Null is empty; rows are taken `most` bytes at a time."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    offs = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    for a, b in blocks_of(offs, most):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(a, b - a)))
        words = lists.flatten()
        at = lists.offsets.to_numpy().astype(np.int64)
        coded = words.dictionary_encode()
        known = coded.dictionary.to_numpy(zero_copy_only=False)
        hashes = np.frombuffer(b"".join([blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in known]), np.uint64)
        index = coded.indices.to_numpy()
        empty = np.array([w == "" for w in known], bool)
        if empty.any():  # white space at an end
            there = ~empty[index]
            before = np.concatenate([[0], np.cumsum(there)])
            words, at = hashes[index[there]], before[at - at[0]]
        else:
            words, at = hashes[index], at - at[0]
        del lists, coded, known, index
        yield a, b, words, at
    pa.default_memory_pool().release_unused()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
