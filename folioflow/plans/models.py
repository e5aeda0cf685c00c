"""The seam for models: predicates, classifiers, extractors and embedders as vectorised functions with deterministic defaults."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")
_PROPERTY = {"ys": r"(\d+(?:\.\d+)?)\s*MPa", "strain": r"(\d+(?:\.\d+)?)\s*%", "temperature": r"(-?\d+(?:\.\d+)?)\s*°?\s*[CK]\b"}


def regex_extractor(text: str) -> dict | None:
    """Default extractor: the first value of each known property."""
    got = {k: m[1] for k, p in _PROPERTY.items() if (m := re.search(p, text))}
    return got or None


def extract(df: DataFrame, text: str, model: Callable[[str], dict | None] = regex_extractor, attempts: int = 2) -> DataFrame:
    """df with result (JSON or null) and error. A failing call is tried again, then reported in its row; the job goes on."""

    @F.pandas_udf("result string, error string")
    def call(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            result = error = None
            for _ in range(attempts):
                try:
                    got = model(t or "")
                    result, error = (json.dumps(got, sort_keys=True) if got else None), None
                    break
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
            rows.append((result, error))
        return pd.DataFrame(rows, columns=["result", "error"])

    return df.withColumn("_m", call(F.col(text))).select("*", "_m.result", "_m.error").drop("_m")


def valid_json(c: Column, schema: str, required: list[str]) -> Column:
    """The parsed struct, or null when it does not parse or lacks a required field."""
    parsed = F.from_json(c, schema, {"mode": "PERMISSIVE"})
    ok = F.lit(True)
    for name in required:
        ok = ok & parsed[name].isNotNull()
    return F.when(ok, parsed)


def embedder(dims: int = 64):
    """Default embedding: signed word hashes, unit length."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        def one(t):
            v = np.zeros(dims, np.float32)
            for w in (t or "").lower().split():
                h = zlib.crc32(w.encode())
                v[h % dims] += 1 if h & 0x80000000 else -1
            n = np.linalg.norm(v)
            return (v / n if n else v).tolist()

        return texts.map(one)

    return embed


#: Buckets of words whose frequencies are learned.
_WORDS = 1 << 16
#: Words whose directions a worker remembers.
_REMEMBERED = 100_000


def _signs(word: str, dims: int) -> np.ndarray:
    """The word's own direction: one of the corners of a cube, by its digest."""
    bits = b"".join(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=64, salt=i.to_bytes(8, "little")).digest() for i in range(-(-dims // 512)))
    return np.unpackbits(np.frombuffer(bits, np.uint8))[:dims].astype(np.float32) * 2 - 1


def word_weights(docs: DataFrame, text: str, buckets: int = _WORDS) -> np.ndarray:
    """How much a word of each bucket says: the logarithm of how few of docs have one, from one aggregation of `buckets` rows."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    found = docs.where(F.col(text).isNotNull()).select(F.array_distinct(F.transform(words, lambda w: F.pmod(F.crc32(w), F.lit(buckets)).cast("int"))).alias("b"))
    n = found.count()
    have = np.zeros(buckets)
    for bucket, k in found.select(F.explode("b").alias("b")).groupBy("b").count().collect():  # `buckets` rows at most
        have[bucket] = k
    return np.log((1 + n) / (1 + have)).astype(np.float32)


def learned_embedder(docs: DataFrame, text: str = "page_content", dims: int = 64):
    """An embedding learned from docs: a text is the sum of its words' directions, each weighted by the logarithm of its count and by
    how rare it is in docs, of length 1; texts without words are zero. Two texts' dot product estimates how much of the weight of
    their words they share, whatever the number of words."""
    sent = docs.sparkSession.sparkContext.broadcast(word_weights(docs, text))

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, known, rows = sent.value, {}, np.empty((_REMEMBERED, dims), np.float32)  # a word's place in rows
        for texts in batches:
            out = []
            for value in texts:
                words = Counter(_WORD.findall((value or "").lower()))
                fresh = [w for w in words if w not in known]
                if len(known) + len(fresh) > len(rows):
                    known.clear()
                    fresh = list(words)
                    rows = rows if len(fresh) <= len(rows) else np.empty((len(fresh), dims), np.float32)
                for word in fresh:
                    rows[len(known)] = weights[zlib.crc32(word.encode("utf-8", "surrogatepass")) % len(weights)] * _signs(word, dims)
                    known[word] = len(known)
                times = np.fromiter(words.values(), np.float32, len(words))
                total = (1 + np.log(times)) @ rows[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
                length = np.linalg.norm(total)
                out.append((total / length if length else total).tolist())
            yield pd.Series(out, dtype=object)

    return embed
