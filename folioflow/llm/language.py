"""Language ID by prediction by partial matching: exact code lengths under frozen byte-context statistics.

For each language, the bytes of a bounded training sample are counted in contexts of 0 to 3 bytes. A byte's code is
that of the longest context that has it, after an escape from each longer context that was seen without it (escape
probability d / (n + d) for n occurrences and d distinct bytes; below order 0 all 256 bytes are alike). Counts are
frozen, so a byte's code length depends only on itself and the three bytes before: it is worked out once for every
four-byte string of the samples and looked up; strings outside that table are worked out when they occur. The
language with the shortest total code wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_of, text_view

ORDER = 3
_SLOT_BITS = 20
_HASH = np.uint32(0x9E3779B1)


def four_grams(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Each byte with the three before it in its text (zeros before the first), as one number."""
    out = raw.astype(np.uint32)
    starts = offs[:-1]
    place = np.zeros(len(raw) + 1, np.int64)
    real = starts[starts < len(raw)]
    if len(raw):
        first = np.zeros(len(raw), np.int64)
        first[real] = real
        place = np.arange(len(raw)) - np.maximum.accumulate(first)
    for k in range(1, ORDER + 1):
        before = np.zeros(len(raw), np.uint32)
        before[k:] = raw[: max(0, len(raw) - k)]
        before[place[: len(raw)] < k] = 0
        out |= before << np.uint32(8 * k)
    return out


class ContextTree:
    """Frozen counts of one language; cost() gives exact code lengths in bits."""

    def __init__(self, grams: np.ndarray):
        self.orders = []
        for k in range(ORDER + 1):
            key = grams if k == 3 else grams & np.uint32((1 << (8 * (k + 1))) - 1)
            keys, counts = np.unique(key, return_counts=True)
            ctx, at = np.unique(keys >> np.uint32(8), return_inverse=True)
            self.orders.append((keys, counts.astype(float), ctx, np.bincount(at, counts), np.bincount(at).astype(float)))

    def cost(self, grams: np.ndarray) -> np.ndarray:
        bits, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
        for k in range(ORDER, -1, -1):
            keys, counts, ctx, n, d = self.orders[k]
            if not len(keys):
                continue
            key = grams if k == 3 else grams & np.uint32((1 << (8 * (k + 1))) - 1)
            i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            j = np.minimum(np.searchsorted(ctx, key >> np.uint32(8)), len(ctx) - 1)
            hit, known = keys[i] == key, ctx[j] == key >> np.uint32(8)
            bits += np.where(open_ & hit, np.log2((n[j] + d[j]) / counts[i]), np.where(open_ & known, np.log2((n[j] + d[j]) / d[j]), 0))
            open_ &= ~hit
        return bits + 8.0 * open_


class Model:
    """Context trees of all languages, with a direct table of the code lengths of the four-byte strings of the samples."""

    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        grams = {}
        for lang in self.langs:
            own = [t.encode() for t in texts[lang]]
            grams[lang] = four_grams(np.frombuffer(b"".join(own), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64))
        self.trees = [ContextTree(grams[lang]) for lang in self.langs]
        every, counts = np.unique(np.concatenate([*grams.values(), np.zeros(0, np.uint32)]), return_counts=True)
        every = every[np.argsort(-counts, kind="stable")]
        slots, first = np.unique(self._slot(every), return_index=True)  # the most frequent string has a slot
        self.keys = np.zeros(1 << _SLOT_BITS, np.uint32)
        self.keys[slots] = every[first]
        self.costs = np.zeros((1 << _SLOT_BITS, len(self.langs)), np.float32)
        if self.langs:
            self.costs[slots] = self._exact(every[first])
            empty = self._exact(np.zeros(1, np.uint32))[0]  # unused slots hold the string of four zeros
            self.costs[np.setdiff1d(np.arange(1 << _SLOT_BITS), slots)] = empty

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams * _HASH) >> np.uint32(32 - _SLOT_BITS)

    def _exact(self, grams: np.ndarray) -> np.ndarray:
        return np.stack([t.cost(grams) for t in self.trees], axis=1).astype(np.float32)

    def bits(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """[texts, languages]: total code length of each text."""
        total = np.zeros((len(offs) - 1, len(self.langs)))
        for a, b in blocks_of(offs, 1 << 19):
            own = offs[a : b + 1] - offs[a]
            grams = four_grams(raw[offs[a] : offs[b]], own)
            slot = self._slot(grams)
            cost = self.costs[slot]
            rest = np.flatnonzero(self.keys[slot] != grams)
            if len(rest):
                new, at = np.unique(grams[rest], return_inverse=True)
                cost[rest] = self._exact(new)[at]
            full = np.flatnonzero(np.diff(own) > 0)
            if len(full):
                total[a + full] = np.add.reduceat(cost, own[full], axis=0, dtype=np.float64)
        return total


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _predictor(model: Model):
    def run(batches):
        for batch in batches:
            raw, offs = text_view(batch.column(1))
            bits = model.bits(raw, offs)
            marks = np.concatenate([[0], np.cumsum(_LETTER[raw])])
            plain = marks[offs[1:]] > marks[offs[:-1]]
            langs, scores = [], []
            for i in range(len(plain)):
                letters = plain[i] or any(c.isalpha() for c in raw[offs[i] : offs[i + 1]].tobytes().decode())
                if letters and model.langs:
                    best = int(np.argmin(bits[i]))
                    langs.append(model.langs[best])
                    scores.append(float(1 / np.exp2(np.minimum(bits[i][best] - bits[i], 0)).sum()))
                else:
                    langs.append("und")
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return run


def train(docs: DataFrame, sample_docs: int = 200, sample_bytes: int = 8 << 20) -> Model:
    """Learn from at most sample_docs documents of each language among the rows held in, those with the smallest hashes, as long as
    their texts together hold at most sample_bytes; a document that alone holds over a quarter of that is passed over."""
    spark = docs.sparkSession
    usable = docs.where(F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2)).select("doc_id", "lang")
    counts = usable.groupBy("lang").count()
    # Twice the wanted rate first, so that the ranking below sees a bounded number of rows of each language.
    rate = F.least(F.lit(1.0), F.lit(2.0 * sample_docs + 50) / F.col("count"))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11) / F.lit(float(1 << 53))
    few = usable.join(F.broadcast(counts), "lang").where(u < rate)  # one row for each language
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id"))).where(F.col("rank") <= sample_docs)
    ids = spark.createDataFrame(few.select("doc_id").distinct().collect(), "doc_id long")
    rows = docs.select("doc_id", "lang", "text").where("lang IS NOT NULL").join(F.broadcast(ids), "doc_id")
    rows = rows.withColumn("_n", F.coalesce(F.octet_length("text"), F.lit(0))).where(F.col("_n") <= sample_bytes // 4)
    so_far = F.sum("_n").over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", F.xxhash64("text")))
    rows = rows.withColumn("_s", so_far).where(F.col("_s") <= sample_bytes).orderBy("doc_id").select("lang", "text").collect()
    texts: dict[str, list[str]] = {}
    for r in rows:
        texts.setdefault(r["lang"], []).append(r["text"] or "")
    return Model(texts)


def identify(docs: DataFrame, sample_docs: int = 200, model: Model | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Texts that are null or have no letter are `und` with score 0, as is every text when no language was learned. The
    score is the winner's share of the probabilities that the languages give the whole text, read to its end however long it is;
    of languages that give it the same, the first by name wins. Rows are judged by their text alone, so repeated rows and ids, and
    rows without an id (not held out), fare like any other. An empty table gives an empty result; extra columns are ignored.
    """
    model = model or train(docs, sample_docs)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_predictor(model), "doc_id long, lang_pred string, score double")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
