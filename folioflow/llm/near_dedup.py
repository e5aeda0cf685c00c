"""MinHash near-dedup through a multi-index Hamming join.

A document is the set of its distinct five-word shingles. Its signature has 64 components of 16 bits (b-bit minwise
hashing). Two signatures are close when at most 23 components differ; a pair with the required similarity of 0.85
differs in 9.6 on average, and in more than 23 with a chance of about one in 10^5.

Candidates: the 64 components are split into 12 chunks. If at most 23 differ, some chunk differs in at most one place
(pigeonhole: 23 < 2 * 12), so the allowed chunk errors - none or one - are enumerated by leaving out each component of
the chunk in turn: 64 keys a document, and *every* pair under the distance threshold shares one. The keys are joined
by equality; no bucket is capped.

Links are confirmed on the full shingle sets: every distinct word is hashed by BLAKE2, a shingle's 64 bits are a mixed sum of
its words' with a multiplier for each place, so equal hashes of different shingles are a matter of chance, one in 2^64 a
pair, not of the texts' structure. Copies with the same set are one class before any key is made. Within a
bucket, only pairs across components not yet joined are confirmed: some rounds link members to one representative
each, then what is still apart is compared pair by pair where the counts of shared shingles leave a link possible. No
link that could join two components is missed, while a group of thousands of near copies costs a few comparisons per
member.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, mix64, text_view, word_digests
from .graph import components

_U = np.uint64
COMPONENTS, CHUNKS, SHINGLE = 64, 12, 5
_BOUNDS = [round(i * COMPONENTS / CHUNKS) for i in range(CHUNKS + 1)]
_MULTIPLIERS = mix64(np.arange(1, COMPONENTS + 1, dtype=np.uint64) * _U(0xD1B54A32D192ED03)) | _U(1)
_PLACES = mix64(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | _U(1)
_KEY_PLACES = mix64(np.arange(301, 301 + COMPONENTS, dtype=np.uint64)) | _U(1)


def shingle_sets(texts: pa.Array):
    """For each text its distinct shingle hashes, sorted."""
    for a, b, words, at in word_digests(texts):
        n = max(0, len(words) - SHINGLE + 1)
        grams = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            grams += words[k : k + n] * _PLACES[k]
        grams = mix64(grams)
        for i in range(b - a):
            s, e = int(at[i]), int(at[i + 1])
            if e - s >= SHINGLE:
                yield np.unique(grams[s : e - SHINGLE + 1])
            elif e > s:
                yield mix64(np.array([np.sum(words[s:e] * _PLACES[: e - s]) + _U(e - s)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def signature(grams: np.ndarray) -> bytes:
    """64 minima of random permutations of the set, 16 bits of each."""
    low = np.full(COMPONENTS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(grams), 2048):
        np.minimum(low, (_MULTIPLIERS[:, None] * grams[None, k : k + 2048]).min(axis=1), out=low)
    return (mix64(low) >> _U(48)).astype("<u2").tobytes()


def _signatures(batches):
    for batch in batches:
        n, digest, sig = [], [], []
        for grams in shingle_sets(batch.column(1)):
            n.append(len(grams))
            digest.append(blake2b(grams.tobytes(), digest_size=16).digest())
            sig.append(signature(grams) if len(grams) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "digest", "sig"])


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """[n, 64] components to [n, 64] keys: each chunk with each of its components left out."""
    terms = mix64(sig.astype(np.uint64) + (np.arange(COMPONENTS, dtype=np.uint64) << _U(20))) * _KEY_PLACES[None, :]
    keys = np.empty(sig.shape, np.uint64)
    for c in range(CHUNKS):
        s, e = _BOUNDS[c], _BOUNDS[c + 1]
        keys[:, s:e] = terms[:, s:e].sum(axis=1, dtype=np.uint64)[:, None] - terms[:, s:e] + (np.arange(s, e, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))[None, :]
    return mix64(keys)


def _keys(batches):
    for batch in batches:
        raw, _ = text_view(batch.column(2))
        keys = chunk_keys(raw.view("<u2").reshape(-1, COMPONENTS)).view(np.int64).ravel()
        rep, n = (np.repeat(np.asarray(batch.column(i)), COMPONENTS) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(rep), pa.array(n)], ["key", "rep", "n"])


def _sets(batches):
    for batch in batches:
        got = [x.view(np.int64) for x in shingle_sets(batch.column(1))]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
        values = pa.array(np.concatenate(got) if got else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], ["rep", "grams"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, rounds: int = 2) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Null, empty and white-space texts have no shingles and link with nothing; equal texts link; texts are read whole,
    however long; extra columns of docs are ignored and an empty table gives an empty result. Rows that share a doc_id
    are one document with several texts: each text links, all have its component. Rows without a doc_id link with
    nothing and are kept, without a component. percent is the least Jaccard similarity of a link.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "near-dedup")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sigs = ws.table(rows.mapInArrow(_signatures, "doc_id long, n_shingles long, digest binary, sig binary"), "sigs")
    full = sigs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Written, so that the join below reads plain rows on both sides and a text with many copies is split.
    reps = ws.table(full.groupBy("digest").agg(F.min("doc_id").alias("rep")), "reps")
    members = full.select("doc_id", "digest").join(reps, "digest").select("doc_id", "rep")
    # A digest's smallest doc_id is its representative; its signature is read from its own row.
    heads = sigs.join(reps.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi").select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sig")
    keys = heads.mapInArrow(_keys, "key long, rep long, n long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    buckets = ws.table(keys.join(shared, "key"), "buckets")
    wanted = buckets.select(F.col("rep").alias("doc_id")).distinct()
    sets = ws.table(rows.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "rep long, grams array<long>"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("rep").alias("a"), F.col("grams").alias("ga"))
        b = sets.select(F.col("rep").alias("b"), F.col("grams").alias("gb"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", F.size("ga").alias("na"), F.size("gb").alias("nb"), F.size(F.array_intersect("ga", "gb")).alias("common"))
        return both.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")

    def sized(left: str, right: str):
        return (100 * F.least(left, right) >= percent * F.greatest(left, right))

    links = labels = None
    open_ = buckets.withColumn("comp", F.col("rep"))
    for k in range(rounds + 1):
        if k < rounds:
            order = F.col("rep") if k == 0 else F.xxhash64("rep", F.lit(k))
            head = open_.groupBy("key").agg(F.min(F.struct(order.alias("o"), F.col("rep").alias("head"), F.col("n").alias("hn"), F.col("comp").alias("hc"))).alias("h")).select("key", "h.head", "h.hn", "h.hc")
            pairs = open_.join(head, "key").where((F.col("comp") != F.col("hc")) & sized("n", "hn"))
            pairs = pairs.select(F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")).distinct()
        else:
            # A link needs an overlap of percent of either set, and an overlap holds only shingles that two open
            # texts have. Texts with too many shingles of their own drop out, which leaves others with more.
            for turn in range(2):
                own = sets.join(open_.select("rep").distinct(), "rep", "left_semi")
                alone = own.select("rep", F.explode("grams").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep")).where("n = 1")
                alone = alone.groupBy("rep").agg(F.count(F.lit(1)).alias("alone"))
                most = open_.select("rep", "n").distinct().join(alone, "rep", "left").select("rep", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("most"))
                open_ = open_.drop("most").join(most, "rep").where(100 * F.col("most") >= percent * F.col("n"))
                apart = open_.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
                open_ = ws.table(open_.join(apart, "key"), f"last-{turn}")
            # A pair is made in the first of the buckets that it shares, not in each of them.
            own = open_.groupBy("rep").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # at most 64 keys each
            open_ = open_.join(own, "rep")
            other = open_.select("key", F.col("rep").alias("rep2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), F.col("most").alias("most2"), F.col("keys").alias("keys2"))
            bound = F.least("most", "most2")
            pairs = open_.join(other, "key").where(
                (F.col("rep") < F.col("rep2")) & (F.col("comp") != F.col("comp2")) & (100 * bound >= percent * (F.col("n") + F.col("n2") - bound)) & (F.col("key") == F.array_min(F.array_intersect("keys", "keys2")))
            )
            pairs = pairs.select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
        found = ws.table(confirmed(pairs), f"links-{k}")
        links = found if links is None else links.union(found)
        if k == rounds and labels is not None and found.isEmpty():
            break
        labels = components(links, ws, f"comp-{k}")
        if k < rounds:
            at = buckets.join(labels, F.col("rep") == F.col("node"), "left").select("key", "rep", "n", F.coalesce("comp", "rep").alias("comp"))
            apart = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
            open_ = ws.table(at.join(apart, "key"), f"open-{k}")
            if open_.isEmpty():
                break
    ws.drop("sets", "buckets", "last-0", "last-1", *(f"open-{k}" for k in range(rounds)), *(f"links-{k}" for k in range(rounds + 1)))
    comp = members.join(labels, F.col("rep") == F.col("node"), "left").select(F.col("doc_id").alias("_id"), F.coalesce("comp", "rep").alias("comp"))
    comp = comp.groupBy("_id").agg(F.min("comp").alias("comp"))  # an id may be repeated
    return sigs.select("doc_id", "n_shingles").join(comp, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"), F.coalesce(F.coalesce("comp", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept")
    )
