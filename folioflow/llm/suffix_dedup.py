"""Suffix-array dedup: every byte covered by a 100-byte string that also starts earlier is removed.

Shards are cut by content, so that equal strings meet. In every 100-byte window the 24-byte gram with the smallest
hash (the leftmost at a tie) is its anchor; equal windows have equal anchors at equal offsets. The windows of one
anchor occurrence are consecutive and form a fragment. Then:

1. Anchor grams that occur once are dropped; a bitmap of bounded size, not the list, tells the scan which may repeat.
   A full bitmap only lets more rows through.
2. Fragments with equal bytes (equal 128-bit BLAKE2 digests) form a class; all but its first member repeat in full and are
   covered. Copies end here, whatever their number.
3. The first members of classes that share an anchor with another class are cut in two: the windows that hold the anchor in
   their first 39 places share 62 bytes from the anchor on, the others 63 bytes up to its end. These bytes are a part's
   key; only parts that share a key can hold an equal window. Keys that occur once are dropped.
4. The parts of a key meet in a shard. There a suffix array is built by Larsson-Sadakane refinement, neighbours' common
   prefixes come from Kasai's algorithm run over all parts in step, and among windows with 100 bytes in common all but
   the first are covered. A key whose parts fill several shards is worked off in order of position, each shard looking
   its windows up in the suffix arrays before it by binary search.
5. A key with more than HOT parts is no shard's business: its windows are compared one by one, by their digests, in an
   aggregation that combines map-side, so one phrase in a third of all documents is spread over the cluster.

Classes and windows of hot keys are compared by 128-bit cryptographic digests, windows in shards byte by byte.
"""

from __future__ import annotations

from decimal import Decimal
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, blocks_of, mix64, powers, prefix_hash, text_view

LENGTH, GRAM = 100, 24
SHARD = 1 << 20
_REACH = LENGTH - GRAM + 1
_U = np.uint64
_PLACE = _U((1 << 24) - 1)
_MOST_BITS = 27
#: Parts of one key that shards take, some four of them; and how many places an anchor has in windows of the first kind.
HOT, _HALF = 1 << 15, 39
_STEP = Decimal(10**15)


def fragments(raw: np.ndarray, offs: np.ndarray):
    """Yield (text, fp, start, stop, at) arrays: anchors of a run of texts, where their windows' bytes lie in the text and where the anchor begins."""
    for a, b in blocks_of(offs, 1 << 20):
        own = offs[a : b + 1] - offs[a]
        if own[-1] <= 8 << 20:
            yield from _anchors(raw[offs[a] : offs[b]], own, a, 0)
        else:  # one very long text, in overlapping pieces
            for s in range(0, int(own[-1]), 4 << 20):
                piece = raw[offs[a] + s : min(offs[b], offs[a] + s + (4 << 20) + LENGTH - 1)]
                yield from _anchors(piece, np.array([0, len(piece)]), a, s)


def _anchors(raw: np.ndarray, offs: np.ndarray, first: int, base: int):
    n = len(raw)
    if n < LENGTH:
        return
    total = prefix_hash(raw)
    back = powers(n)[1]
    grams = mix64((total[GRAM:] - total[: n - GRAM + 1]) * back[: n - GRAM + 1])
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    k = 1
    while 2 * k <= _REACH:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    low = np.minimum(low[: len(low) - (_REACH - k)], low[_REACH - k :])
    left = np.zeros(n + 1, np.int64)  # bytes left in the text from each place
    sizes = np.diff(offs)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    left = offs[1:][doc] - np.arange(n)
    at = np.flatnonzero(left[: len(low)] >= LENGTH)
    if not len(at):
        return
    anchor = (low[at] & _PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[at[1:]] != doc[at[:-1]])
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(at)) - 1
    i1, stop, j = at[s], at[e] + LENGTH, anchor[s]
    d = doc[i1]
    # An anchor's hash is the least of its window; mixed anew it is spread evenly again.
    yield d + first, mix64(grams[j]), i1 - offs[d] + base, stop - offs[d] + base, j - offs[d] + base


def _all(batch):
    raw, offs = text_view(batch.column(1))
    got = list(fragments(raw, offs))
    return raw, offs, [np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in range(5)]


def _counts(batches):
    for batch in batches:
        fp, n = np.unique(_all(batch)[2][1].astype(np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(n)], ["fp", "n"])


def _digests(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int = 16) -> list[bytes]:
    view = memoryview(np.ascontiguousarray(raw))
    return [blake2b(view[a:b], digest_size=size).digest() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


class Bitmap:
    """Which hashes may be in a set: a power of two of bits, at most 2**28, whatever the set's size."""

    def __init__(self, hashes: DataFrame, name: str):
        n = hashes.count()
        self.bits = max(12, min(_MOST_BITS, int(16 * max(1, n)).bit_length()))
        slot = F.shiftrightunsigned(F.col(name), 64 - self.bits)
        words = hashes.select(slot.alias("slot")).selectExpr("shiftright(slot, 6) AS word", "shiftleft(1L, CAST(slot & 63 AS int)) AS bit")
        words = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2**22 rows
        self.words = np.zeros(1 << (self.bits - 6), np.int64)
        self.words[words["word"].to_numpy()] = words["bits"].to_numpy()

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes.view(np.uint64) >> _U(64 - self.bits)
        return (self.words[(slot >> _U(6)).astype(np.int64)].view(np.uint64) >> (slot & _U(63))) & _U(1) == 1


def _suspects(shared):
    """Fragments whose anchor may repeat: fp, digest of the bytes, where they are, and how far in the anchor begins."""

    def run(batches):
        for batch in batches:
            raw, offs, (doc, fp, start, stop, at) = _all(batch)
            keep = np.flatnonzero(shared.value.maybe(fp.astype(np.uint64))) if len(fp) else np.zeros(0, np.int64)
            doc, start, stop = doc[keep].astype(np.int64), start[keep], stop[keep]
            digests = _digests(raw, offs[doc] + start, offs[doc] + stop)
            cols = [
                pa.array(fp[keep].astype(np.uint64).view(np.int64), pa.int64()), pa.array(digests, pa.binary()), pa.array(np.asarray(batch.column(0))[doc] if len(doc) else np.zeros(0, np.int64), pa.int64()), pa.array(start.astype(np.int32)),
                pa.array((stop - start).astype(np.int32)), pa.array((at[keep] - start).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["fp", "digest", "doc_id", "start", "len", "anchor"])

    return run


def _parts(batches):
    """(key, doc_id, start, body) of the parts of a text's fragments, given as a list of (start, len, anchor)."""
    for batch in batches:
        raw, offs = text_view(batch.column(1))
        ids, lists = np.asarray(batch.column(0)), batch.column(2)
        inner = lists.flatten()
        doc = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        start, size, anchor = (np.asarray(inner.field(k)).astype(np.int64) for k in range(3))
        stop, anchor, base = start + size, start + anchor, offs[doc]
        first, last = start, stop - LENGTH  # first and last windows
        sides = (
            (np.maximum(first, anchor - _HALF + 1), np.minimum(last, anchor), anchor, anchor + LENGTH - _HALF + 1, b"R"),
            (first, np.minimum(last, anchor - _HALF), anchor - _HALF, anchor + GRAM, b"L"),
        )
        out = []
        for low, high, a, b, side in sides:
            own = np.flatnonzero(low <= high)
            view = memoryview(np.ascontiguousarray(raw))
            keys = [blake2b(view[x:y], digest_size=8, key=side).digest() for x, y in zip((base + a)[own].tolist(), (base + b)[own].tolist(), strict=True)]
            bodies = [bytes(view[x:y]) for x, y in zip((base + low)[own].tolist(), ((base + high)[own] + LENGTH).tolist(), strict=True)]
            out.append((np.frombuffer(b"".join(keys), np.int64), ids[doc[own]], low[own].astype(np.int32), bodies))
        cols = [pa.array(np.concatenate([o[k] for o in out])) for k in range(3)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(out[0][3] + out[1][3], pa.binary())], ["key", "doc_id", "start", "body"])


def _windows(batches):
    """(window digest, doc_id, start) of every window of the bodies."""
    for batch in batches:
        raw, offs = text_view(batch.column(2))
        sizes = np.diff(offs) - LENGTH + 1
        row = np.repeat(np.arange(len(sizes)), sizes)
        own = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = offs[row] + own
        doc, start = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        yield pa.RecordBatch.from_arrays([pa.array(_digests(raw, at, at + LENGTH), pa.binary()), pa.array(doc[row], pa.int64()), pa.array((start[row] + own).astype(np.int32))], ["digest", "doc_id", "start"])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes in order: eight bytes sorted first, then only what is still tied is refined by the rank of what follows, twice as far each time. The order must be complete: Kasai's algorithm rests on it."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << _U(8)) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    while h < n:
        last = np.append(new[1:], True)
        open_ = np.flatnonzero(~(new & last))
        if not len(open_):
            break
        at = order[open_]
        follow = rank[np.minimum(at + h, n)]
        by = np.lexsort((follow, rank[at]))
        order[open_] = at[by]
        group, follow = rank[at][by], follow[by]
        new[open_[1:]] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        new[open_[:1]] = True
        starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[open_]] = starts[open_]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Kasai: bytes (up to most) that each suffix shares with the one before it in order, kept by place in the text. Each fragment is one lane; a lane's length falls by at most one from place to place, so it is carried on."""
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[:1]] = n
    tail = np.concatenate([text.astype(np.int16), np.full(1, -1, np.int16)])
    ends = np.append(starts[1:], n)
    lcp, h = np.zeros(n, np.int64), np.zeros(len(starts), np.int64)
    for t in range(int((ends - starts).max())):
        lane = np.flatnonzero(starts + t < ends)
        p = starts[lane] + t
        q = before[p]
        own = np.maximum(h[lane] - 1, 0)
        own[q == n] = 0
        go = np.flatnonzero(q < n)
        while len(go):
            a, b = p[go] + own[go], q[go] + own[go]
            go = go[(own[go] < most) & (a < n) & (b < n) & (tail[np.minimum(a, n)] == tail[np.minimum(b, n)])]
            own[go] += 1
        h[lane] = own
        lcp[p] = own
    return lcp


class Shard:
    """Suffix array of some fragments, with one window of each distinct content."""

    def __init__(self, bodies: list[bytes]):
        sizes = np.array([len(b) for b in bodies])
        self.text = np.frombuffer(b"".join(bodies), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.frag = np.repeat(np.arange(len(sizes)), sizes)
        n = len(self.text)
        whole = np.arange(n) - self.starts[self.frag] <= (sizes - LENGTH)[self.frag]
        order = suffix_array(self.text)
        group = np.empty(n, np.int64)
        group[order] = np.cumsum(common_prefixes(self.text, order, self.starts)[order] < LENGTH)
        self.at = np.flatnonzero(whole)  # whole windows, in order of place
        self.group = group[self.at]
        _, self.first, self.which = np.unique(self.group, return_index=True, return_inverse=True)
        self.heads = self.at[self.first]  # in the suffix array's order

    def words(self, at: np.ndarray) -> np.ndarray:
        padded = np.concatenate([self.text, np.zeros(8, np.uint8)])
        body = padded[at[:, None] + np.arange(LENGTH)[None, :]]
        body = np.concatenate([body, np.zeros((len(at), 104 - LENGTH), np.uint8)], axis=1)
        return np.ascontiguousarray(body).view(">u8")

    def find(self, windows: np.ndarray) -> np.ndarray:
        """Which of the windows (as words) occur here, by binary search over the heads."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.heads))
        while (live := np.flatnonzero(low < high)).size:
            mid = (low[live] + high[live]) // 2
            own, ask = self.words(self.heads[mid]), windows[live]
            differs = own != ask
            k = np.argmax(differs, axis=1)
            rows = np.arange(len(live))
            less = differs[rows, k] & (own[rows, k] < ask[rows, k])
            low[live] = np.where(less, mid + 1, low[live])
            high[live] = np.where(less, high[live], mid)
        got = np.zeros(len(windows), bool)
        inside = np.flatnonzero(low < len(self.heads))
        for a in range(0, len(inside), 1 << 16):
            part = inside[a : a + (1 << 16)]
            got[part] = (self.words(self.heads[low[part]]) == windows[part]).all(axis=1)
        return got


def _runs(doc: np.ndarray, at: np.ndarray):
    """Places of covered windows to (doc, start, length) of the bytes they cover, joined where they touch."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    by = np.lexsort((at, doc))
    doc, at = doc[by], at[by]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + LENGTH)
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(at)) - 1
    return doc[s], at[s], at[e] + LENGTH - at[s]


def covered(rows: list[tuple[int, int, int, bytes]], size: int = SHARD):
    """Runs covered among the fragments (fp, doc_id, start, body), which come in this order."""
    out = []
    k = 0
    while k < len(rows):
        end, held = k, 0
        while end < len(rows) and (held < size or rows[end][0] == rows[end - 1][0] and held < 2 * size):
            held += len(rows[end][3])
            end += 1
        part = Shard([r[3] for r in rows[k:end]])
        hit = part.first[part.which] != np.arange(len(part.at))
        out.append((part, k, end, hit))
        k = end
    for i, (part, k, end, hit) in enumerate(out):
        # An anchor that runs over from earlier shards: its windows are looked up there.
        for older, ok, oend, _ in out[:i]:
            if rows[oend - 1][0] == rows[k][0]:
                found = older.find(part.words(part.heads))
                hit |= found[part.which]
        doc = np.array([r[1] for r in rows[k:end]], np.int64)
        start = np.array([r[2] for r in rows[k:end]], np.int64)
        f = part.frag[part.at[hit]]
        yield _runs(doc[f], start[f] + part.at[hit] - part.starts[f])


def _shards(batches):
    names = ["doc_id", "start", "len"]
    rows: list[tuple[int, int, int, bytes]] = []
    held = 0

    def emit(ready):
        for runs in covered(ready):
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(t)) for r, t in zip(runs, (np.int64, np.int32, np.int32), strict=True)], names)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held >= SHARD and row[0] != rows[-1][0]:
                yield from emit(rows)
                rows, held = [], 0
            rows.append(row)
            held += len(row[3])
    yield from emit(rows)


def _kept(batches):
    for batch in batches:
        raw, offs = text_view(batch.column(1))
        n_removed, n_spans, sha = [], [], []
        for i, (starts, sizes) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            own = raw[offs[i] : offs[i + 1]]
            if starts:
                step = np.zeros(len(own) + 1, np.int64)
                np.add.at(step, np.minimum(starts, len(own)), 1)
                np.add.at(step, np.minimum(np.add(starts, sizes), len(own)), -1)
                gone = np.cumsum(step[:-1]) > 0
                n_removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                own = own[~gone]
            else:
                n_removed.append(0)
                n_spans.append(0)
            sha.append(sha256(own.tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _first(place) -> tuple:
    """The smallest (doc_id, start) of a group as one decimal, which hash aggregation can hold, and both back again."""
    head = F.min(place)
    doc = lambda c: F.floor(c / F.lit(_STEP)).cast("long")
    return head, doc, lambda c: (c - doc(c).cast(T.DecimalType(20, 0)) * F.lit(_STEP)).cast("int")


def repeated_runs(docs: DataFrame, ws: Workspace, hot: int = HOT) -> DataFrame:
    """(doc_id, start, len) of covered bytes of docs(doc_id, text), whose ids are distinct; runs may overlap."""
    spark = docs.sparkSession
    counts = docs.mapInArrow(_counts, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n")).where("n > 1").select("fp")
    again = spark.sparkContext.broadcast(Bitmap(ws.table(counts, "repeated"), "fp"))
    found = ws.table(docs.mapInArrow(_suspects(again), "fp long, digest binary, doc_id long, start int, len int, anchor int"), "suspects")
    again.destroy()
    ws.drop("repeated")
    where = F.col("doc_id").cast(T.DecimalType(20, 0)) * F.lit(_STEP) + F.col("start").cast(T.DecimalType(15, 0))
    head, doc_of, start_of = _first(where)
    classes = found.groupBy("fp", "digest").agg(head.alias("head"), F.min("len").alias("len"), F.min("anchor").alias("anchor"))  # equal bytes: the same length and anchor
    classes = ws.table(classes.select("fp", "digest", doc_of(F.col("head")).alias("head_doc"), start_of(F.col("head")).alias("head_start"), "len", "anchor"), "classes")
    repeats = found.join(classes.select("fp", "digest", "head_doc", "head_start"), ["fp", "digest"]).where((F.col("doc_id") != F.col("head_doc")) | (F.col("start") != F.col("head_start"))).select("doc_id", "start", "len")
    repeats = ws.table(repeats, "repeats")
    ws.drop("suspects")
    # Written, so that the join below reads plain rows on both sides and a hot anchor's rows are split.
    several = ws.table(classes.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("fp"), "several")
    heads = classes.join(several, "fp", "left_semi").groupBy(F.col("head_doc").alias("_head")).agg(F.collect_list(F.struct(F.col("head_start").alias("start"), "len", "anchor")).alias("fragments"))  # of one text
    parts = docs.join(heads, F.col("doc_id") == F.col("_head")).select("doc_id", "text", "fragments").mapInArrow(_parts, "key long, doc_id long, start int, body binary")
    parts = ws.table(parts, "parts")
    ws.drop("classes", "several")
    sizes = ws.table(parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    shared = parts.join(sizes.where(F.col("n") <= hot).select("key"), "key", "left_semi")
    shards = shared.repartition("key").sortWithinPartitions("key", "doc_id", "start").mapInArrow(_shards, "doc_id long, start int, len int")
    shards = ws.table(shards, "shards")
    out = repeats.union(shards)
    crowded = sizes.where(F.col("n") > hot).select("key")
    if not crowded.isEmpty():
        windows = ws.table(parts.join(F.broadcast(crowded), "key", "left_semi").select("doc_id", "start", "body").mapInArrow(_windows, "digest binary, doc_id long, start int"), "windows")  # at most one key for every `hot` parts
        head, doc_of, start_of = _first(where)
        firsts = windows.groupBy("digest").agg(head.alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1").select("digest", doc_of(F.col("head")).alias("head_doc"), start_of(F.col("head")).alias("head_start"))
        later = windows.join(firsts, "digest").where((F.col("doc_id") != F.col("head_doc")) | (F.col("start") != F.col("head_start"))).select("doc_id", "start", F.lit(LENGTH).alias("len"))
        out = out.union(ws.table(later, "crowded"))
        ws.drop("windows")
    ws.drop("parts", "sizes")
    return out


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty; texts under 100 bytes lose nothing; of equal texts of 100 bytes or more all but the one with
    the smallest doc_id are removed in full. Rows with equal doc_ids are documents of their own, in the order of their
    texts; rows without a doc_id come first. Texts of any length are read whole. Extra columns are ignored; an empty
    table gives an empty result.
    """
    ws = Workspace(docs.sparkSession, "suffix-dedup")
    rows = docs.select(F.col(id_col).cast("long").alias("own"), F.col(text_col).alias("text"))
    if rows.groupBy("own").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR own IS NULL").isEmpty():
        rows = rows.withColumn("doc_id", F.col("own"))
    else:  # places in the whole order stand for ids
        ranged = rows.repartitionByRange("own", F.substring("text", 1, 16)).sortWithinPartitions("own", "text")
        rows = ws.table(ranged.withColumn("doc_id", F.monotonically_increasing_id()), "rows")
    runs = repeated_runs(rows.select("doc_id", "text"), ws).groupBy("doc_id").agg(F.collect_list(F.struct("start", "len")).alias("r"))
    runs = runs.select(F.col("doc_id").alias("_id"), "r.start", "r.len")
    joined = rows.join(runs, F.col("doc_id") == F.col("_id"), "left").select("own", "text", "start", "len")
    return joined.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
