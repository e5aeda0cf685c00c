"""Conversation prefix trie: succinct level-order tries per prefix shard, heavy upper levels merged in the cluster.

1. Turns are numbered and conversations rebuilt by equi-joins; from here on a turn is 16 bytes of its SHA-256 and its size.
2. A prefix is known by the sum of its turns' digests, each mixed with its place: two lanes of 64 bits. Such sums run over sorted
   ranges: a conversation that fills several tasks goes on from what the tasks before it held, one small row a task.
3. Prefixes with more than HEAVY turns below them, counted with repetition, and the root, are the upper levels. The first
   prefix of a conversation beyond them is its shard's key; no shard has more than HEAVY rows, however common a beginning is.
4. Tasks take whole shards, about CHUNK rows at a time, number their nodes level by level, write the tries as LOUDS bits (a node
   is one 1 for each child and a 0) with labels in the same order, read parents and degrees off the bits, and roll leaves
   and bytes up with add.at from the last level to the first.
5. An upper node gets its counts by aggregation, the totals of the shards below it by another, and those of the upper nodes below
   it through one member of each: a node's value stands in the row of its smallest member, values are summed from the end of that
   member's path, and these sums are added up for each node.
6. Ends of upper nodes are put in order over ranges and joined to pieces before one task hashes a node's pieces one after the other.

Prefixes are compared by 128 bits made of cryptographic digests; texts stay where they are read.
"""

from __future__ import annotations

from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, mix64

GROUP, HEADS = 5, 9
#: Rows below an upper node; rows of a chunk of shards; upper nodes that are broadcast; conversations of a piece.
HEAVY, CHUNK, FEW, PIECE = 1 << 10, 1 << 16, 100_000, 1 << 13
NO_ENDS = sha256(b"").hexdigest()
_U = np.uint64
_LANES = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))
_ROW = ["c", "d", "size", "n_bytes", "lo", "hi", "plo", "phi"]
_WRAP = Decimal(2**64)
_HALF = Decimal(2**63)


def _signed(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def running(df: DataFrame, ws: Workspace, name: str, order: list[Column], lanes, n: int, prior: bool = False) -> DataFrame:
    """df with columns run0 .. : sums of its lanes over the rows of a key (df's first column, a long) so far, in the given order.

    lanes(batch) gives the values as n columns of uint64; sums are modulo 2^64. With prior, before0 .. are the sums without the
    row itself. The order starts with the key. Ranges of rows are summed by one task each and written; where a key
    began in an earlier range, what it had there is added, from one row for each range.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs, befores = [f"run{i}" for i in range(n)], [f"before{i}" for i in range(n)] if prior else []
    schema = T.StructType([*df.schema.fields, *(T.StructField(x, T.LongType()) for x in [*runs, *befores, "part", "at"]), T.StructField("lead", T.BooleanType())])

    def sums(batches):
        part, at, first, last, carry = TaskContext.get().partitionId(), 0, None, None, np.zeros(n, np.uint64)
        for batch in batches:
            key = batch.column(0).to_numpy()
            if not len(key):
                continue
            own = lanes(batch)
            total = np.cumsum(own, 0, dtype=np.uint64)
            new = np.flatnonzero(key[1:] != key[:-1]) + 1
            before = np.zeros((len(new) + 1, n), np.uint64)
            before[1:] = total[new - 1]
            if key[0] == last:
                before[0] -= carry
            run = total - np.repeat(before, np.diff(np.concatenate([[0], new, [len(key)]])), 0)
            first = key[0] if first is None else first
            last, carry = key[-1], run[-1]
            extra = [*run.T, *((run - own).T if prior else ())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in extra), pa.array(np.full(len(key), part, np.int64)), pa.array(np.arange(at, at + len(key))), pa.array(key == first)],
                names=schema.names,
            )
            at += len(key)

    table = ws.table(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(sums, schema), name)
    key = df.columns[0]
    ends = table.groupBy("part").agg(F.min_by(key, "at").alias("first"), F.max_by(F.struct(F.col(key).alias("key"), *runs), "at").alias("last")).collect()
    carries, held, so_far = [], None, [0] * n
    for r in sorted(ends, key=lambda r: r["part"]):
        goes_on = r["first"] == held
        if goes_on:
            carries.append((r["part"], True, *map(_signed, so_far)))
        alone = goes_on and r["last"]["key"] == held
        held, so_far = r["last"]["key"], [(r["last"][x] + (so_far[i] if alone else 0)) % (1 << 64) for i, x in enumerate(runs)]
    if carries:
        more = spark.createDataFrame(carries, ", ".join(["part long", "lead boolean", *(f"_carry{i} long" for i in range(n))]))
        table = table.join(F.broadcast(more), ["part", "lead"], "left")
        wide = lambda x: x.cast(T.DecimalType(20, 0))
        wrapped = lambda a, b: (F.pmod(wide(a) + wide(b) + F.lit(_HALF), F.lit(_WRAP)) - F.lit(_HALF)).cast("long")
        for x, i in [*((x, i) for i, x in enumerate(runs)), *((x, i) for i, x in enumerate(befores))]:
            carry = F.col(f"_carry{i}")
            table = table.withColumn(x, F.when(carry.isNull(), F.col(x)).otherwise(wrapped(F.col(x), carry)))
    return table.select(*df.columns, *runs, *befores)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(c, turn, digest, n_bytes) of every turn that has a conversation."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    return conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("c"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def rebuilt(conversations: DataFrame, ws: Workspace) -> DataFrame:
    """(c, d, size, digest, n_bytes): the turns of every rebuilt conversation by depth d of `size`, and a row at depth 0 for each.

    Turns that share a conversation's turn number follow their digests; equal rows are each a turn.
    """
    rows = ws.table(turns_of(conversations).withColumn("tie", F.monotonically_increasing_id()), "turns")
    ones = lambda batch: np.ones((batch.num_rows, 1), np.uint64)
    placed = running(rows, ws, "placed", [F.col("c"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")], ones, 1).select("c", F.col("run0").alias("p"), "digest", "n_bytes")
    c = F.col("c")
    sizes = ws.table(placed.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "sizes")
    own = sizes.select("c", (c - c % GROUP).alias("b"), "n", (F.crc32(c.cast("string")) % HEADS).alias("h"))
    k = F.least("h", F.coalesce("n_b", F.lit(0)))
    convs = ws.table(
        own.join(sizes.select(c.alias("b"), F.col("n").alias("n_b")), "b", "left").select("c", "b", "h", k.alias("k"), (k + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "convs"
    )
    out = ["c", "d", "size", "digest", "n_bytes"]
    tails = placed.join(convs.drop("b"), "c").where("p > h").withColumn("d", F.col("p") - F.col("h") + F.col("k"))
    heads = placed.where((c % GROUP == 0) & (F.col("p") < HEADS)).withColumnRenamed("c", "b").join(convs, "b").where("p <= h").withColumn("d", F.col("p"))
    roots = convs.select("c", F.lit(0).cast("long").alias("d"), "size", F.unhex(F.lit("00" * 16)).alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
    return ws.table(tails.select(*out).union(heads.select(*out)).union(roots), "rebuilt")


def _keyed(batch: pa.RecordBatch) -> np.ndarray:
    """A turn's two lanes: halves of its digest mixed with its depth; zero at the root."""
    d = batch.column(1).to_numpy().astype(np.uint64)
    _, offsets, data = batch.column(3).buffers()
    n, first = batch.num_rows, batch.column(3).offset
    start = int(np.frombuffer(offsets, np.int32)[first])
    halves = np.frombuffer(data, np.uint8)[start : start + 16 * n].copy().view(np.uint64).reshape(n, 2)
    out = np.stack([mix64(halves[:, i] ^ mix64(d * lane)) for i, lane in enumerate(_LANES)], 1)
    out[d == 0] = 0
    return out


class Louds:
    """A level-order trie: bits (for each node a 1 for each child, then a 0) and the labels of its nodes but the first."""

    def __init__(self, degrees: np.ndarray, labels: np.ndarray):
        bits = np.ones(int(degrees.sum()) + len(degrees), np.uint8)
        bits[np.cumsum(degrees + 1) - 1] = 0
        self.n_bits, self.bits, self.labels = len(bits), np.packbits(bits), labels

    def _bits(self) -> np.ndarray:
        return np.unpackbits(self.bits, count=self.n_bits)

    def degrees(self) -> np.ndarray:
        """Children of each node: the ones between two zeros."""
        return np.diff(np.flatnonzero(self._bits() == 0), prepend=-1) - 1

    def parents(self) -> np.ndarray:
        """Parent of each node but the first: zeros before its one."""
        ones = np.flatnonzero(self._bits())
        return ones - np.arange(len(ones))


def level_order(node: np.ndarray, level: np.ndarray, up: np.ndarray, label: np.ndarray) -> tuple[Louds, np.ndarray, np.ndarray]:
    """(trie, its number of each node, first number of each level) of nodes 0 .. with their level (from 1), parent (-1: the root) and label."""
    n = len(node)
    by_level = np.argsort(level, kind="stable")
    cut = np.searchsorted(level[by_level], np.arange(1, int(level.max(initial=0)) + 2))
    number, at, first = np.zeros(n, np.int64), 1, [0]
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        own = by_level[a:b]
        over = np.where(up[own] < 0, 0, number[up[own]])
        own = own[np.lexsort((label[own], over))]
        number[own] = np.arange(at, at + len(own))
        first.append(at)
        at += len(own)
    ordered = np.empty(n, np.int64)
    ordered[number - 1] = np.arange(n)
    over = np.where(up[ordered] < 0, 0, number[up[ordered]])
    return Louds(np.bincount(over, minlength=n + 1), label[ordered]), number, np.array([*first, at])


def _shards(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The nodes of whole shards with their rollups, from rows (_ROW and the shard's key)."""
    c, d, lo, hi = (rows[x] for x in ("c", "d", "lo", "hi"))
    order = np.lexsort((c, hi, lo, d))
    new = np.ones(len(c), bool)
    new[1:] = (lo[order][1:] != lo[order][:-1]) | (hi[order][1:] != hi[order][:-1]) | (d[order][1:] != d[order][:-1])
    node = np.empty(len(c), np.int64)
    node[order] = np.cumsum(new) - 1
    head = order[new]  # the row of a node's smallest member
    count = np.diff(np.append(np.flatnonzero(new), len(c)))
    # A row's parent is the row before it on its conversation's path; a path's first row is its shard's root.
    path = np.lexsort((d, c))
    top = np.ones(len(c), bool)
    top[path[1:]] = c[path[1:]] != c[path[:-1]]
    above = np.full(len(c), -1, np.int64)
    above[path[1:]] = node[path[:-1]]
    above[top] = -1
    up = above[head]
    begins = np.repeat(np.flatnonzero(top[path]), np.diff(np.append(np.flatnonzero(top[path]), len(c))))
    level = np.empty(len(c), np.int64)
    level[path] = np.arange(len(c)) - begins + 1
    trie, number, first = level_order(np.arange(len(head)), level[head], up, (lo - rows["plo"])[head])
    parents, n = trie.parents(), len(head)
    back = np.empty(n, np.int64)
    back[number - 1] = np.arange(n)
    degrees = trie.degrees()
    leaves = (degrees == 0).astype(np.int64)
    saved = np.concatenate([[0], ((count - 1) * rows["n_bytes"][head])[back]])
    for a, b in zip(first[-2:0:-1], first[:1:-1], strict=True):
        np.add.at(leaves, parents[a - 1 : b - 1], leaves[a:b])
        np.add.at(saved, parents[a - 1 : b - 1], saved[a:b])
    ended = np.flatnonzero(d == rows["size"])
    ended = ended[np.lexsort((c[ended], node[ended]))]
    cut = np.searchsorted(node[ended], np.arange(n + 1))
    texts = c[ended].astype(str)
    ends = [sha256(",".join(texts[cut[i] : cut[i + 1]]).encode()).hexdigest() if cut[i] < cut[i + 1] else NO_ENDS for i in range(n)]
    least = c[head]
    return {
        "conv_id": least, "depth": d[head], "parent_conv_id": np.where(up < 0, -1, least[up]), "n_convs": count, "n_children": degrees[number], "n_leaves": leaves[number],
        "saved_tokens": saved[number], "ends_sha256": ends, "plo": rows["plo"][head], "phi": rows["phi"][head], "top": up < 0,
    }


_LONGS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_SHARD_SCHEMA = ", ".join([*(f"{x} long" for x in _LONGS), "ends_sha256 string, plo long, phi long, top boolean"])
_FIELDS = pa.schema([*((x, pa.int64()) for x in _LONGS), ("ends_sha256", pa.string()), ("plo", pa.int64()), ("phi", pa.int64()), ("top", pa.bool_())])


def _tries(batches):
    """Whole shards, sorted by key, gathered to chunks of some CHUNK rows."""
    names = [*_ROW, "slo", "shi"]

    def built(parts):
        rows = {x: np.concatenate([p[x] for p in parts]) for x in names}
        made = _shards(rows)
        return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in _FIELDS], schema=_FIELDS)

    held, n = [], 0
    for batch in batches:
        own = {x: batch.column(i).to_numpy() for i, x in enumerate(names)}
        if not batch.num_rows:
            continue
        if n >= CHUNK:
            # What is left of the shard that the last batch ended in belongs to it; HEAVY rows at most.
            last = held[-1]
            same = (own["slo"] == last["slo"][-1]) & (own["shi"] == last["shi"][-1])
            if same.any():
                held.append({x: v[same] for x, v in own.items()})
                own = {x: v[~same] for x, v in own.items()}
            if len(own["c"]):
                yield built(held)
                held, n = [], 0
        if len(own["c"]):
            held.append(own)
            n += len(own["c"])
    if held:
        yield built(held)


def _pieces(batches):
    """Ids of each node in order, joined to texts of PIECE ids at most: (lo, hi, first id, text)."""
    for batch in batches:
        lo, hi, c = (batch.column(i).to_numpy() for i in range(3))
        if not len(c):
            continue
        new = np.flatnonzero((lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        cuts = sorted({*new.tolist(), *range(0, len(c), PIECE), len(c)})
        text = c.astype(str)
        at = cuts[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lo[at]), pa.array(hi[at]), pa.array(c[at]), pa.array([",".join(text[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])], names=["lo", "hi", "first", "ids"]
        )


def _hashes(batches):
    """(lo, hi, ends_sha256) from pieces in order, one after the other."""
    key, state, out = None, None, []
    for batch in batches:
        for lo, hi, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
            if (lo, hi) != key:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (lo, hi), sha256(ids.as_buffer())
            else:
                state.update(b",")
                state.update(ids.as_buffer())
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["lo", "hi", "ends_sha256"])
            out = []
    if key:
        out.append((*key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["lo", "hi", "ends_sha256"])


def prefix_trie(conversations: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conv_id belong to no conversation. A null role or text is empty; a null turn comes first; turns of one number
    follow the SHA-256 of role and text, and repeated rows are turns of their own. Texts of any length count by digest and size. The
    first turns come from conversation c - c % 5 with the sign of c (-3 takes them from 0). An empty table has no node. Other
    columns are ignored.
    """
    ws = Workspace(conversations.sparkSession, "trie")
    rows = running(rebuilt(conversations, ws), ws, "paths", [F.col("c"), F.col("d")], _keyed, 2, prior=True)
    rows = rows.select("c", "d", "size", "n_bytes", F.col("run0").alias("lo"), F.col("run1").alias("hi"), F.col("before0").alias("plo"), F.col("before1").alias("phi"))
    ws.drop("turns", "placed", "sizes", "convs", "rebuilt")
    node = ["lo", "hi"]
    nodes = rows.groupBy(*node).agg(
        F.min("d").alias("depth"), F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.min("plo").alias("plo"), F.min("phi").alias("phi"),
        F.sum(F.col("size") - F.col("d") + 1).alias("below"),
    )
    upper = ws.table(nodes.where((F.col("below") > heavy) | (F.col("depth") == 0)).drop("below"), "upper")
    few = upper.count() <= FEW
    sent = lambda df: F.broadcast(df) if few else df

    # Shards: a conversation's rows beyond the upper levels, HEAVY at most, keyed by the first of them.
    light = rows.join(sent(upper.select(*node)), node, "left_anti").select(*_ROW)
    key = F.first(F.struct("lo", "hi")).over(Window.partitionBy("c").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    keyed = light.withColumn("key", key).select(*_ROW, F.col("key.lo").alias("slo"), F.col("key.hi").alias("shi"))
    shards = ws.table(keyed.repartition("slo", "shi").sortWithinPartitions("slo", "shi").mapInArrow(_tries, _SHARD_SCHEMA), "shards")

    over = [F.col("plo").alias("lo"), F.col("phi").alias("hi")]
    tops = shards.where("top").groupBy(*over).agg(F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    kids = upper.where("depth > 0").groupBy(*over).agg(F.count(F.lit(1)).alias("upper_kids"))
    zero = F.lit(0)
    valued = upper.join(tops, node, "left").join(kids, node, "left").select(
        *upper.columns, (F.coalesce("kids", zero) + F.coalesce("upper_kids", zero)).alias("n_children"), F.coalesce("leaves", zero).alias("leaves"), (F.coalesce("saved", zero) + (F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved")
    )
    valued = ws.table(valued.withColumn("leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long")), "valued")
    reps = upper.select(F.col("conv_id").alias("c")).distinct()
    own = F.col("c") == F.col("conv_id")
    paths = rows.select("c", "d", *node).join(sent(reps), "c", "left_semi").join(sent(valued.select(*node, "conv_id", "leaves", "saved")), node)
    paths = paths.select("c", "d", *node, *(F.when(own, F.col(x)).otherwise(0).alias(x) for x in ("leaves", "saved")))
    both = lambda batch: np.stack([batch.column(i).to_numpy().astype(np.uint64) for i in (4, 5)], 1)
    totals = running(paths, ws, "values", [F.col("c"), F.col("d").desc()], both, 2).groupBy(*node).agg(F.sum("run0").alias("n_leaves"), F.sum("run1").alias("saved_tokens"))

    ended = rows.where("d = size").select(*node, "c").join(sent(upper.select(*node)), node, "left_semi").select(*node, "c")
    order = [*node, "c"]
    pieces = ended.repartitionByRange(int(ws.spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).mapInArrow(_pieces, "lo long, hi long, first long, ids string")
    ends = pieces.repartition(*node).sortWithinPartitions(*node, "first").mapInArrow(_hashes, "lo long, hi long, ends_sha256 string")

    parent = sent(upper.select(F.col("lo").alias("plo"), F.col("hi").alias("phi"), F.col("conv_id").alias("parent_conv_id")))
    columns = [*_LONGS, "ends_sha256"]
    root = F.col("depth") == 0
    above = valued.drop("leaves", "saved").join(totals, node).join(ends, node, "left").join(parent, ["plo", "phi"], "left")
    above = above.withColumns({"ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS)), "parent_conv_id": F.when(~root, F.col("parent_conv_id"))})
    first = shards.where("top").drop("parent_conv_id").join(parent, ["plo", "phi"])
    return shards.where("NOT top").select(*columns).union(first.select(*columns)).union(above.select(*columns))



#: CRC-32 (polynomial 0xEDB88320, reflected) written out, rebuilt conversations as lists, a node's ancestors by its smallest member's path.
ORACLE = f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(struct_pack(r := r, x := x) ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS turns FROM t GROUP BY c),
h AS (
  SELECT c, turns, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT)), lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % {HEADS} AS h
  FROM own, crc
), re AS (SELECT h.c, coalesce(b.turns[1 : h.h], []) || h.turns[h.h + 1 :] AS turns FROM h LEFT JOIN own b ON b.c = h.c - h.c % {GROUP}),
rows AS MATERIALIZED (SELECT c, d, len(turns) AS size, turns[1 : d] AS pre FROM re, unnest(range(len(turns) + 1)) u(d)),
nodes AS MATERIALIZED (
  SELECT d, pre, min(c) AS conv_id, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = size) AS ends, coalesce(strlen(pre[d].x), 0) AS n_bytes FROM rows GROUP BY d, pre
), named AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM nodes),
paths AS MATERIALIZED (SELECT c, rows.d, id FROM rows JOIN named USING (d, pre)),
kids AS MATERIALIZED (SELECT p.id AS up, count(*) AS n_children FROM named k JOIN paths p ON p.c = k.conv_id AND p.d = k.d - 1 GROUP BY 1),
below AS (
  SELECT p.id, (sum(k.n_children IS NULL))::BIGINT AS n_leaves, (sum((x.n - 1) * x.n_bytes))::BIGINT AS saved_tokens
  FROM named x JOIN paths p ON p.c = x.conv_id AND p.d <= x.d LEFT JOIN kids k ON k.up = x.id GROUP BY 1
)
SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(k.n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM named x JOIN below USING (id) LEFT JOIN kids k ON k.up = x.id LEFT JOIN paths p ON p.c = x.conv_id AND p.d = x.d - 1 LEFT JOIN named u ON u.id = p.id
"""
