"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic); a cell's mass is its tokens. The masses are raked until the
expected sample's shares by source, by language and by topic all meet their targets and every document of a cell has the
same calibrated probability. No probability may pass 1, and that is a bound of the iteration: a full cell stays at its
tokens while the others of its source, language and topic make up for it.

Topics are learned: distinct words fall into 256 buckets, a document is the vector of its buckets weighted by how few
documents have them, and k-means over all documents makes the topics. It starts from clusters of a sample, the
largest halved until there are enough, so that no outlier starts a topic; a topic left with too few words takes half of the
largest one. A document is its 256 counts there; each turn adds up whole numbers in the cluster, so topics do not depend on
the partitions, and the driver gets topics x 256 numbers.

Only the cell table is iterated on. Up to `driver_cells` cells (counted first) that is done in numpy on the driver;
beyond it, in the cluster, one aggregation and one join for each marginal, the state written after each sweep.
"""

from __future__ import annotations

import itertools
import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, blocks_of, text_view, word_hashes

DIMS = ("source", "lang", "topic")
TOPICS, BUCKETS, TURNS, SEEDS = 8, 256, 10, 512
#: Of a topic: the least share of all tokens, as a part of an even share.
LEAST = 0.15
SWEEPS, TOLERANCE = 200, 1e-10  # on both paths
#: Distance of a share from its target up to which it is met; what default targets ask for at most of what a value has; steps of
#: their power to 1.
MET, ROOM, STEPS = 1e-4, 0.9, 10
_HIGH = 1e12  # times its bound, a weight grows no more
_NONE = "\x00none"
_U = np.uint64


def _features(batches):
    """Words of each text, and its bag: the number of its distinct words in each bucket, null without words."""
    for batch in batches:
        raw, offs = text_view(batch.column(4))
        n, bags = [], []
        for a, b in blocks_of(offs, 2 << 20):
            words, at = word_hashes(raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            for i in range(b - a):
                own = words[at[i] : at[i + 1]]
                n.append(len(own))
                counts = np.bincount((np.unique(own) >> _U(56)).astype(np.int64), minlength=BUCKETS)
                bags.append(counts.astype(np.uint32).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(n, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "h", "source", "lang", "n_tokens", "bag"])


def _bags(column: pa.Array) -> np.ndarray:
    raw, _ = text_view(column)
    return np.ascontiguousarray(raw).view(np.uint32).reshape(-1, BUCKETS)


def _spread(batches):
    """How many documents of a task have each bucket."""
    have = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        have += (_bags(batch.column(0)) > 0).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(have)], ["bucket", "n"])


def _units(bags: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted vectors of length 1000, in whole numbers."""
    v = np.log1p(bags) * idf
    return np.rint(1000 * v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.int64)


def _nearest(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The centre at the smallest angle, the first at a tie."""
    lengths = np.maximum(np.linalg.norm(centres, axis=1), 1e-9)
    return np.argmax(np.round(units @ centres.T / lengths, 6), axis=1)


def _sums(idf: np.ndarray, centres: np.ndarray):
    """The vectors of each topic added up, in the place after the buckets its distinct words."""

    def run(batches):
        total = np.zeros((len(centres), BUCKETS + 1), np.int64)
        for batch in batches:
            bags = _bags(batch.column(0))
            units = _units(bags, idf)
            topic = _nearest(units, centres)
            np.add.at(total[:, :BUCKETS], topic, units)
            np.add.at(total[:, BUCKETS], topic, bags.sum(1, dtype=np.int64))
        topic, bucket = np.divmod(np.arange(total.size), BUCKETS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(topic), pa.array(bucket), pa.array(total.ravel())], ["topic", "bucket", "s"])

    return run


def _halves(units: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of the vectors make the second half of a cluster: two-means started along its longest axis; where one half would be
    small, the axis is cut at its middle."""
    off = units - units.mean(0)
    along = off @ np.linalg.svd(off, full_matrices=False)[2][0]
    along *= np.sign(along[np.argmax(np.abs(along))]) or 1.0
    second = along > 0
    for _ in range(TURNS):
        if second.all() or not second.any():
            break
        new = _nearest(units, np.stack([units[~second].sum(0), units[second].sum(0)])) == 1
        if (new == second).all():
            break
        second = new
    share = size[second].sum() / size.sum()
    return second if LEAST <= share <= 1 - LEAST else along > np.median(along)


def _start(units: np.ndarray, size: np.ndarray, topics: int) -> np.ndarray:
    """Sums of `topics` clusters of the vectors: the largest one by size is halved until there are as many."""
    parts, done = [np.arange(len(units))], []
    while parts and len(parts) + len(done) < topics:
        parts.sort(key=lambda own: -size[own].sum())
        own = parts.pop(0)
        second = _halves(units[own], size[own]) if len(own) > 1 else np.zeros(1, bool)
        if second.any() and not second.all():
            parts += [own[~second], own[second]]
        else:
            done.append(own)  # all alike
    return np.stack([units[own].sum(0) for own in [*parts, *done]])


def learn_topics(bags: DataFrame, topics: int = TOPICS, turns: int = TURNS, seeds: int = SEEDS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket weights, centres) of k-means over all bags(h, bag): started from the `seeds` bags with the smallest text hashes,
    then `turns` turns over every document. But for the last turns, one topic with fewer than LEAST of an even share of the distinct
    words takes half of the largest topic."""
    some = bags.where("bag IS NOT NULL").select("h", "bag")
    have = np.zeros(BUCKETS, np.int64)
    for bucket, n in some.select("bag").mapInArrow(_spread, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        have[bucket] = n
    idf = np.log((1 + have.max()) / (1 + have)) + 0.05
    share = min(1.0, 4 * seeds / max(1, some.count()))
    while True:  # the smallest hashes lie below a bound, which is raised where copies leave too few texts below it
        low = some if share >= 1 else some.where(F.col("h") < int(share * 2.0**64) - 2**63)
        first = low.groupBy("h").agg(F.min("bag").alias("bag")).orderBy("h").limit(seeds).toArrow()  # `seeds` rows
        if share >= 1 or first.num_rows >= seeds:
            break
        share = min(1.0, 8 * share)
    if not first.num_rows:
        return idf, np.zeros((1, BUCKETS), np.int64)
    own = _bags(first["bag"])
    units, size = _units(own, idf), np.minimum(own.sum(1, dtype=np.int64), 64)
    centres = _start(units, size, topics)
    for turn in range(turns):
        total = np.zeros((len(centres), BUCKETS + 1), np.int64)
        for topic, bucket, s in some.select("bag").mapInArrow(_sums(idf, centres), "topic long, bucket long, s long").groupBy("topic", "bucket").agg(F.sum("s")).collect():  # topics x 257 rows
            total[topic, bucket] = s
        words, new = total[:, BUCKETS], total[:, :BUCKETS]
        new = np.where(new.any(1, keepdims=True), new, centres)
        poor = np.flatnonzero(words * len(words) < LEAST * words.sum())
        if len(poor) and turn < turns - 3:
            inside = np.flatnonzero(_nearest(units, new) == np.argmax(words))
            second = _halves(units[inside], size[inside]) if len(inside) > 1 else np.zeros(len(inside), bool)
            if second.any() and not second.all():
                new[poor[0]], new[np.argmax(words)] = units[inside[second]].sum(0), units[inside[~second]].sum(0)
        if (new == centres).all():
            break
        centres = new
    return idf, centres


def with_topics(bags: DataFrame, idf: np.ndarray, centres: np.ndarray) -> DataFrame:
    """bags with topic in place of the bag, -1 without words."""

    def run(batches):
        for batch in batches:
            bag = batch.column(5)
            there = bag.is_valid().to_numpy(zero_copy_only=False)
            topic = np.full(len(there), -1, np.int32)
            if there.any():
                topic[there] = _nearest(_units(_bags(bag.drop_null()), idf), centres)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(topic), batch.column(4)], ["doc_id", "h", "source", "lang", "topic", "n_tokens"])

    return bags.mapInArrow(run, "doc_id long, h long, source string, lang string, topic int, n_tokens long")


def rake(cells: pd.DataFrame, targets: dict[str, dict], sweeps: int = SWEEPS, tol: float = TOLERANCE, budget: float | None = None) -> np.ndarray:
    """Shares of cells (DIMS, tokens) after raking to the target shares; cells that a marginal gives nothing get 0.

    With a budget no cell gets more than its tokens: of a marginal's value, cells that are full stay so and the weights of the
    others are multiplied by what makes up for it; where a value has too much, all its weights are.
    """
    tokens = cells["tokens"].to_numpy(float)
    most = tokens / budget if budget else np.full(len(tokens), np.inf)
    weight = tokens / max(1.0, float(tokens.sum()))
    codes = {d: pd.factorize(cells[d]) for d in DIMS}
    goal = {d: np.array([targets[d].get(v, 0.0) for v in codes[d][1]]) for d in DIMS}
    worst = 0.0
    for _ in range(sweeps):
        for d in DIMS:
            at = codes[d][0]
            have = np.bincount(at, np.minimum(weight, most), len(goal[d])).astype(float)
            free = np.bincount(at, np.where(weight < most, weight, 0.0), len(goal[d])).astype(float)
            less = np.divide(goal[d], have, out=np.zeros_like(have), where=have > 0)
            more = 1 + np.divide(goal[d] - have, free, out=np.zeros_like(have), where=free > 0)
            weight = np.minimum(weight * np.where(goal[d] < have, less, more)[at], _HIGH * most)
        mass = np.minimum(weight, most)
        worst = max(float(np.max(np.abs(np.bincount(codes[d][0], mass, len(goal[d])) - goal[d]), initial=0)) for d in DIMS)
        if worst < tol:
            break
    _unconverged(sweeps, worst)
    return np.minimum(weight, most)


def _unconverged(sweeps: int, off: float) -> None:
    if off > MET:
        warnings.warn(f"raking stopped after {sweeps} sweeps with a share still {off:.3g} off its target", RuntimeWarning, stacklevel=3)


def fill(tokens: np.ndarray, mass: np.ndarray, budget: float) -> np.ndarray:
    """Probabilities min(1, scale * mass / tokens) whose expected tokens are the budget, as far as the cells go; scale is 1 where
    raking has met its targets."""
    p = np.zeros(len(tokens))
    live, left = (mass > 0) & (tokens > 0), float(budget)
    while live.any() and left > 0:
        scale = left / mass[live].sum()
        full = live & (scale * mass >= tokens)
        if not full.any():
            p[live] = scale * mass[live] / tokens[live]
            break
        p[full] = 1.0
        left -= tokens[full].sum()
        live &= ~full
    return p


def attainable(goal: dict, most: dict) -> dict:
    """goal with no value above its `most`; the others take up the rest in their proportions."""
    full: set = set()
    while True:  # each turn but the last fills a value
        left = sum(g for v, g in goal.items() if v not in full)
        scale = max(0.0, 1 - sum(most.get(v, 0.0) for v in full)) / left if left else 0.0
        over = {v for v, g in goal.items() if v not in full and g * scale > most.get(v, 0.0)}
        if not over:
            return {v: most.get(v, 0.0) if v in full else g * scale for v, g in goal.items()}
        full |= over


def _calibrate(cells: pd.DataFrame, targets: dict[str, dict] | None, power: float, budget: float, room: float) -> tuple[pd.DataFrame, list]:
    """(cells with mass and probability, what misses the targets), on the driver."""
    has = {d: cells.groupby(d)["tokens"].sum().to_dict() for d in DIMS}
    for k in range(STEPS + 1):  # at a power of 1 every document has the same probability
        if targets is None:
            raised = {d: {v: float(n) ** (power + (1 - power) * k / STEPS) for v, n in has[d].items() if n} for d in DIMS}
            stated = goals = {d: attainable({v: w / sum(raised[d].values()) for v, w in raised[d].items()}, {v: room * n / budget for v, n in has[d].items()}) for d in DIMS}
        else:
            stated, goals = targets, {d: attainable(targets[d], {v: n / budget for v, n in has[d].items()}) for d in DIMS}
        with warnings.catch_warnings():
            warnings.simplefilter("ignore" if targets is None and k < STEPS else "default", RuntimeWarning)
            mass = rake(cells, goals, budget=budget)
        p = fill(cells["tokens"].to_numpy(float), mass, budget)
        taken = cells.assign(x=p * cells["tokens"] / budget)
        off = []
        for d in DIMS:
            have = taken.groupby(d)["x"].sum().to_dict()
            off += [(d, str(v), have.get(v, 0.0), stated[d].get(v, 0.0)) for v in {**have, **stated[d]}]
        unmet = [r for r in sorted(off, key=lambda r: (-abs(r[2] - r[3]), *r[:2]))[:10] if abs(r[2] - r[3]) > MET]
        if targets is not None or not unmet:
            break
    return cells.assign(mass=mass, probability=p), unmet


def _attainable_in_cluster(goals: DataFrame, dim: str, cells: DataFrame, budget: float, ws: Workspace, room: float = 1.0, turn: int = 0) -> DataFrame:
    """attainable() of goals(dim, goal), a value having at most `room` of its tokens."""
    has = cells.groupBy(dim).agg((F.sum("tokens") * F.lit(room / max(budget, 1.0))).alias("most"))
    now = ws.table(goals.join(has, dim).select(dim, "goal", "most", F.lit(False).alias("full")), f"goals-{turn}-{dim}-0")
    for k in itertools.count(1):  # each turn but the last fills a value
        taken, left = now.agg(F.sum(F.when(F.col("full"), F.col("most"))), F.sum(F.when(~F.col("full"), F.col("goal")))).first()
        scale = max(0.0, 1 - (taken or 0.0)) / left if left else 0.0
        over = ~F.col("full") & (F.col("goal") * scale > F.col("most"))
        if now.where(over).isEmpty():
            return now.select(dim, F.when(F.col("full"), F.col("most")).otherwise(F.col("goal") * scale).alias("goal"))
        now = ws.table(now.withColumn("full", F.col("full") | over), f"goals-{turn}-{dim}-{k}")


def _default_targets(cells: DataFrame, power: float, budget: float, room: float, ws: Workspace, turn: int = 0) -> dict[str, DataFrame]:
    out = {}
    for d in DIMS:
        share = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("w")).where("w > 0")
        whole = share.agg(F.sum("w")).first()[0] or 1.0
        out[d] = _attainable_in_cluster(share.select(d, (F.col("w") / F.lit(whole)).alias("goal")), d, cells, budget, ws, room, turn)
    return out


def _rake_in_cluster(cells: DataFrame, targets: dict[str, DataFrame], budget: float, ws: Workspace, sweeps: int = SWEEPS, tol: float = TOLERANCE, turn: int = 0) -> DataFrame:
    """cells with mass and probability: rake() with a budget, one aggregation and one join for each marginal of each sweep."""
    most, mass = F.col("tokens") / F.lit(max(budget, 1e-300)), F.least("weight", "most")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells.withColumn("most", most).withColumn("weight", F.col("tokens") / F.lit(max(1.0, float(total))))
    for k in range(sweeps):
        for d in DIMS:
            step = now.groupBy(d).agg(F.sum(mass).alias("have"), F.sum(F.when(F.col("weight") < F.col("most"), F.col("weight")).otherwise(0.0)).alias("free")).join(targets[d], d, "left")
            goal, have, free = F.coalesce("goal", F.lit(0.0)), F.col("have"), F.col("free")
            more = F.when(free > 0, 1 + (goal - have) / F.when(free > 0, free)).otherwise(1.0)
            now = now.join(step.select(d, F.when(goal < have, goal / F.when(have > 0, have)).otherwise(more).alias("f")), d).withColumn("weight", F.least(F.col("weight") * F.col("f"), F.lit(_HIGH) * F.col("most"))).drop("f")
        now = ws.table(now, f"rake-{turn}-{k}")
        off = None
        for d in DIMS:
            own = now.groupBy(d).agg(F.sum(mass).alias("have")).join(targets[d], d, "left").agg(F.max(F.abs(F.coalesce("goal", F.lit(0.0)) - F.col("have"))).alias("x"))
            off = own if off is None else off.union(own)
        worst = off.agg(F.max("x")).first()[0] or 0.0
        if k:
            ws.drop(f"rake-{turn}-{k - 1}")
        if worst < tol:
            break
    _unconverged(sweeps, worst)
    now, left, scale = now.select(*DIMS, "tokens", mass.alias("mass"), F.lit(False).alias("full")), budget, 0.0
    for k in itertools.count():  # fill(): each turn but the last fills a cell
        got = now.where("NOT full AND mass > 0 AND tokens > 0").agg(F.sum("mass")).first()[0]
        if not got or left <= 0:
            scale = 0.0
            break
        scale = left / got
        over = ~F.col("full") & (F.col("mass") > 0) & (F.col("tokens") > 0) & (scale * F.col("mass") >= F.col("tokens"))
        took = now.where(over).agg(F.sum("tokens")).first()[0]
        if not took:
            break
        left -= took
        now = ws.table(now.withColumn("full", F.col("full") | over), f"fill-{turn}-{k}")
        if k:
            ws.drop(f"fill-{turn}-{k - 1}")
    p = F.when(F.col("full"), 1.0).when(F.col("tokens") > 0, scale * F.col("mass") / F.when(F.col("tokens") > 0, F.col("tokens"))).otherwise(0.0)
    return now.select(*DIMS, "tokens", "mass", p.alias("probability"))


def _distances(calibrated: DataFrame, goals: dict[str, DataFrame], budget: float) -> list[tuple[str, object, float, float]]:
    """(dimension, value, expected share, target) of the ten values farthest from their targets, the farthest first."""
    every = None
    for d in DIMS:
        have = calibrated.groupBy(d).agg((F.sum(F.col("probability") * F.col("tokens")) / F.lit(max(budget, 1e-300))).alias("have"))
        own = have.join(goals[d], d, "full").select(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value"), F.coalesce("have", F.lit(0.0)).alias("have"), F.coalesce("goal", F.lit(0.0)).alias("goal"))
        every = own if every is None else every.union(own)
    return [tuple(r) for r in every.orderBy(F.abs(F.col("have") - F.col("goal")).desc(), "dim", "value").limit(10).collect()]


def _checked(targets: dict[str, dict], cells: DataFrame) -> None:
    """Targets must be shares: not negative, summing to 1, of values that there are."""
    for d in DIMS:
        shares = {(_NONE if k is None else k): float(v) for k, v in targets[d].items()}
        if any(v < 0 for v in shares.values()) or abs(sum(shares.values()) - 1) > 1e-6:
            raise ValueError(f"the target shares of {d} must not be negative and must sum to 1")
        wanted = [k for k, v in shares.items() if v > 0]
        there = {r[0] for r in cells.where(F.col(d).isin(wanted) & (F.col("tokens") > 0)).select(d).distinct().collect()}  # of the values named
        if missing := sorted(str(k) for k in wanted if k not in there):
            raise ValueError(f"no document has the target values of {d}: {', '.join(missing)}")


def _calibrate_in_cluster(cells: DataFrame, targets: dict[str, DataFrame] | None, power: float, budget: float, room: float, ws: Workspace) -> tuple[DataFrame, list]:
    """_calibrate() with the cells in the cluster."""
    for k in range(STEPS + 1):
        if targets is None:
            stated = goals = {d: ws.table(g, f"goal-{k}-{d}") for d, g in _default_targets(cells, power + (1 - power) * k / STEPS, budget, room, ws, k).items()}
        else:
            stated, goals = targets, {d: ws.table(_attainable_in_cluster(targets[d], d, cells, budget, ws), f"goal-{d}") for d in DIMS}
        with warnings.catch_warnings():
            warnings.simplefilter("ignore" if targets is None and k < STEPS else "default", RuntimeWarning)
            calibrated = ws.table(_rake_in_cluster(cells, goals, budget, ws, turn=k), f"calibrated-{k}")
        unmet = [r for r in _distances(calibrated, stated, budget) if abs(r[2] - r[3]) > MET]
        if targets is not None or not unmet:
            return calibrated, unmet
    return calibrated, unmet


def _mixture(docs: DataFrame, fraction: float, power: float, targets: dict[str, dict] | None, seed: int, driver_cells: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    ws = Workspace(spark, "mixing")
    known = [F.coalesce(F.col(c), F.lit(_NONE)).alias(c) for c in ("source", "lang")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"), *known, F.col(text_col).alias("text"))
    bags = ws.table(rows.mapInArrow(_features, "doc_id long, h long, source string, lang string, n_tokens long, bag binary"), "bags")
    rows = ws.table(with_topics(bags, *learn_topics(bags)), "rows")
    ws.drop("bags")
    cells = ws.table(rows.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    if targets is not None:
        _checked(targets, cells)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    budget = float(fraction * total)
    room = max(ROOM, fraction)
    if not budget:
        calibrated, unmet = cells.withColumn("mass", F.lit(0.0)).withColumn("probability", F.lit(0.0)), []
    elif cells.count() <= driver_cells:
        stated = None if targets is None else {d: {(_NONE if k is None else k): float(v) for k, v in targets[d].items()} for d in DIMS}
        local, unmet = _calibrate(cells.toPandas().sort_values(list(DIMS)).reset_index(drop=True), stated, power, budget, room)
        calibrated = F.broadcast(spark.createDataFrame(local, "source string, lang string, topic int, tokens long, mass double, probability double"))
    else:
        stated = None if targets is None else {d: spark.createDataFrame([(_NONE if k is None else k, float(v)) for k, v in targets[d].items()], f"{d} {'int' if d == 'topic' else 'string'}, goal double") for d in DIMS}
        calibrated, unmet = _calibrate_in_cluster(cells, stated, power, budget, room, ws)
    if unmet:
        named = ", ".join(f"{d} {'none' if v == _NONE else v} {have:.4f} of {goal:.4f}" for d, v, have, goal in unmet)
        warnings.warn(f"expected shares miss their targets by up to {abs(unmet[0][2] - unmet[0][3]):.3g}: {named}", RuntimeWarning, stacklevel=3)
    weight = F.when(F.col("tokens") > 0, F.col("mass") / F.when(F.col("tokens") > 0, F.col("tokens")) * float(total)).otherwise(0.0)
    named = lambda c: F.when(F.col(c) != _NONE, F.col(c)).alias(c)
    chance = uniform(F.coalesce("doc_id", "h"), seed)
    return rows.join(calibrated, list(DIMS)).select("doc_id", "h", named("source"), named("lang"), "topic", "n_tokens", weight.alias("weight"), "probability", (chance < F.col("probability")).alias("sampled"), F.lit(not unmet).alias("converged"))


def mixture(docs: DataFrame, fraction: float = 0.5, power: float = 0.5, targets: dict[str, dict] | None = None, seed: int = 17, driver_cells: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, source, lang, topic, n_tokens, weight, probability, sampled, converged.

    targets gives each value's share for each of source, lang and topic; without it, shares are the present ones to
    `power`, made to sum to 1, no value asked for more than ROOM of its tokens; where no sample has such shares, the power goes to 1
    in STEPS steps up to the first that one has. Targets that are no shares, or that ask for a
    value no document has, are an error; cells of values that they do not name get nothing. The expected tokens of the sample are
    `fraction` of all, and a document is taken once at most: a value with fewer tokens than its share asks for gives all, the
    others take up the rest. converged says whether every expected share is within MET of the target that was asked for; where
    one is not, a warning names the ten farthest.

    A null source or language is a value of its own (None in targets); texts without words have topic -1, no tokens,
    weight and probability 0. Sampling hashes doc_id, or the text where there is none, so it is repeatable and rows with
    the same id fare alike where their cells do. Texts are read whole. Extra columns are ignored; an empty table gives none.
    """
    return _mixture(docs, fraction, power, targets, seed, driver_cells, id_col, text_col).drop("h")


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the key."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def sample(docs: DataFrame, fraction: float = 0.5, power: float = 0.5, targets: dict[str, dict] | None = None, seed: int = 17, driver_cells: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sampled rows of docs, with all their columns."""
    kept = _mixture(docs, fraction, power, targets, seed, driver_cells, id_col, text_col).where("sampled")
    cells = kept.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.col("source").alias("_s"), F.col("lang").alias("_l")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(cells["_id"]) & (F.xxhash64(docs[text_col]) == cells["_h"]) & docs["source"].eqNullSafe(cells["_s"]) & docs["lang"].eqNullSafe(cells["_l"])
    return docs.join(cells, same, "left_semi")
