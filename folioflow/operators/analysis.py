"""Analysis of record tables: counts, descriptions, histograms, shares, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    return (df.where(F.col(column).isNotNull()) if dropna else df).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def mean_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Means by group, groups with a null key left out."""
    return df.na.drop(subset=keys).groupBy(*keys).agg(F.avg(value).alias("mean_value"))


def describe(df: DataFrame, value: str, places: int = 6, accuracy: int | None = None) -> DataFrame:
    """count, mean, sample deviation, least, linear quartiles and greatest, in one pass.

    Exact quartiles hold a count of every distinct value in one buffer; where these are too many, `accuracy` asks for
    approximate ones, off by at most 1 / accuracy in rank.
    """
    c = F.col(value).cast("double")
    at = lambda q: F.percentile(c, F.lit(q)) if accuracy is None else F.percentile_approx(c, q, accuracy)
    quart = [F.round(at(q), places).alias(n) for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    return df.agg(F.count(c).alias("n"), F.round(F.avg(c), places).alias("mean"), F.round(F.stddev_samp(c), places).alias("std"), F.min(c).alias("least"), *quart, F.max(c).alias("most"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Counts in equal bins from least to greatest, the last closed on the right."""
    rows = df.where(F.col(value).isNotNull())
    low, high = (df.agg(f(value)).scalar() for f in (F.min, F.max))
    slot = F.when(low == high, 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - low) / (high - low) * bins)))
    return rows.select(slot.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, column: str) -> DataFrame:
    got = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return got.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


def distribution(df: DataFrame, kind: str, value: str, places: int = 6) -> DataFrame:
    """describe for each kind: the figures of a violin plot."""
    c = F.col(value).cast("double")
    quart = [F.round(F.percentile(c, F.lit(q)), places).alias(n) for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    return df.groupBy(kind).agg(F.count(c).alias("n"), F.min(c).alias("least"), *quart, F.max(c).alias("most"))


def f1_each(df: DataFrame, tp: str, fp: str, fn: str) -> DataFrame:
    """df with f1 of each row, from precision and recall; 0 without a true positive."""
    precision, recall = (F.col(tp) / F.nullif(F.col(tp) + F.col(x), F.lit(0)) for x in (fp, fn))
    return df.withColumn("f1", F.when(F.col(tp) != 0, F.bround(2 * precision * recall / (precision + recall), 2)).otherwise(0.0))


def checked_counts(df: DataFrame, tp: str, fn: str, entities: str) -> DataFrame:
    """df, with an error for a row whose true positives and false negatives are not all entities."""
    wrong = F.col(tp) + F.col(fn) != F.col(entities)
    return df.withColumn(entities, F.when(wrong, F.raise_error(F.lit("true positives and false negatives must sum to the entities"))).otherwise(F.col(entities)))


def status_counts(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def cost(df: DataFrame, tokens_in: str, tokens_out: str, price_in: float, price_out: float) -> DataFrame:
    """Tokens used and what they cost, prices by a million tokens."""
    a, b = F.coalesce(F.sum(tokens_in), F.lit(0)), F.coalesce(F.sum(tokens_out), F.lit(0))
    return df.agg(a.alias("tokens_in"), b.alias("tokens_out"), F.round((a * price_in + b * price_out) / 1e6, 9).alias("cost"))


def seeded_sample(df: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """n rows by the hash of their key: the same rows for the same seed, whatever the partitions."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)


def f1(df: DataFrame, tp: str, fp: str, fn: str) -> DataFrame:
    """Micro-averaged 2TP / (2TP + FP + FN) with its counts."""
    s = [F.sum(c).cast("long") for c in (tp, fp, fn)]
    return df.agg(s[0].alias("tp"), s[1].alias("fp"), s[2].alias("fn"), F.bround(2 * s[0] / F.nullif(2 * s[0] + s[1] + s[2], F.lit(0)), 2).alias("f1"))


def best_of_iteration(df: DataFrame, iteration: str, score: str, order: str) -> DataFrame:
    """The best candidate of each iteration, ties by order."""
    w = Window.partitionBy(iteration).orderBy(F.desc(score), order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def probe_size(n):
    """(probe, stop): 30 of more than 100, else 10; stop when the probe is all there is."""
    probe = F.when(n > 100, 30).otherwise(10)
    return F.struct(probe.alias("probe"), (n <= probe).alias("stop"))


def token_bucket(df: DataFrame, key: str, seconds: str, need: str, rate: float, capacity: float) -> DataFrame:
    """Replay of a token bucket over requests in time order: what was in the bucket at each and whether it sufficed."""
    item = F.struct(F.col(seconds).cast("double").alias("t"), F.col(need).cast("double").alias("n"))
    steps = F.array_sort(F.collect_list(item))
    zero = F.struct(F.lit(float(capacity)).alias("have"), F.lit(None).cast("double").alias("t"), F.lit(0).cast("long").alias("served"), F.lit(0).cast("long").alias("refused"))

    def step(acc, x):
        have = F.least(F.lit(float(capacity)), acc["have"] + F.coalesce(x["t"] - acc["t"], F.lit(0.0)) * F.lit(float(rate)))
        ok = have >= x["n"]
        return F.struct(F.when(ok, have - x["n"]).otherwise(have).alias("have"), x["t"].alias("t"), (acc["served"] + ok.cast("long")).alias("served"), (acc["refused"] + (~ok).cast("long")).alias("refused"))

    return df.groupBy(key).agg(steps.alias("s")).select(key, F.aggregate("s", zero, step).alias("b")).select(key, F.round("b.have", 6).alias("have"), "b.served", "b.refused")
