"""Prompts made better: every candidate scored on every row in one plan, halved on growing shares of the rows, shown examples it
has solved itself, and replaced by what is proposed from its failures.

rows have (id, input, expected array<string>); a model is a function of (prompt, input) to a list of texts. Scores are
micro-averaged over rows. Only scores, the examples shown and the rows fed back come to the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.analysis import checked_counts, f1_each
from ..sources.store import stored

Model = Callable[[str, str], list]
#: Rows fed back about a prompt: failed, passed; earlier prompts shown beside it.
FAILED, PASSED, TRIED = 10, 3, 5


@dataclass(frozen=True)
class Attempt:
    """A prompt with the round it came from (-1: with examples) and its scores."""

    prompt: str
    iteration: int
    train: float
    validation: float | None = None


def distinct(prompts: list[str]) -> list[str]:
    """Prompts that differ in more than case and white space, the first of each kind."""
    seen: dict[str, str] = {}
    for p in prompts:
        seen.setdefault(" ".join(p.split()).casefold(), p)
    return list(seen.values())


def attempts(prompts: list[str], rows: DataFrame, model: Model) -> DataFrame:
    """(candidate, id, input, expected, got, error, tp, fp, fn, f1): each prompt, by its place in the list, on each row.

    A failing call gives nothing and says why. tp + fn must be the number of distinct expected texts, or the job fails.
    """

    @F.pandas_udf("got array<string>, error string")
    def ask(candidates: pd.Series, inputs: pd.Series) -> pd.DataFrame:
        out = []
        for c, text in zip(candidates, inputs, strict=True):
            try:
                out.append(([str(x) for x in model(prompts[c], text or "")], None))
            except Exception as e:
                out.append(([], f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["got", "error"], dtype=object)

    both = rows.select("id", "input", F.array_distinct(F.coalesce("expected", F.array().cast("array<string>"))).alias("expected"), F.explode(F.sequence(F.lit(0), F.lit(len(prompts) - 1))).alias("candidate"))
    done = both.withColumn("_a", ask("candidate", "input")).select("candidate", "id", "input", "expected", F.array_distinct("_a.got").alias("got"), "_a.error")
    size = lambda c: F.size(c).cast("long")
    counted = done.withColumns({"tp": size(F.array_intersect("expected", "got")), "fp": size(F.array_except("got", "expected")), "fn": size(F.array_except("expected", "got")), "_n": size("expected")})
    return f1_each(checked_counts(counted, "tp", "fn", "_n"), "tp", "fp", "fn").withColumn("f1", F.when((F.col("_n") == 0) & (F.col("fp") == 0), 1.0).otherwise(F.col("f1"))).drop("_n")


def scores(tried: DataFrame) -> DataFrame:
    """(candidate, tp, fp, fn, f1) over all rows of attempts()."""
    s = {c: F.sum(c).alias(c) for c in ("tp", "fp", "fn")}
    got = tried.groupBy("candidate").agg(*s.values())
    return got.withColumn("f1", 2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)))


def scored(prompts: list[str], rows: DataFrame, model: Model) -> list[float]:
    got = {r["candidate"]: r["f1"] or 0.0 for r in scores(attempts(prompts, rows, model)).collect()}  # a row a prompt
    return [got.get(i, 0.0) for i in range(len(prompts))]


def share(key: str, seed: int) -> Column:
    """A number in [0, 1) that the row keeps."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def halved(prompts: list[str], rows: DataFrame, model: Model, keep: int = 1, first: float = 0.25, seed: int = 7) -> list[tuple[str, float]]:
    """The `keep` best prompts with their scores on the last rung: the first rung takes `first` of the rows, each keeps the better half
    and takes twice as many rows, until as few are left and all rows are in. Ties go to the earlier prompt."""
    left, part = distinct(prompts), first
    while True:
        some = rows if part >= 1 else rows.where(share("id", seed) < part)
        got = scored(left, some, model)
        order = sorted(range(len(left)), key=lambda i: (-got[i], i))
        if part >= 1 and len(left) <= max(keep, 1) * 2:
            return [(left[i], got[i]) for i in order[:keep]]
        left = [left[i] for i in order[: max(keep, -(-len(left) // 2))]]
        part = min(1.0, 2 * part)


def with_examples(prompt: str, rows: DataFrame, model: Model, n: int = 4, seed: int = 7) -> str:
    """The prompt with up to n rows that it answers wholly right by itself, those with the smallest hashes; rows where nothing is
    expected show nothing."""
    solved = attempts([prompt], rows, model).where((F.col("f1") == 1) & (F.col("fp") == 0) & (F.col("fn") == 0) & (F.size("expected") > 0))
    shown = solved.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n).select("input", "got").collect()  # n rows
    return prompt + "".join(f"\n\nInput: {r['input']}\nOutput: {json.dumps(list(r['got']), ensure_ascii=False)}" for r in shown)


def optimise(
    prompts: list[str], train: DataFrame, validation: DataFrame, model: Model, propose: Callable[[str, list, list, list], list[str]],
    iterations: int = 3, threshold: float = 1.0, keep: int = 3, examples: int = 4, seed: int = 7,
) -> list[Attempt]:
    """Attempts that were validated, the best first.

    Each iteration scores the new prompts on train. It is the last one when a score reaches the threshold or nothing new is proposed;
    else propose(best prompt of the iteration, failed rows, passed rows, best (prompt, score) so far) makes the next. The `keep` best
    on train, and each of them with examples, are scored on validation. Ties go to the earlier prompt.
    """
    new, done = distinct(prompts), {}
    for i in range(iterations):
        tried = stored(attempts(new, train, model), "attempts")
        got = {r["candidate"]: r["f1"] or 0.0 for r in scores(tried).collect()}
        for k, p in enumerate(new):
            done[p] = Attempt(p, i, got.get(k, 0.0))
        best = max(range(len(new)), key=lambda k: (got.get(k, 0.0), -k))
        if max(a.train for a in done.values()) >= threshold or i == iterations - 1:
            break
        own, order = tried.where(F.col("candidate") == best), [F.xxhash64("id", F.lit(seed + i)), F.col("id")]
        failed = own.where("f1 < 1").orderBy("f1", *order).limit(FAILED).collect()
        passed = own.where("f1 = 1").orderBy(*order).limit(PASSED).collect()
        top = sorted(done.values(), key=lambda a: -a.train)[:TRIED]
        known = {" ".join(p.split()).casefold() for p in done}
        new = [p for p in distinct(propose(new[best], failed, passed, [(a.prompt, a.train) for a in top])) if " ".join(p.split()).casefold() not in known]
        if not new:
            break
    top = sorted(done.values(), key=lambda a: -a.train)[:keep]
    shown = [Attempt(p, -1, a.train) for a in top if examples and (p := with_examples(a.prompt, train, model, examples, seed)) != a.prompt]
    final = [*top, *shown]
    got = scored([a.prompt for a in final], validation, model)
    return sorted((Attempt(a.prompt, a.iteration, a.train, s) for a, s in zip(final, got, strict=True)), key=lambda a: -a.validation)
