"""Composition of operators: DataFrame functions joined with +, run over all keys that history does not have yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import not_done, record_done

Step = Callable[[DataFrame], DataFrame]


class Pipeline:
    """An immutable sequence of steps; + takes a step or another pipeline. A key without rows after a step is simply absent from then on."""

    def __init__(self, *steps: Step):
        self.steps = steps

    def __add__(self, other: Step | Pipeline) -> Pipeline:
        return Pipeline(*self.steps, *(other.steps if isinstance(other, Pipeline) else (other,)))

    def __radd__(self, other: Step) -> Pipeline:
        return Pipeline(other, *self.steps)

    def __call__(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = df.transform(step)
        return df


def where(condition) -> Step:
    return lambda df: df.where(condition)


def validators(*gadgets: Callable, column: str = "info") -> Step:
    """Each gadget maps the column; rows where it gives null are gone for the next."""

    def run(df: DataFrame) -> DataFrame:
        for g in gadgets:
            df = df.withColumn(column, g(F.col(column))).where(F.col(column).isNotNull())
        return df

    return run


def run_with_history(keys: DataFrame, history: DataFrame, key: str, namespace: str, plan: Step, status: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, history rows to append) for the keys not yet done. Write the results first, then the history."""
    todo = not_done(keys, history, key, namespace)
    out = plan(todo)
    failed = out.where(F.col(status) == "FAILED").select(key).distinct() if status else None
    done = todo.select(key).distinct()
    return out, record_done(done.join(failed, key, "left_anti") if failed is not None else done, key, namespace)
