"""Models asked once for each content: answers lie in a table under the digest of what was asked, and are joined back.

A text that many rows hold, or that an earlier run has asked about, costs one call. Failed calls are reported in the rows of
this run and are not kept, so the next run asks again.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.labels import anything, has_label, is_table, label_paper
from ..sources.keyed import exists
from ..sources.store import stored

SCHEMA = "digest binary, text string, answer string, question string"


def _asker(models: dict[str, Callable[[str], object]], attempts: int):
    @F.pandas_udf("answer string, error string")
    def ask(questions: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for question, text in zip(questions, texts, strict=True):
            answer = error = None
            for _ in range(attempts):
                try:
                    got = models[question](text)
                    answer, error = None if got is None else str(got), None
                    break
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
            rows.append((answer, error))
        return pd.DataFrame(rows, columns=["answer", "error"], dtype=object)

    return ask


def ask_all(rows: DataFrame, text: str, models: dict[str, Callable[[str], object]], store: str, where: dict[str, Column] | None = None, attempts: int = 2, tasks: int | None = None) -> DataFrame:
    """rows with answers, a map from each question that was asked of a row to (answer, error) of its model.

    store is the folder of the answers, partitioned by question: another model, prompt or version is another question. where says
    of which rows a question is asked (of all if it does not). Texts are compared whole, a null one is asked nothing. New texts
    are dealt over `tasks` tasks if given.
    """
    spark, digest = rows.sparkSession, F.unhex(F.sha2(text, 256))
    own = ["question", "digest", "text"]
    told = spark.read.schema(SCHEMA).parquet(store).where(F.col("question").isin(*models)) if exists(spark, store) else spark.createDataFrame([], SCHEMA)
    # Two runs at a time may both have asked: one answer of each text counts.
    told = told.groupBy(*own).agg(F.min("answer").alias("answer"))
    applies = F.array_compact(F.array(*(F.when((where or {}).get(q, F.lit(True)), F.lit(q)) for q in models)))
    texts = rows.where(F.col(text).isNotNull()).select(F.explode(applies).alias("question"), digest.alias("digest"), F.col(text).alias("text")).distinct()
    new = texts.join(told, own, "left_anti")
    new = new.repartition(tasks, "question", "digest") if tasks else new
    # Written before it is used: a text is asked about by the task that wrote it, however often the answers are read.
    said = stored(new.select(*own, _asker(models, attempts)("question", "text").alias("_a")).select(*own, "_a.answer", "_a.error"), "answers")
    said.where("error IS NULL").select("digest", "text", "answer", "question").write.mode("append").partitionBy("question").parquet(store)
    old = told.join(texts, own, "left_semi").select(*own, "answer", F.lit(None).cast("string").alias("error"))
    entry = F.struct("question", F.struct("answer", "error").alias("said"))
    by_text = said.unionByName(old).groupBy(F.col("digest").alias("_d"), F.col("text").alias("_t")).agg(F.map_from_entries(F.collect_list(entry)).alias("_a"))  # an entry a question
    out = rows.join(by_text, (digest == F.col("_d")) & (F.col(text) == F.col("_t")), "left")
    return out.withColumn("answers", F.map_filter("_a", lambda k, _: F.array_contains(applies, k))).drop("_d", "_t", "_a")


def ask_once(rows: DataFrame, text: str, question: str, model: Callable[[str], object], store: str, **how) -> DataFrame:
    """rows with the answer (a string) and the error of model(text), see ask_all()."""
    got = F.col("answers")[question]
    return ask_all(rows, text, {question: model}, store, **how).withColumns({"answer": got["answer"], "error": got["error"]}).drop("answers")


def says_yes(question: str) -> Column:
    """Whether the answer is true, "true" or "yes" in any case; no where it was not asked or failed."""
    return F.coalesce(F.lower(F.col("answers")[question]["answer"]).isin("true", "yes"), F.lit(False))


#: The labels that a model judges: of tables, and of paragraphs that patterns or similarity have found.
TABLE_QUESTIONS = ("composition", "strength_table", "processing_parameters")


def label_paper_by_models(paras: DataFrame, models: dict[str, Callable[[str], object]], store: str, vectors: DataFrame | None = None, synthesis=None, phase=None, strength=None, **how) -> DataFrame:
    """label_paper() with models in the place of gates, each asked once for each text: composition, strength_table and
    processing_parameters of every table, strength and synthesis of the paragraphs that patterns and similarity have found."""
    if missing := {*TABLE_QUESTIONS, "strength", "synthesis"} - models.keys():
        raise ValueError(f"no model for {', '.join(sorted(missing))}")
    found = label_paper(paras, vectors, synthesis, phase, strength, dict.fromkeys(models, anything))
    where = {**dict.fromkeys(TABLE_QUESTIONS, is_table()), "strength": ~is_table() & has_label("strength"), "synthesis": F.col("is_synthesis")}
    known, said = ask_all(found, "page_content", models, store, where, **how), says_yes
    stays = lambda x: (
        F.when(x == "composition", said("composition")).when(x == "processing_parameters", said("processing_parameters"))
        .when(x == "strength", F.when(is_table(), said("strength_table")).otherwise(said("strength"))).otherwise(True)
    )
    return known.withColumns({"property_types": F.filter("property_types", stays), "is_synthesis": F.col("is_synthesis") & said("synthesis")}).select(*found.columns)
