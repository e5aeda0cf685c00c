"""Extraction from papers through a model: what it is shown, what it may answer, and what becomes of its answers.

A model is any function from a text to an answer: None, one object, or a list of objects (dicts). It runs inside tasks,
behind retries and a rate limit; an error is data in its row and never ends the job.
"""

from __future__ import annotations

import json
import string
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import documents as D
from ..operators import labels as L
from ..operators import records as R

Model = Callable[[str], dict | list | str | None]


class TooMany(Exception):
    """What a model raises when it is asked too often; it is asked again after a pause."""


class Bucket:
    """A token bucket: holds at most `capacity`, filled at `rate` a second."""

    def __init__(self, rate: float, capacity: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.capacity, self.have = rate, capacity, capacity
        self.clock, self.sleep, self.last = clock, sleep, clock()

    def refill(self) -> float:
        now = self.clock()
        self.have, self.last = min(self.capacity, self.have + (now - self.last) * self.rate), now
        return self.have

    def take(self, n: float) -> None:
        """Wait until n are there (at most the capacity is asked for) and take them."""
        n = min(n, self.capacity)
        while self.refill() < n:
            self.sleep((n - self.have) / self.rate)
        self.have -= n

    def reset(self, have: float) -> None:
        """What the service says is left."""
        self.refill()
        self.have = min(self.capacity, have)


def limited(model: Model, rate: float, capacity: float, count: Callable[[str], int] = lambda t: len(t.split()), answer: int = 100, cool: float = 10.0, clock=time.monotonic, sleep=time.sleep) -> Model:
    """The model behind a bucket of tokens, `answer` more for each answer; after TooMany it cools down and is asked once more.

    The bucket is each worker's own: give it the service's limit divided by the workers.
    """
    held: list[Bucket] = []

    def ask(text: str):
        if not held:
            held.append(Bucket(rate, capacity, clock, sleep))
        held[0].take(count(text) + answer)
        try:
            return model(text)
        except TooMany:
            sleep(cool)
            held[0].reset(held[0].capacity)
            return model(text)

    return ask


def retrying(model: Model, attempts: int = 2, first: float = 0.0, most: float = 10.0, sleep=time.sleep) -> Model:
    """The model asked again when it fails, after pauses that double from `first` to `most`; the last failure is raised."""

    def ask(text: str):
        for k in range(attempts):
            try:
                return model(text)
            except Exception:
                if k + 1 == attempts:
                    raise
                if first:
                    sleep(min(most, first * 2**k))

    return ask


def answers(df: DataFrame, text: str, model: Model, attempts: int = 2) -> DataFrame:
    """df with answers (array of JSON texts, empty without an answer) and error (null when the model answered)."""
    ask = retrying(model, attempts)

    @F.pandas_udf("answers array<string>, error string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                try:
                    got = ask(t or "")
                    items = [] if got is None else got if isinstance(got, list) else [got]
                    rows.append(([x if isinstance(x, str) else json.dumps(x, sort_keys=True, ensure_ascii=False) for x in items if x], None))
                except Exception as e:  # errors are data
                    rows.append(([], f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["answers", "error"])

    return df.withColumn("_m", call(F.col(text))).select("*", "_m.answers", "_m.error").drop("_m")


def extracted(df: DataFrame, text: str, model: Model, attempts: int = 2) -> DataFrame:
    """A row for each answer; documents without one are left out."""
    got = answers(df, text, model, attempts)
    return got.select(*df.columns, F.posexplode("answers").alias("answer_id", "answer"))


def classified(df: DataFrame, text: str, model: Model, classes: list[str] | None = None, column: str = "class") -> DataFrame:
    """df with the model's class of each text; null for failures and for what is none of the classes."""
    got = answers(df, text, model)
    first = F.try_element_at("answers", F.lit(1))
    return got.withColumn(column, first if classes is None else F.when(first.isin(*classes), first)).drop("answers", "error")


def accepted(df: DataFrame, text: str, judge: Model) -> DataFrame:
    """The rows that a judge takes: it says yes, true, or an object whose "valid" is true."""
    got = answers(df, text, judge)
    said = F.lower(F.coalesce(F.try_element_at("answers", F.lit(1)), F.lit("")))
    return got.where(said.isin("yes", "true") | F.coalesce(F.get_json_object(said, "$.valid") == "true", F.lit(False))).drop("answers", "error")


# What a model may answer


def checked(answer: Column, fields: dict[str, tuple[str, bool]], enums: dict[str, list[str]] | None = None) -> Column:
    """struct(value, errors) of a JSON answer against fields {name: (type, required)}: missing, mistyped, not among the
    allowed values, or not known at all; value is null when there are errors."""
    enums = enums or {}
    value = F.from_json(answer, T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, (t, _) in fields.items()]))
    keys = F.json_object_keys(answer)
    errors = [F.when(keys.isNull(), F.lit("not an object"))]
    for name, (kind, required) in fields.items():
        there = F.array_contains(keys, name) & F.get_json_object(answer, f"$.{name}").isNotNull()
        if required:
            errors.append(F.when(~there, F.lit(f"{name} is missing")))
        errors.append(F.when(there & value[name].isNull(), F.lit(f"{name} is no {kind}")))
        if name in enums:
            errors.append(F.when(there & ~value[name].isin(*enums[name]), F.lit(f"{name} is none of the allowed values")))
    known = F.array(*(F.lit(n) for n in fields))
    extra = F.transform(F.array_except(keys, known), lambda k: F.concat(k, F.lit(" is not known")))
    found = F.concat(F.array_compact(F.array(*errors)), F.coalesce(extra, F.array().cast("array<string>")))
    return F.named_struct(F.lit("value"), F.when(F.size(found) == 0, value), F.lit("errors"), found)


def valid_answers(df: DataFrame, text: str, model: Model, fields: dict[str, tuple[str, bool]], enums: dict[str, list[str]] | None = None) -> DataFrame:
    """Answers that are valid, as columns of the value; rows whose answers are not are asked once more, then left out."""
    first = extracted(df, text, model).withColumn("_c", checked(F.col("answer"), fields, enums))
    return first.where(F.size("_c.errors") == 0).select(*df.columns, "answer_id", "_c.value.*")


def record_schema(properties: dict[str, list[str]]) -> T.StructType:
    """The schema of a paper's records for the properties asked for: metadata, and a list of entries for each property."""
    entry = lambda names: T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    metadata = T.StructType([T.StructField("composition", T.StringType()), T.StructField("label", T.StringType()), T.StructField("processing_kw", T.ArrayType(T.StringType()))])
    return T.StructType([T.StructField("metadata", metadata), *(T.StructField(p, entry(names)) for p, names in properties.items())])


# What a model is shown


def prompt(template: str, **columns: Column) -> Column:
    """The template with its {placeholders} filled from columns, null as empty; they must be exactly the columns given."""
    parts = list(string.Formatter().parse(template))
    wanted = {name for _, name, _, _ in parts if name is not None}
    if wanted != set(columns):
        raise ValueError(f"the placeholders should be {sorted(columns)}, but are {sorted(wanted)}")
    out = []
    for text, name, _, _ in parts:
        out += ([F.lit(text)] if text else []) + ([F.coalesce(columns[name].cast("string"), F.lit(""))] if name is not None else [])
    return F.concat(*out)


def example_messages(examples: list[tuple[str, list[dict]]]) -> list[dict]:
    """Few-shot examples (text, objects) as messages: the text, a call for each object, its acknowledgement, and a closing word."""
    out = []
    for k, (text, objects) in enumerate(examples):
        calls = [{"id": f"call-{k}-{i}", "name": "extract", "args": o} for i, o in enumerate(objects)]
        out.append({"role": "user", "content": text})
        out.append({"role": "assistant", "content": "", "tool_calls": calls})
        out += [{"role": "tool", "tool_call_id": c["id"], "content": "This is correct."} for c in calls]
    return out


def shown(paras: DataFrame, wanted: Column, context: bool = True) -> DataFrame:
    """(source, text): the wanted paragraphs of each paper in one text under its title, with abstract and last introduction
    paragraph before them if asked for, section titles where they change, tables last."""
    rows = L.relevant(paras, wanted, context)
    lines = D.headings_on_change(rows.where(~L.is_table()), "source", "para_id", "sub_titles")
    lines = lines.withColumn("line", F.concat_ws("\n", F.nullif(F.array_join(F.filter("new_parts", lambda x: x != ""), "\n"), F.lit("")), "page_content"))
    both = lines.select("source", "para_id", "line", F.lit(False).alias("tab")).unionByName(rows.where(L.is_table()).select("source", "para_id", F.col("page_content").alias("line"), F.lit(True).alias("tab")))
    text = D.render(both, "source", "para_id", "line", F.col("tab"))
    titles = paras.groupBy("source").agg(F.min_by("title", "para_id").alias("title"))
    return text.join(titles, "source").select("source", F.concat(F.lit("Title: "), F.coalesce("title", F.lit("")), F.lit("\n"), "rendered").alias("text"))


def extract_properties(paras: DataFrame, models: dict[str, Model], context: bool = True, synthesis: bool = False) -> DataFrame:
    """(source, property, answer_id, answer, error): each property's model over the paragraphs with its label.

    With synthesis, the paper's synthesis paragraphs are put after the text. A property whose model fails on a paper is one
    row with the error; the others go on.
    """
    out = None
    for name, model in models.items():
        text = shown(paras, L.has_label(name), context)
        if synthesis:
            added = shown(paras, F.col("is_synthesis"), False).select("source", F.col("text").alias("syn"))
            text = text.join(added, "source", "left").select("source", F.concat_ws("\nSynthesis:\n", "text", "syn").alias("text"))
        got = answers(text, "text", model).select("source", F.lit(name).alias("property"), F.posexplode_outer("answers").alias("answer_id", "answer"), "error").where("answer IS NOT NULL OR error IS NOT NULL")
        out = got if out is None else out.unionByName(got)
    return out


def extract_synthesis(paras: DataFrame, model: Model) -> DataFrame:
    """(source, answer_id, answer) of the synthesis paragraphs with the paper's context."""
    return extracted(shown(paras, F.col("is_synthesis")), "text", model).drop("text")


def contextualised(paras: DataFrame, model: Model, labels: list[str]) -> DataFrame:
    """One question a paper: all its labelled and synthesis paragraphs together; a failure is a row with status FAILED."""
    text = shown(paras, F.arrays_overlap("property_types", F.array(*(F.lit(x) for x in labels))) | F.col("is_synthesis"))
    got = answers(text, "text", model)
    return got.select("source", "answers", F.when(F.col("error").isNotNull(), "FAILED").otherwise("OK").alias("status"))


def isolated(paras: DataFrame, models: dict[str, Model], process: Model) -> DataFrame:
    """Properties and synthesis asked apart, every property answer then joined with the paper's first synthesis answer."""
    found = extract_properties(paras, models, context=False).where("answer IS NOT NULL")
    route = extract_synthesis(paras, process).where("answer_id = 0").select("source", F.col("answer").alias("synthesis"), F.lit(0).alias("o"))
    return R.first_match(found.drop("error"), route, "source", "o", "synthesis")


def select_paragraphs(paras: DataFrame, wanted: Column, originals: DataFrame | None = None, title: bool = False, abstract: bool = False) -> DataFrame:
    """(source, para_id, text) of the wanted paragraphs, with title and abstract before the text if asked for; those that the
    originals do not have are left out."""
    rows = paras.where(wanted)
    rows = rows if originals is None else rows.join(originals.select("source", "page_content").distinct(), ["source", "page_content"], "left_semi")
    if not (title or abstract):
        return rows.select("source", "para_id", F.col("page_content").alias("text"))
    heads = L.title_and_abstract(paras)
    parts = [*([F.col("title")] if title else []), *([F.array_join("abstract", "\n")] if abstract else []), F.col("page_content")]
    return rows.drop("title").join(heads, "source").select("source", "para_id", F.concat_ws("\n", *parts).alias("text"))


# Names


def standard_names(found: DataFrame, drops: DataFrame, acronyms: DataFrame, name: str = "material", unknown: str = "unknown", value: str | None = None) -> DataFrame:
    """found without names to drop and without unknown values, names replaced by what their acronym stands for, if it is known."""
    rows = found.join(drops.select(F.col("name").alias(name)).distinct(), name, "left_anti")
    rows = rows if value is None else rows.where(F.col(value) != unknown)
    known = acronyms.groupBy(F.col("acronym").alias(name)).agg(F.min("full").alias("_full"))
    return rows.join(known, name, "left").withColumn(name, F.coalesce("_full", name)).drop("_full")


def resolved_names(found: DataFrame, paras: DataFrame, standard: Model, meaning: Model, name: str = "material") -> DataFrame:
    """found with names put in standard form, and names that the model then calls acronyms looked up in the first paragraph
    that mentions them: meaning reads that paragraph after the name."""
    names = found.select(name).distinct()
    said = classified(names, name, standard, column="standard").select(name, F.coalesce("standard", name).alias("standard"))
    first = D.first_mention(said.select("standard").distinct(), paras, "standard", "source", "para_id", "page_content")
    read = classified(first.withColumn("asked", F.concat_ws("\n", "standard", "page_content")), "asked", meaning, column="full").select("standard", "full")
    known = said.join(read, "standard", "left").select(name, F.coalesce("full", "standard").alias("_full"))
    return found.join(known, name, "left").withColumn(name, F.coalesce("_full", name)).drop("_full")


def reactions(df: DataFrame, text: str, extract: Model, resolve: Model, clean: Model) -> DataFrame:
    """The reaction program: reactions of a text, those of the solid state, unidentified names in them resolved, those with
    precursors, and of these what the cleaner leaves. resolve and clean read and give a JSON list of reactions."""
    schema = "array<struct<reaction_type: string, precursors: array<string>, target: string>>"
    got = answers(df, text, extract).withColumn("r", F.from_json(F.concat(F.lit("["), F.array_join("answers", ","), F.lit("]")), schema)).drop("answers", "error")
    for model in (resolve, clean):
        got = got.withColumn("r", F.filter("r", lambda x: x["reaction_type"] == "solid-state")).where(F.size("r") > 0).withColumn("_t", F.to_json("r"))
        got = answers(got, "_t", model).withColumn("r", F.from_json(F.concat(F.lit("["), F.array_join("answers", ","), F.lit("]")), schema)).drop("answers", "error", "_t")
        got = got.withColumn("r", R.solid_state(F.col("r")))
    return got.where(F.size("r") > 0).withColumnRenamed("r", "reactions")


# Prompts made better


def optimise(prompts: list[str], dev: DataFrame, run: Callable[[str, DataFrame], DataFrame], propose: Callable[[str, list], list[str]], rounds: int = 3, keep: int = 2, sample: int = 20, seed: int = 7) -> list[tuple[str, float]]:
    """The best `keep` prompts with their F1 on dev. run gives rows (tp, fp, fn, ...) for a prompt; propose makes new prompts
    from one and its worst rows. Ties go to the prompt that came first; a prompt is scored once."""
    from ..operators.analysis import f1, f1_each

    scored: dict[str, float] = {}
    best = list(dict.fromkeys(prompts))
    for k in range(rounds + 1):
        for p in best:
            if p not in scored:
                scored[p] = f1(run(p, dev), "tp", "fp", "fn").first()["f1"] or 0.0
        ranked = sorted(scored, key=lambda p: -scored[p])[:keep]
        if k == rounds:
            break
        new = []
        for p in ranked:
            worst = f1_each(run(p, dev), "tp", "fp", "fn").orderBy("f1", F.xxhash64("tp", "fp", "fn", F.lit(seed + k))).limit(sample).collect()  # at most `sample` rows
            new += propose(p, worst)
        best = [p for p in dict.fromkeys(new) if p not in scored]
        if not best:
            break
    return [(p, scored[p]) for p in sorted(scored, key=lambda p: -scored[p])[:keep]]
