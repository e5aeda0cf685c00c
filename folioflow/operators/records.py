"""Records of materials: resolution into partitions, merging, conflict handling, flattening."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions.formula import n_elements, normalise_formula
from ..sources.store import stored
from .documents import with_places


def group_by_rule(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Members of each key combination in order; a null is a key like any other; groups keep the place of their first member."""
    item = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    got = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("m"))
    return got.select(*keys, F.col("m")[0]["o"].alias("first_pos"), F.transform("m", lambda x: x["v"]).alias("members"))


def partition_strict(records: DataFrame, paper: str = "paper", pos: str = "pos") -> DataFrame:
    """Partitions of a paper's records with equal normalised composition, label and processing keywords."""
    keyed = records.select(paper, pos, N.composition_key(F.col("composition")).alias("comp"), N.label_key(F.col("label")).alias("label"), N.processing_key(F.col("processing_kw")).alias("kw"))
    return keyed.groupBy(paper, "comp", "label", "kw").agg(F.sort_array(F.collect_list(pos)).alias("members"))


#: How much of a partition's keywords a list must share to join it, and what that says.
_GRADES = ((1.0, "medium"), (0.5, "low"))


def _grade(words: set[str], known: set[str]) -> str | None:
    """How well two keyword sets agree: the greater share that one has of the other decides; an empty list is within any."""
    shared = len(words & known)
    best = max(1.0 if not own else shared / len(own) for own in (words, known))
    return next((name for least, name in _GRADES if best >= least), None)


def _gather(records: list[tuple[int, list[str]]]) -> list[tuple[list[str], list[int], str]]:
    """Records (pos, keywords) in order of pos, each put to the first partition that takes it or to one of its own."""
    parts: list[list] = []  # keywords, their lower-cased set, members, confidence
    for pos, words in records:
        low = {w.lower() for w in words}
        for part in parts:
            grade = "high" if words == part[0] else _grade(low, part[1])
            if grade is None:
                continue
            part[2].append(pos)
            if grade != "high":
                part[0] = part[0] + [w for w in words if w.lower() not in part[1]]
                part[1] = part[1] | low
                part[3] = grade
            break
        else:
            parts.append([words, low, [pos], "high"])
    return [(words, sorted(members), grade) for words, _, members, grade in parts]


def _fuzzy(batches):
    names = ["paper", "comp", "label", "kw", "members", "confidence"]
    types = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.string()]
    for batch in batches:
        rows = []
        for paper, comp, label, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows += [(paper, comp, label, *part) for part in _gather([(r["pos"], r["kw"]) for r in items])]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def partition_fuzzy(records: DataFrame) -> DataFrame:
    """Greedy partitions of records(paper, pos, composition, label, processing_kw): equal keywords (high), one list within the other (medium) or half shared (low); the last merge names the confidence.

    Only records of one paper, composition and label can meet. Groups with one keyword list are settled without Python;
    the others, which hold the few records of a paper, go through it as arrays.
    """
    keyed = records.select("paper", "pos", N.composition_key(F.col("composition")).alias("comp"), N.label_key(F.col("label")).alias("label"), N.processing_key(F.col("processing_kw")).alias("kw"))
    groups = keyed.groupBy("paper", "comp", "label").agg(F.sort_array(F.collect_list(F.struct("pos", "kw"))).alias("items"))
    lists = F.array_distinct(F.transform("items", lambda x: x["kw"]))
    plain = groups.where(F.size(lists) == 1).select("paper", "comp", "label", lists[0].alias("kw"), F.transform("items", lambda x: x["pos"].cast("int")).alias("members"), F.lit("high").alias("confidence"))
    mixed = groups.where(F.size(lists) > 1).mapInArrow(_fuzzy, "paper string, comp string, label string, kw array<string>, members array<int>, confidence string")
    return plain.unionByName(mixed)


def covers(partitions: DataFrame, records: DataFrame, paper: str = "paper", pos: str = "pos") -> DataFrame:
    """Per paper whether every record is in exactly one partition: none missing, none twice, none made up."""
    placed = partitions.select(paper, F.explode("members").alias(pos)).groupBy(paper, pos).agg(F.count(F.lit(1)).alias("times"))
    both = records.select(paper, pos, F.lit(True).alias("known")).join(placed, [paper, pos], "full")
    return both.groupBy(paper).agg(F.bool_and(F.coalesce("known", F.lit(False)) & (F.coalesce("times", F.lit(0)) == 1)).alias("covered"))


def merge(df: DataFrame, key: list[str], order: str, first: list[str], rest: Column, referred: str) -> DataFrame:
    """Per partition: the first record's fields, the properties of all, and whether any record is not merely referred to."""
    item = F.struct(F.col(order).alias("o"), rest.alias("p"))
    got = df.groupBy(*key).agg(*(F.min_by(c, order).alias(c) for c in first), F.array_sort(F.collect_list(item)).alias("ps"), F.bool_or(~F.coalesce(F.col(referred), F.lit(True))).alias("extract_syn"))
    return got.select(*key, *first, F.transform("ps", lambda x: x["p"]).alias("properties"), "extract_syn")


def merge_by_json(df: DataFrame, doc: str, value: str, order: str, out: str) -> DataFrame:
    """Rows with the same JSON are one row with all values; rows without JSON stay apart."""
    some = df.where(F.col(doc).isNotNull()).groupBy(doc).agg(F.sort_array(F.collect_list(order)).alias(out))
    return some.unionByName(df.where(F.col(doc).isNull()).select(doc, F.array(order).alias(out)))


def first_match(left: DataFrame, right: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Every left row with the value of the first right row of its key, or null; a null key matches nothing."""
    heads = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, order).alias(value))
    return left.join(heads, key, "left")


def keep_consistent(df: DataFrame, key: str, value: str, order: str, nulls_count: bool = True) -> DataFrame:
    """One row per key whose values all agree (nulls_count: a null is a value), without those whose value is null."""
    n = F.count_distinct(F.col(value)) + (F.max(F.col(value).isNull().cast("int")) if nulls_count else F.lit(0))
    got = df.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias("_n"), F.min_by(value, F.struct(F.col(value).isNull(), order)).alias(value))
    return got.where((F.col("_n") == 1) & F.col(value).isNotNull()).drop("_n")


def merge_spans(df: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Overlapping spans of a key joined into their union."""
    w = Window.partitionBy(*key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(start) <= reach, 0).otherwise(1)
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_new", new).withColumn("_island", island).groupBy(*key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def valid_record(record: Column) -> Column:
    """Any strength value if there are strength entries, else any phase; empty text counts as missing."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    strong = F.exists(record["strength"], lambda s: filled(s["ys"]) | filled(s["uts"]) | filled(s["strain"]))
    return F.when(F.size(record["strength"]) > 0, strong).otherwise(F.exists(record["phase"], lambda p: F.size(p["phases"]) > 0))


def dedup_across_groups(df: DataFrame, paper: str, key: list[str], group: str, pos: str) -> DataFrame:
    """A record stays in the first group of its paper where its normalised metadata is seen; groups left empty are gone."""
    rank = F.row_number().over(Window.partitionBy(paper, *key).orderBy(group, pos))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")


def flatten_groups(df: DataFrame, groups: str) -> DataFrame:
    """Nested record groups to rows with group_index and index."""
    outer = df.select(*(c for c in df.columns if c != groups), F.posexplode(groups).alias("group_index", "_g"))
    return outer.select(*(c for c in outer.columns if c != "_g"), F.posexplode("_g").alias("index", "record"))


def all_true(verdicts: Column) -> Column:
    """Kept when every verdict of a map holds."""
    return F.forall(F.map_values(verdicts), lambda v: F.coalesce(v, F.lit(False)))


def none_false(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike("(?i)false")


def composition_of(metadata: Column) -> Column:
    """The normalised atomic composition of a record, null for composites, weight compositions and what does not parse."""
    return normalise_formula(N.atomic_composition(metadata["composition"]))


def grain_size_of(sizes: Column) -> Column:
    """Grain size in µm of a record that states exactly one."""
    return F.when(F.size(sizes) == 1, N.grain_size_um(sizes[0]["grain_size"]))


def _entries(df: DataFrame, test_type: str) -> DataFrame:
    """df(doi, record(metadata, grain_size, strength, synthesis)) as rows of entries s of one test type, with what goes to each."""
    record = F.col("record")
    rows = df.select("doi", record["metadata"]["composition"].alias("composition_raw"), composition_of(record["metadata"]).alias("composition"), grain_size_of(record["grain_size"]).alias("grain_size_um"), record["synthesis"]["steps"].alias("synthesis_steps"), F.explode(record["strength"]).alias("s"))
    rows = rows.where(F.col("s.test_type") == test_type).withColumn("temperature_c", N.temperature_c(F.col("s.temperature"))).withColumn("strain_rate", N.strain_rate(F.col("s.strain_rate")))
    return rows.where(F.col("temperature_c").isNotNull())


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def strength_rows(df: DataFrame, test_type: str) -> DataFrame:
    """Rows of yield strengths: entries of one test type with a temperature and a yield strength, both of which parse."""
    out = _entries(df, test_type).where(_filled(F.col("s.ys"))).withColumn("yield_strength_mpa", N.strength_mpa(F.col("s.ys"))).where(F.col("yield_strength_mpa").isNotNull())
    return out.select("doi", "composition_raw", "composition", "grain_size_um", "yield_strength_mpa", "temperature_c", "strain_rate", "synthesis_steps")


def mechanical_rows(df: DataFrame, test_type: str) -> DataFrame:
    """Rows of mechanical properties: entries with a temperature that parses and a yield strength or strain, kept if any of yield strength, tensile strength and strain parses."""
    out = _entries(df, test_type).where(_filled(F.col("s.ys")) | _filled(F.col("s.strain")))
    parsed = F.struct(N.strength_mpa(F.col("s.ys")).alias("yield_strength_mpa"), N.strength_mpa(F.col("s.uts")).alias("ultimate_tensile_strength_mpa"), N.strain(F.col("s.strain")).alias("strain"))
    out = out.select("*", F.inline_outer(F.array(parsed)))  # a generator's columns are not written out again in the filter on them
    out = out.where(F.coalesce("yield_strength_mpa", "ultimate_tensile_strength_mpa", "strain").isNotNull())
    return out.select("doi", "composition_raw", "composition", "grain_size_um", "yield_strength_mpa", "ultimate_tensile_strength_mpa", "strain", "temperature_c", "strain_rate", "synthesis_steps")


def phase_rows(df: DataFrame) -> DataFrame:
    """Rows of records whose phase entries agree (one common list, any order): composition, composition_raw, phases, synthesis_steps."""
    record = F.col("record")
    lists = F.transform(record["phase"], lambda p: F.array_sort(p["phases"]))
    agreed = F.when(F.size(F.array_distinct(lists)) == 1, lists[0])
    out = df.select("doi", composition_of(record["metadata"]).alias("composition"), record["metadata"]["composition"].alias("composition_raw"), agreed.alias("phases"), record["synthesis"]["steps"].alias("synthesis_steps"))
    return out.where(F.size("phases") > 0)


def valid_compositions(df: DataFrame) -> DataFrame:
    """The compositions of records with any strength value or, without strength entries, any phase."""
    return df.where(valid_record(F.col("record"))).select("doi", composition_of(F.col("record.metadata")).alias("composition"))


def with_elements(df: DataFrame, composition: str, least: int = 3) -> DataFrame:
    """Rows whose normalised composition has at least `least` elements."""
    return df.where(n_elements(F.col(composition)) >= least)


def of_kind(df: DataFrame, column: str, part: str | None = None, among: list[str] | None = None) -> DataFrame:
    """Rows whose column holds a text or is one of several."""
    out = df if part is None else df.where(F.col(column).contains(part))
    return out if among is None else out.where(F.col(column).isin(*among))


def solid_state(reactions: Column) -> Column:
    """Reactions of the solid state that name precursors."""
    return F.filter(reactions, lambda r: (r["reaction_type"] == "solid-state") & (F.size(r["precursors"]) > 0))


def attach(data: Column, items: Column) -> Column:
    """items (an array) added to data without what is null or empty; a null list adds nothing."""
    return F.concat(F.coalesce(data, F.array().cast("array<string>")), F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != ""))


def inherited(metadata: Column, *keys: str) -> Column:
    """The entries of a map that go on to what is made from it."""
    return F.map_filter(metadata, lambda k, v: k.isin(*(keys or ("source", "doi", "title"))))


def without(metadata: Column, *keys: str) -> Column:
    return F.map_filter(metadata, lambda k, v: ~k.isin(*keys))


def field(c: Column, name: str, many: bool = False) -> Column:
    """A field of a struct, or of each struct of an array."""
    return F.transform(c, lambda x: x[name]) if many else c[name]


def batches(df: DataFrame, key: str, order: Column, size: int = 12) -> DataFrame:
    """Numbers the batches of a key's rows, `size` each: the input of a grouping round."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1) / size))


def group_rounds(df: DataFrame, key: str, pos: str, item: str, group, size: int = 12, depth: int = 3, seed: int = 7) -> DataFrame:
    """Hierarchical grouping: batches of a key's items go through `group` (a list of texts to lists of indices), the first
    of each group stands for it in the next round. Rows: key, head, members.

    A key whose items fit one batch is done after that round, at the latest after `depth` rounds; only open keys go on, and the
    rounds end when none is open. Items are dealt to batches by their hashes with the seed and the round, so the same table gives
    the same groups; places are numbered over ranges, so a key with very many items is no single task's. A round is
    written before the next one reads it. Items that group leaves out of all groups are gone, an item in two groups is in both.
    """
    now = df.select(key, F.col(pos).cast("long").alias("head"), F.array(F.col(pos).cast("long")).alias("members"), F.col(item).alias("text"))

    @F.pandas_udf("array<array<int>>")
    def grouped(texts: pd.Series) -> pd.Series:
        return texts.map(lambda own: [sorted(int(i) for i in ids) for ids in group(list(own))])

    own = F.struct("head", "members", "text")
    picked = F.transform("_ids", lambda i: F.element_at("_items", i + 1))
    done = None
    for k in range(depth):
        dealt = with_places(now.withColumn("_h", F.xxhash64("head", F.lit(seed + k))), "_h", "head", key=key).withColumn("batch", F.floor(F.col("place") / size))
        batch = dealt.groupBy(key, "batch").agg(F.array_sort(F.collect_list(own)).alias("_items"))  # `size` items at most
        out = batch.withColumn("_g", grouped(F.transform("_items", lambda x: x["text"]))).select(key, "batch", "_items", F.explode("_g").alias("_ids")).where(F.size("_ids") > 0)
        out = out.select(key, "batch", picked.alias("_own")).select(key, "batch", F.col("_own")[0]["head"].alias("head"), F.array_sort(F.flatten(F.transform("_own", lambda x: x["members"]))).alias("members"), F.col("_own")[0]["text"].alias("text"))
        out = stored(out, "grouped")
        several = out.where("batch > 0").select(F.col(key).alias("_k")).distinct()
        ended = out.join(several, F.col(key).eqNullSafe(F.col("_k")), "left_anti").drop("batch")
        done = ended if done is None else done.unionByName(ended)
        now = out.join(several, F.col(key).eqNullSafe(F.col("_k")), "left_semi").drop("batch")
        if now.isEmpty():
            break
    return done.unionByName(now).select(key, "head", "members")
