"""Documents and paragraphs: numbering, headings, rendering, labels, windows over a paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import stored


def paragraphs(docs: DataFrame, key: str = "source_id", text: str = "text") -> DataFrame:
    """One row per non-blank line: key, para_id from 0 over all lines, para."""
    rows = docs.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("para_id", "para"))
    return rows.where(F.trim("para") != "")


def with_first(df: DataFrame, key: str, order: str, value: Column, name: str) -> DataFrame:
    """The first non-null value of each key attached to all of its rows; rows without a key are a group of their own.

    The values are found by an aggregation that combines map-side, so a key with very many rows gathers in no task.
    """
    rows = df.withColumn("_v", value)
    heads = rows.where("_v IS NOT NULL").groupBy(F.col(key).alias("_k")).agg(F.min_by("_v", order).alias(name))
    return rows.drop("_v", name).join(heads, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")


def with_places(df: DataFrame, *order: str, key: str | None = None) -> DataFrame:
    """df with its place (from 0) in the whole order or, with a key, among the rows of its key.

    Rows are numbered within ranges of the order; only the ranges' counts meet in one task (of a key). The ranges are
    written first: computed again, they might be cut elsewhere.
    """
    by = [key, *order] if key else list(order)
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_n", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("_p", F.shiftright("_n", 33)), "places")
    group = F.col(key) if key else F.lit(0)
    counts = ranged.groupBy("_p", group.alias("_g")).agg(F.count(F.lit(1)).alias("_c"), F.min("_n").alias("_first"))
    before = counts.select("_p", "_g", "_first", (F.sum("_c").over(Window.partitionBy("_g").orderBy("_p")) - F.col("_c")).alias("_before"))  # a row for each range and key
    return ranged.join(before, (ranged["_p"] == before["_p"]) & group.eqNullSafe(before["_g"])).select(*df.columns, (F.col("_before") + F.col("_n") - F.col("_first")).alias("place"))


def slices(df: DataFrame, key: str, order: str, size: int) -> DataFrame:
    """df with batch: its key's rows in order, `size` a batch."""
    return with_places(df, order, key=key).withColumn("batch", F.floor(F.col("place") / size)).drop("place")


def label(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """property_types: the names of the rules that hold, in the order of the rules."""
    return df.withColumn("property_types", F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules.items()))))


def with_labels(df: DataFrame, *wanted: str) -> DataFrame:
    """Paragraphs with any of the labels; no labels, no paragraphs."""
    return df.where(F.arrays_overlap("property_types", F.array(*(F.lit(x) for x in wanted)))) if wanted else df.limit(0)


def top_n(df: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= n)


def headings_on_change(df: DataFrame, key: str, order: str, path: str) -> DataFrame:
    """new_parts: the parts of a title path that the paragraph before did not have."""
    parts = F.split(path, "/")
    before = F.lag(parts).over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("new_parts", F.array_except(parts, F.coalesce(before, F.array().cast("array<string>"))))


def heading_stack(df: DataFrame, key: str, order: str, level: str, title: str, depth: int = 6) -> DataFrame:
    """sub_titles: the titles in force at each row; a title ends those of its level and deeper."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    parts = []
    for k in range(1, depth + 1):
        mark = F.when(F.col(level) == k, F.coalesce(title, F.lit(""))).when(F.col(level) < k, F.lit(""))
        parts.append(F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit("")))
    return df.withColumn("sub_titles", F.array_join(F.filter(F.array(*parts), lambda x: x != ""), "/"))


def render(df: DataFrame, key: str, order: str, text: str, tables: Column | None = None, count: str | None = None) -> DataFrame:
    """One text per key: distinct rows in order, tables last under a heading of their own; with `count`, how many rows that are."""
    tables = F.lit(False) if tables is None else tables
    rows = df.where(F.trim(text) != "").dropDuplicates([key, order])
    item = F.struct(F.col(order).alias("o"), F.col(text).alias("t"))
    got = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.when(~tables, item))).alias("a"), F.array_sort(F.collect_list(F.when(tables, item))).alias("b"))
    lines = lambda c: F.array_join(F.transform(c, lambda x: x["t"]), "\n")
    whole = F.concat(lines("a"), F.when(F.size("b") > 0, F.concat(F.lit("\nTables:\n"), lines("b"))).otherwise("")).alias("rendered")
    return got.select(key, whole, *([(F.size("a") + F.size("b")).cast("long").alias(count)] if count else []))


def first_mention(terms: DataFrame, paras: DataFrame, term: str, key: str, order: str, text: str) -> DataFrame:
    """The first paragraph that has each term, as it is written, with no letter, digit or underscore (of any script) next to it.

    Terms and paragraphs are cut into words alike and joined on a term's first word (its first mark if it has none), so no
    term meets every paragraph; a term of more than that word is then looked for as a whole. Blank terms are never found.
    """
    words = paras.select(key, order, text, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0)))).alias("_w"))
    first = lambda pattern: F.nullif(F.regexp_extract(term, pattern, 0), F.lit(""))
    wanted = terms.select(F.col(term)).distinct().withColumn("_w", F.coalesce(first(r"(?U)\w+"), first(r"(?U)[^\w\s]")))
    quoted = F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.replace(F.col(term), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?!\w)"))
    alone = (F.col(term) == F.col("_w")) & F.col(term).rlike(r"(?U)^\w+$")
    hits = words.join(wanted, "_w").where(F.when(alone, True).otherwise(F.regexp_like(text, quoted)))
    return hits.groupBy(term).agg(F.min(F.struct(key, order, text)).alias("m")).select(term, f"m.{key}", f"m.{order}", f"m.{text}")


def reorder(selected: DataFrame, original: DataFrame, value: str, order: str) -> DataFrame:
    """Selected rows with their places in the original, each place used once: the k-th of equal values gets the k-th place.

    Values are dealt by their digests, so that what is sorted and joined on is short, and compared in full.
    """
    numbered = lambda df: df.select(value, order, F.sha2(F.col(value), 256).alias("_d")).withColumn("_k", F.row_number().over(Window.partitionBy("_d").orderBy(order)))
    places = numbered(original).select(F.col(value).alias("_v"), "_d", "_k", F.col(order).alias("place"))
    return numbered(selected).join(places, ["_d", "_k"]).where(F.col(value) == F.col("_v")).select(value, "place")


def join_titles(df: DataFrame, key: str, order: str, kind: str, text: str) -> DataFrame:
    """A section number directly before a title becomes part of it; the lone number goes."""
    w = Window.partitionBy(key).orderBy(order)
    before_kind, before, after = F.lag(kind).over(w), F.lag(text).over(w), F.lead(kind).over(w)
    merged = F.when((F.col(kind) == "SECTION_TITLE") & (before_kind == "SECTION_ID"), F.concat_ws(" ", before, text)).otherwise(F.col(text))
    gone = (F.col(kind) == "SECTION_ID") & (F.coalesce(after, F.lit("")) == "SECTION_TITLE")
    return df.withColumn("_m", merged).withColumn("_g", gone).where("NOT _g").withColumn(text, F.col("_m")).drop("_m", "_g")


def markdown_table(df: DataFrame, key: str, group: str, index: str, *columns: str) -> DataFrame:
    """One Markdown table per key, rows by group and index, a group's number only on its first row."""
    first = F.lag(group).over(Window.partitionBy(key).orderBy(group, index)).eqNullSafe(F.col(group))
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", F.when(first, "").otherwise(cell(group)), cell(index), *(cell(c) for c in columns)), F.lit(" |"))
    names = [group, index, *columns]
    head = f"| {' | '.join(names)} |\n| {' | '.join(['---'] * len(names))} |\n"
    got = df.withColumn("_l", line).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(group, index, "_l"))).alias("a"))
    return got.select(key, F.concat(F.lit(head), F.array_join(F.transform("a", lambda x: x["_l"]), "\n")).alias("table"))
