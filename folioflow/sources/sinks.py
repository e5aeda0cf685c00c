"""Sinks: appended tables, keyed upserts, deletes, JSON lines, canonical HTML, dead letters."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import content_uuid, escape_html


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def with_document_id(df: DataFrame, text: str = "page_content") -> DataFrame:
    """A key that depends on content only, so that writing a document twice gives the same rows."""
    return df.withColumn("document_id", content_uuid(F.col(text)))


def results(df: DataFrame, text: str, items: str) -> tuple[DataFrame, DataFrame]:
    """(documents, results): a row for each document and one for each of its results, joined by document_id; documents without results are left out."""
    keyed = with_document_id(df.where(F.size(items) > 0), text)
    return keyed.drop(items), keyed.select("document_id", F.explode(items).alias("result"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows in place of old ones of the same key; of several new ones the last by all columns."""
    both = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(key).orderBy(F.desc("_v"), *(F.desc(F.col(c).cast("string")) for c in new.columns))
    return both.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_v", "_r")


def delete_with_results(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Documents that stay when those having results are cleared."""
    return documents.join(found.select("document_id").distinct(), "document_id", "left_anti")


def delete_namespace(history: DataFrame, namespace: str) -> DataFrame:
    return history.where(F.col("namespace") != namespace)


def jsonl(df: DataFrame, path: str, *columns: str) -> None:
    """One JSON object a line; rows whose last column is empty are skipped."""
    df.where(F.col(columns[-1]).isNotNull()).select(F.to_json(F.struct(*columns)).alias("value")).write.mode("append").text(path)


def csv(df: DataFrame, path: str, *columns: str) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def canonical_html(title: Column, doi: Column, abstract: Column, sections: Column) -> Column:
    """The canonical article page; sections is an array of (tag, text)."""
    body = F.array_join(F.transform(sections, lambda s: F.concat(F.lit("<"), s["tag"], F.lit(">"), escape_html(s["text"]), F.lit("</"), s["tag"], F.lit(">"))), "")
    head = F.concat(F.lit("<html><head><title>"), escape_html(title), F.lit("</title><h1>"), escape_html(title), F.lit("</h1><p>doi:<a>"), doi, F.lit("</a></p></head><body>"))
    return F.concat(head, F.lit('<div id="results"></div><div id="abstract"><h2>Abstract</h2><p>'), escape_html(F.coalesce(abstract, F.lit(""))), F.lit('</p></div><div id="sections">'), body, F.lit("</div></body></html>"))


def dead_letters(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows)."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def create_tables(spark: SparkSession, **schemas: str) -> None:
    for name, ddl in schemas.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")


def merged_records(df: DataFrame, doi: str, records: str, path: str) -> None:
    """One line {DOI, records} for each paper that has records."""
    rows = df.where(F.size(records) > 0).select(F.col(doi).alias("DOI"), F.col(records).alias("records"))
    rows.select(F.to_json(F.struct("DOI", "records")).alias("value")).write.mode("append").text(path)


def table_html(caption: Column, rows: Column, footnotes: Column) -> Column:
    """A table (rows of cells) as HTML with caption and footnotes; the first row is its head."""
    cell = lambda tag: lambda c: F.concat(F.lit(f"<{tag}>"), escape_html(F.coalesce(c, F.lit(""))), F.lit(f"</{tag}>"))
    line = lambda r, i: F.concat(F.lit("<tr>"), F.when(i == 0, F.array_join(F.transform(r, cell("th")), "")).otherwise(F.array_join(F.transform(r, cell("td")), "")), F.lit("</tr>"))
    notes = F.array_join(F.transform(F.coalesce(footnotes, F.array().cast("array<string>")), lambda n: F.concat(F.lit("<p>"), escape_html(n), F.lit("</p>"))), "")
    return F.concat(F.lit("<table><caption>"), escape_html(F.coalesce(caption, F.lit(""))), F.lit("</caption>"), F.array_join(F.transform(rows, line), ""), F.lit("</table>"), notes)


def table_json(caption: Column, rows: Column, footnotes: Column) -> Column:
    return F.to_json(F.struct(caption.alias("caption"), rows.alias("body"), footnotes.alias("footnotes")))


def spans_jsonl(paras: DataFrame, spans: DataFrame, key: str = "source", order: str = "para_id", text: str = "page_content") -> DataFrame:
    """(key, value): a paper's text, its paragraphs joined by line feeds, with the paragraphs' spans(start, end, label) moved to
    their places in it, as JSON."""
    before = F.coalesce(F.sum(F.length(text) + 1).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = paras.withColumn("_at", before)
    moved = spans.join(rows.select(key, order, "_at"), [key, order]).groupBy(key).agg(F.array_sort(F.collect_list(F.struct((F.col("start") + F.col("_at")).alias("start"), (F.col("end") + F.col("_at")).alias("end"), "label"))).alias("spans"))
    whole = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, F.col(text).alias("t")))).alias("a")).select(key, F.array_join(F.transform("a", lambda x: x["t"]), "\n").alias("text"))
    return whole.join(moved, key, "left").select(key, F.to_json(F.struct("text", F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint, label: string>>")).alias("spans"))).alias("value"))


def marked(text: Column, spans: Column) -> Column:
    """Text as HTML with its spans(start, end, label), which must not overlap, marked."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        plain = escape_html(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")))
        inner = escape_html(F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
        return F.struct(F.concat(acc["out"], plain, F.lit('<mark title="'), s["label"], F.lit('">'), inner, F.lit("</mark>")).alias("out"), s["end"].cast("long").alias("at"))

    done = F.aggregate(F.array_sort(spans), zero, step)
    return F.concat(done["out"], escape_html(F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))


def label_html(paras: DataFrame, labels: str = "property_types") -> DataFrame:
    """(property, source, html): a head under each property's name, without a source, and one piece for each paper that has it: its
    labelled paragraphs in order, each once. Pieces sorted by property and source, the head first, make the page."""
    rows = paras.select(F.explode(F.array_distinct(labels)).alias("property"), "source", "para_id", "page_content")
    got = rows.groupBy("property", "source").agg(F.array_sort(F.collect_list(F.struct("para_id", "page_content"))).alias("a"))  # a paper's paragraphs
    line = F.transform("a", lambda x: F.concat(F.lit("<p><b>"), escape_html(F.col("source")), F.lit("</b> "), escape_html(x["page_content"]), F.lit("</p>")))
    heads = rows.select("property").distinct().select("property", F.lit(None).cast("string").alias("source"), F.concat(F.lit("<h2>"), escape_html(F.col("property")), F.lit("</h2>")).alias("html"))
    return heads.unionByName(got.select("property", F.col("source").cast("string").alias("source"), F.array_join(line, "").alias("html")))


def write_label_html(paras: DataFrame, path: str, labels: str = "property_types") -> None:
    """label_html() as text files below path, one folder for each property, its pieces in order."""
    rows = label_html(paras, labels).repartitionByRange("property", "source").sortWithinPartitions("property", F.col("source").asc_nulls_first())
    rows.select("property", F.col("html").alias("value")).write.mode("overwrite").partitionBy("property").text(path)


def labelled(paras: DataFrame, path: str) -> None:
    """Labelled paragraphs appended, labels only where they are set."""
    from ..operators.labels import stored_labels

    stored_labels(paras).drop("is_synthesis", "property_types").write.mode("append").parquet(path)


def filled(df: DataFrame, column: str) -> DataFrame:
    """The write stage takes rows with data only: a text that is not empty, a list with entries."""
    kind = dict(df.dtypes)[column]
    return df.where(F.size(column) > 0 if kind.startswith(("array", "map")) else F.coalesce(F.col(column).cast("string"), F.lit("")) != "")


@F.pandas_udf(T.StringType())
def pretty_json(texts: pd.Series) -> pd.Series:
    """JSON indented; a text that is none stays as it is."""

    def one(text):
        try:
            return json.dumps(json.loads(text), indent=4, ensure_ascii=False)
        except (TypeError, ValueError):
            return text

    return texts.map(one).astype(object)


def rotate(spark: SparkSession, folder: str, stamp: str) -> str | None:
    """Move a folder that is not empty to temp/<name>_<stamp> beside it; where to, or None."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    source = fs_path(folder.rstrip("/"))
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(source) or not len(fs.listStatus(source)):
        return None
    temp = fs_path(source.getParent(), "temp")
    fs.mkdirs(temp)
    target = fs_path(temp, f"{source.getName()}_{stamp}")
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be moved")
    return target.toString()


def parsed_articles(raw: DataFrame, parse, skip: DataFrame | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, failed files): files of other types than html and xml are passed over, so are DOIs of the skip list(doi)."""
    files = raw.where(F.lower("source").rlike(r"\.(html|xml)$"))
    files = files if limit is None else files.orderBy("source").limit(limit)
    good, failed = dead_letters(parse(files))
    good = good if skip is None else good.join(skip.select(F.lower("doi").alias("doi")).distinct(), "doi", "left_anti")
    return good, failed


def status_report(df: DataFrame, status: str = "status", key: str = "key") -> DataFrame:
    """(status, n, key): a row with the count of each status, and one for each failed key."""
    counts = df.groupBy(status).agg(F.count(F.lit(1)).alias("n")).select(F.col(status).alias("status"), "n", F.lit(None).cast("string").alias("key"))
    failed = df.where(F.col(status) == "failed").select(F.lit("failed").alias("status"), F.lit(None).cast("long").alias("n"), F.col(key).cast("string").alias("key"))
    return counts.unionByName(failed)
