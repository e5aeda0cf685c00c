"""Further sources: file lists, full texts, results and requests, spreadsheets, article trees, curated examples."""

from __future__ import annotations

import io
import json
import xml.etree.ElementTree as ET
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quoted_query, windows
from ..operators.documents import with_places
from .articles import _Canonical, parse_articles, read_files, scan_html

FULL_TEXT = "source string, doi string, title string, type_ string, page_content string, error string"


# Files


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def article_files(spark: SparkSession, where: str) -> DataFrame:
    """(source, content) of the files of a folder, or of those that a JSON file lists; anything else is an error."""
    path, fs = _fs(spark, where)
    if fs.exists(path) and fs.getFileStatus(path).isDirectory():
        return scan_html(spark, where)
    if not where.endswith(".json") or not fs.exists(path):
        raise ValueError(f"neither a folder nor a JSON list of files: {where}")
    listed = json.loads(spark.read.text(where, wholetext=True).first()[0])
    files = spark.read.format("binaryFile").load(listed)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source"), F.decode("content", "UTF-8").alias("content"))


def count_files(spark: SparkSession, folder: str) -> int:
    return spark.read.format("binaryFile").load(folder).select("path").count()


def article_tree(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """(publisher, article, file, content) of publisher/article/file, at most `limit` articles by name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    part = lambda k: F.element_at(F.split("path", "/"), k)
    rows = files.select(part(-3).alias("publisher"), part(-2).alias("article"), part(-1).alias("file"), F.decode("content", "UTF-8").alias("content"))
    if limit is None:
        return rows
    return rows.join(rows.select("publisher", "article").distinct().orderBy("publisher", "article").limit(limit), ["publisher", "article"])


def first_texts(tree: DataFrame) -> DataFrame:
    """The first .txt file, by name, of each article."""
    return tree.where(F.col("file").endswith(".txt")).groupBy("publisher", "article").agg(F.min("file").alias("file"), F.min_by("content", "file").alias("content"))


def collected(spark: SparkSession, *folders: str) -> DataFrame:
    """The article files of several crawler folders as one scan; a file name that comes twice is taken from the first folder."""
    rows = None
    for k, folder in enumerate(folders):
        own = scan_html(spark, folder).withColumn("_k", F.lit(k))
        rows = own if rows is None else rows.unionByName(own)
    heads = rows.groupBy("source").agg(F.min("_k").alias("_k"))
    return rows.join(heads, ["source", "_k"]).drop("_k")


# Full texts


class _Text(_Canonical):
    """Tables of a canonical article, and the rest of its body as lines."""

    def __init__(self):
        super().__init__()
        self.lines: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.part = "sections"  # a table counts wherever it stands
        super().handle_starttag(tag, attrs)

    def handle_data(self, data):
        if self.table is None and not self.head and data.strip():
            self.lines.append(data.strip())
        super().handle_data(data)


def _full(source, content):
    p = _Text()
    p.feed(content or "")
    p.close()
    rows = [(source, p.doi, p.title, "table", text, None) for kind, text in p.rows if kind == "table"]
    return rows + [(source, p.doi, p.title, "text", f"Title: {p.title}\n{w}", None) for w in windows("\n".join(p.lines))]


def full_texts(raw: DataFrame, include_table: bool = True) -> DataFrame:
    """Tables first (type_ table), then the body without them in pieces of at most 5000 tokens under the title (type_ text)."""
    rows = read_files(raw.select("source", "content"), FULL_TEXT, _full, lambda source, _, error: (source, None, None, None, None, error))
    return rows if include_table else rows.where("type_ <> 'table' OR type_ IS NULL")


def load(raw: DataFrame, full_text: bool = False) -> DataFrame:
    """Articles as sections (paragraph rows) or as full texts."""
    return full_texts(raw) if full_text else parse_articles(raw)


# Results, requests, vectors


def results_of(results: DataFrame, documents: DataFrame) -> DataFrame:
    """Results of the given documents, with the documents' columns."""
    return results.join(documents, "document_id")


def located(vectors: DataFrame, **metadata) -> DataFrame:
    """Rows of a vector table whose metadata have the given values."""
    for name, value in metadata.items():
        vectors = vectors.where(F.col(name).eqNullSafe(F.lit(value)))
    return vectors


def by_ids(rows: DataFrame, ids: list | DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of the ids with their place in the list (pos); an id that is listed twice comes twice. ids is a list, or a table of them
    (in its first column) with the column that orders it; the table's places are numbered over ranges and never gathered."""
    if isinstance(ids, DataFrame):
        listed = with_places(ids, order).select(F.col(ids.columns[0]).alias("_id"), F.col("place").alias("pos"))
    else:
        schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("_id", rows.schema[key].dataType)])
        listed = rows.sparkSession.createDataFrame(pd.DataFrame({"pos": range(len(ids)), "_id": ids}) if ids else [], schema)
    return rows.join(listed, F.col(key) == F.col("_id")).drop("_id")


def export_lines(results: DataFrame, documents: DataFrame, model_name: str, instruction: str, db_name: str, with_doi: bool = False, limit: int | None = None) -> DataFrame:
    """(line, pos): a header object, then each result as JSON, the DOI its first key where wanted, in order of the documents."""
    spark = results.sparkSession
    fields = [f"result.{f.name}" for f in results.schema["result"].dataType]
    rows = results.join(documents, "document_id")
    rows = rows.orderBy("document_id").limit(limit) if limit is not None else rows
    line = F.to_json(F.struct(*(["doi"] if with_doi else []), *fields))
    numbered = with_places(rows.select(line.alias("line"), "document_id"), "document_id").select("line", (F.col("place") + 1).alias("pos"))
    head = spark.createDataFrame([(json.dumps({"model_name": model_name, "instruction": instruction, "db_name": db_name}), 0)], "line string, pos long")
    return head.unionByName(numbered)


def result_records(spark: SparkSession, path: str) -> DataFrame:
    """The objects of a JSON result file (an array) without the first, its header: pos, record as JSON."""
    whole = spark.read.text(path, wholetext=True)
    items = F.from_json("value", "array<string>")
    return whole.select(F.posexplode(items).alias("pos", "record")).where("pos > 0")


def fenced(prompt: Column, text: Column) -> Column:
    return F.concat(prompt, F.lit("```"), text, F.lit("```"))


def chat_request(system: Column, user: Column, file_name: Column, task_id: Column, doc: Column | None = None, model: str = "default", temperature: float = 0.0) -> Column:
    """One chat request as JSON, with its file and task (and document) as metadata."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    meta = [file_name.alias("file_name"), task_id.alias("task_id"), *([doc.alias("doc")] if doc is not None else [])]
    return F.to_json(F.struct(F.array(message("system", system), message("user", user)).alias("messages"), F.lit(model).alias("model"), F.lit(temperature).alias("temperature"), F.struct(F.lit("json_object").alias("type")).alias("response_format"), F.struct(*meta).alias("metadata")))


def embedding_request(text: Column, file_name: Column, task_id: Column, model: str = "default") -> Column:
    return F.to_json(F.struct(F.lit(model).alias("model"), text.alias("input"), F.struct(file_name.alias("file_name"), task_id.alias("task_id")).alias("metadata")))


def requests_from_embeddings(lines: DataFrame, system: str, prompt: str) -> DataFrame:
    """Chat requests about the texts of embedding request lines(value)."""
    got = lambda path: F.get_json_object("value", path)
    return lines.select(chat_request(F.lit(system), fenced(F.lit(prompt), got("$.input")), got("$.metadata.file_name"), got("$.metadata.task_id").cast("long")).alias("value"))


def format_instructions(schema: dict) -> str:
    """What a model is told about the JSON it should give: the schema without titles and its outer type."""
    def plain(node):
        return {k: plain(v) for k, v in node.items() if k != "title" or isinstance(v, dict)} if isinstance(node, dict) else [plain(x) for x in node] if isinstance(node, list) else node

    return "The output is JSON of this schema:\n" + json.dumps({k: v for k, v in plain(schema).items() if k != "type"})


def curated_examples(spark: SparkSession, path: str, fields: list[str], input_keys: list[str]) -> DataFrame:
    """Rows of a JSON file {examples: [...]}: the fields, of which all but the input keys must be one, the output."""
    outputs = [f for f in fields if f not in input_keys]
    if len(outputs) != 1:
        raise ValueError(f"exactly one output key is needed, not {outputs}")
    rows = spark.read.option("multiLine", True).json(path).select(F.explode("examples").alias("e"))
    return rows.select(*(F.col(f"e.{f}").alias(f) for f in fields))


def open_table(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A store by its table name, made when it is not there yet."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.saveAsTable(name)
    return spark.table(name)


# Lists of articles


def with_prefix(dois: DataFrame, known: list[str], column: str = "doi") -> DataFrame:
    """DOIs whose prefix is one of the known."""
    return dois.where(F.regexp_extract(column, r"^(\d{2}\.\d{4})", 1).isin(*known))


def without_prefix(dois: DataFrame, prefix: str, column: str = "doi") -> DataFrame:
    """Distinct rows whose DOI does not begin with the prefix."""
    return dois.distinct().where(~F.col(column).startswith(prefix))


def search_queries(spark: SparkSession, path: str) -> DataFrame:
    """Search phrases of a CSV file, all its cells, as parts of a URL."""
    rows = spark.read.csv(path)
    cells = rows.select(F.explode(F.array(*rows.columns)).alias("value")).where(F.trim("value") != "")
    return cells.select(quoted_query(F.trim("value")).alias("query"))


def supplement_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Supplementary files listed in a CSV with a publisher column, one publisher's rows together."""
    return spark.read.option("header", True).csv(path).repartition("publisher")


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _sheet(content: bytes) -> list[list[str | None]]:
    """Cells of the first sheet of an XLSX file."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = [] if "xl/sharedStrings.xml" not in z.namelist() else ["".join(t.text or "" for t in s.iter(f"{_NS}t")) for s in ET.fromstring(z.read("xl/sharedStrings.xml"))]
        sheet = ET.fromstring(z.read(min(n for n in z.namelist() if n.startswith("xl/worksheets/"))))
    rows = []
    for row in sheet.iter(f"{_NS}row"):
        cells: list[str | None] = []
        for c in row.iter(f"{_NS}c"):
            column = 0
            for letter in (x for x in c.get("r", "") if x.isalpha()):
                column = column * 26 + ord(letter) - 64
            cells += [None] * (max(column, len(cells) + 1) - 1 - len(cells))
            value = c.findtext(f"{_NS}v")
            cells.append("".join(t.text or "" for t in c.iter(f"{_NS}t")) if c.get("t") == "inlineStr" else shared[int(value)] if c.get("t") == "s" and value is not None else value)
        rows.append(cells)
    return rows


def spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of XLSX files: file, row (0 is the header), cells."""

    def read(batches):
        for pdf in batches:
            out = [(name, k, cells) for name, content in zip(pdf["path"], pdf["content"], strict=True) for k, cells in enumerate(_sheet(content))]
            yield pd.DataFrame(out, columns=["file", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "file string, row int, cells array<string>")


def spreadsheet_column(sheet: DataFrame, name: str) -> DataFrame:
    """(file, row, value) of the column under a heading, where there is a value."""
    heads = sheet.where("row = 0").select("file", F.array_position("cells", name).alias("_at"))
    return sheet.where("row > 0").join(heads, "file").select("file", "row", F.get("cells", (F.col("_at") - 1).cast("int")).alias("value")).where(F.col("value").isNotNull() & (F.col("value") != ""))


def listed_dois(spark: SparkSession, path: str) -> DataFrame:
    """The DOI column of a literature export."""
    return spreadsheet_column(spreadsheet(spark, path), "DOI").select(F.col("value").alias("doi"))


def spreadsheet_to_csv(spark: SparkSession, path: str, out: str) -> None:
    cells = F.transform("cells", lambda c: F.when(c.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit(""))))
    spreadsheet(spark, path).orderBy("file", "row").select(F.array_join(cells, ",").alias("value")).write.mode("overwrite").text(out)
