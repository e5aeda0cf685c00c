"""Article files: scans of raw HTML, and the parser of the canonical layout (title, DOI, abstract, sections, tables)."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import chunk

ROWS = "source string, doi string, title string, sub_titles string, para_id int, page_content string, error string"
_HEADINGS = {f"h{k}": k for k in range(1, 7)}


def scan_html(spark: SparkSession, folder: str) -> DataFrame:
    """(source, content): source is the file name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{html,xml}").option("recursiveFileLookup", True).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source"), F.decode("content", "UTF-8").alias("content"))


def scan_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Request/response lines [request, response or "Failed", metadata]: task_id, file_name, content, response, failed."""
    lines = spark.read.text(path)
    got = lambda p: F.get_json_object("value", p)
    return lines.select(
        got("$[0].metadata.task_id").cast("long").alias("task_id"), got("$[0].metadata.file_name").alias("file_name"), got("$[0].input").alias("content"),
        F.coalesce(got("$[1].content"), got("$[1].embedding")).alias("response"), F.coalesce(got("$[1]") == "Failed", F.lit(False)).alias("failed"),
    )


#: Blocks that a paragraph cannot hold.
_ENDS = frozenset(("p", "div", "table", "ul", "ol", "dl", "section", "article", "body", "html", "blockquote", "pre", "figure"))


class _Canonical(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.doi, self.rows, self.stack = "", "", [], [""] * 6
        self.path: list[tuple[str, str]] = []
        self.part = self.text = ""
        self.table: Table | None = None
        self.head = self.open = False  # open: a paragraph is

    def _paragraph(self):
        text = " ".join(self.text.split())
        if self.open and text and self.part == "abstract":
            self.rows.append(("Abstract", text))
        elif self.open and text and self.part == "sections":
            self.rows.extend(("/".join(x for x in self.stack if x), c) for c in chunk(text))
        self.open, self.text = False, ""

    def close(self):
        super().close()
        self._paragraph()

    def handle_starttag(self, tag, attrs):
        own = dict(attrs).get("id", "") or ""
        if tag in ("br", "img", "meta", "link", "hr"):
            return
        if self.open and self.table is None and (tag in _ENDS or tag in _HEADINGS):
            self._paragraph()  # it ends where the next block begins
        self.path.append((tag, own))
        if tag == "div" and own in ("results", "abstract", "sections"):
            self.part = own
        if tag == "head":
            self.head = True
        if tag == "table" and self.part == "sections":
            self.table = Table()
        if self.table is not None:
            self.table.open(tag, dict(attrs))
        if tag in ("p", "title", "a") or tag in _HEADINGS:
            if tag != "a" or self.head:
                self.text = ""
            self.open = self.open or tag == "p" and self.table is None

    def handle_data(self, data):
        self.text += data
        if self.table is not None:
            self.table.data(data)

    def handle_endtag(self, tag):
        while self.path and self.path[-1][0] != tag:
            self.path.pop()
        if self.path:
            self.path.pop()
        text = " ".join(self.text.split())
        if self.table is not None:
            self.table.close(tag)
            if tag == "table":
                self.rows.append(("table", self.table.csv()))
                self.table = None
            return
        if tag == "head":
            self.head = False
        elif tag == "title":
            self.title = text
        elif tag == "a" and self.head and not self.doi:
            self.doi = text
        elif tag in _HEADINGS and self.part == "sections":
            k = _HEADINGS[tag]
            self.stack[k - 1 :] = [text] + [""] * (6 - k)
        if tag == "p" or self.open and tag in _ENDS:
            self._paragraph()
        elif tag in _HEADINGS:
            self.text = ""


class Table:
    """Cells of one table on a grid: a cell that spans rows or columns fills its first place, the others stay empty."""

    def __init__(self):
        self.caption, self.grid, self.row, self.cell, self.size = "", {}, -1, None, (1, 1)
        self.in_caption = False

    def open(self, tag, attrs):
        if tag == "tr":
            self.row += 1
        elif tag in ("td", "th"):
            span = lambda k: int(attrs.get(k) or 1) if str(attrs.get(k) or 1).isdigit() else 1
            self.cell, self.size = "", (max(1, span("rowspan")), max(1, span("colspan")))
        elif tag == "caption":
            self.in_caption = True

    def data(self, text):
        if self.cell is not None:
            self.cell += text
        elif self.in_caption:
            self.caption += text

    def close(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            column = 0
            while (self.row, column) in self.grid:
                column += 1
            for r in range(self.size[0]):
                for c in range(self.size[1]):
                    self.grid[self.row + r, column + c] = "" if r or c else " ".join(self.cell.split())
            self.cell = None
        elif tag == "caption":
            self.in_caption = False

    def csv(self) -> str:
        if not self.grid:
            return " ".join(self.caption.split())
        rows, columns = max(r for r, _ in self.grid) + 1, max(c for _, c in self.grid) + 1
        lines = [",".join(self.grid.get((r, c), "") for c in range(columns)) for r in range(rows)]
        return "\n".join([x for x in [" ".join(self.caption.split())] if x] + lines)


#: Files that are read before their rows are handed on.
_SLICE = 128


def read_files(raw: DataFrame, schema: str, read: Callable[..., list[tuple]], failed: Callable[..., tuple]) -> DataFrame:
    """The rows that `read` makes of each row of raw; where it raises an error, the one row that `failed` makes of that row and the
    error. A worker holds the rows of a few files at a time, however many a batch has."""
    fields = [f.split() for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, _SLICE):
                rows = []
                for own in zip(*(c.to_pylist() for c in batch.slice(a, _SLICE).columns), strict=True):
                    try:
                        rows += read(*own)
                    except Exception as e:  # errors are data: the row says what went wrong
                        rows.append(failed(*own, f"{type(e).__name__}: {e}"))
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if kind == "int" else pa.string()) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])

    return raw.mapInArrow(run, schema)


def _parse(source, content):
    p = _Canonical()
    p.feed(content or "")
    p.close()
    return [(source, p.doi, p.title, sub, i, text, None) for i, (sub, text) in enumerate(p.rows)]


def parse_articles(raw: DataFrame) -> DataFrame:
    """Paragraph, abstract and table rows of canonical article files raw(source, content); a file that fails gives one row with its error."""
    return read_files(raw.select("source", "content"), ROWS, _parse, lambda source, _, error: (source, None, None, None, None, None, error))
