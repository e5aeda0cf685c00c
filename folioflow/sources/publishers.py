"""Publisher pages and XML: which publisher, its DOI, and the article as rows of elements.

Each publisher is a row of rules - where its title, abstract, sections and clutter are - read by one walker.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .articles import Table, read_files

ELEMENTS = "source string, publisher string, doi string, title string, abstract string, pos int, type string, title_size string, text string, error string"
#: DOI prefixes, and the publisher names that pages state.
DOI_PREFIX = {"10.1038": "nature", "10.1021": "acs", "10.1126": "aaas", "10.1016": "elsevier", "10.1002": "wiley", "10.1007": "springer", "10.1039": "rsc"}
STATED = [
    ("springer", "^Springer$"), ("nature", "^Nature Publishing Group$"), ("aip", "American Institute of PhysicsAIP|AIP Publishing"), ("acs", r"^\s*American Chemical Society\s*$"),
    ("rsc", r"^\s*The Royal Society of Chemistry\s*$"), ("aaas", r"^\s*American Association for the Advancement of Science\s*$"), ("cjps", r"^\s*World Scientific Publishing Company\s*$"),
]


def detect(html: Column) -> Column:
    """Publisher from the page's meta tags, else from the title's last part; null if none says."""
    stated = F.regexp_extract(html, r"""(?is)<meta[^>]*name=["']dc\.publisher["'][^>]*content=["']([^"']*)["']""", 1)
    cited = F.regexp_extract(html, r"""(?is)<meta[^>]*name=["']citation_publisher["'][^>]*content=["']([^"']*)["']""", 1)
    title = F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    out = F.when(F.lit(False), F.lit(""))
    for name, pattern in STATED:
        out = out.when(stated.rlike(pattern), name)
    out = out.when(F.replace(cited, F.lit("&amp;"), F.lit("&")).contains("John Wiley & Sons, Ltd"), "wiley").when(html.rlike("""(?i)<meta[^>]*name=["']citation_springer_api_url["']"""), "springer")
    out = out.when(html.rlike("""(?i)<html[^>]*xmlns:rsc=["']urn:rsc\\.org["']"""), "rsc")
    return out.when(F.lower(F.element_at(F.split(title, " - "), -1)) == "sciencedirect", "elsevier")


def doi_of(text: Column) -> Column:
    """Lower-cased, without the resolver's address."""
    t = F.lower(F.trim(text))
    return F.trim(F.when(t.contains("https://doi.org/"), F.substring_index(t, "https://doi.org/", -1)).otherwise(t))


def route(doi: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for prefix, name in DOI_PREFIX.items():
        out = out.when(doi.startswith(prefix), name)
    return out


def doi_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """DOIs of a list file: resolver addresses and bare DOIs, other lines dropped."""
    v = F.col(value)
    return lines.where(v.startswith("http") | v.rlike(r"^\d{2}\.\d{4}/.+")).select(F.replace(v, F.lit("https://doi.org/"), F.lit("")).alias("doi"))


@dataclass
class Rules:
    doi: str
    abstract: str
    sections: str
    cut: str | None = None
    clutter: str = r"$^"
    table: str = "^table "
    caption: str = "^caption "
    notes: str = "^tfoot "
    figure: str = "^figure "
    figure_text: str = "caption"


#: Where each publisher keeps its parts, those of its tables and figures too: patterns over "tag class id" of an element.
RULES = {
    "nature": Rules("^span .*bibliographic-information__value", "^section .*(abs|Abs)", "^div .*main-content", "|", "recommendations", "^div .*c-article-table|^table ", "caption|table__title", "footer"),
    "springer": Rules("^span .*bibliographic-information__value", "^section .*(abs|Abs)", "^div .*main-content", "|", "recommendations", "^div .*\\bTable\\b|^div .*c-article-table|^table ", "Caption|caption|table__title", "TableFooter|footer", "^figure |^div .*\\bFigure\\b", "Caption|caption"),
    "wiley": Rules("^a .*epub-doi", "article-section__abstract", "article-section__full", "-", "article-references|citedBy", "^div .*article-table-content|^table ", "^header |caption", "^div .*footnotes|^tfoot "),
    "rsc": Rules("^div .*article_info", "^div .*abstract", "^div .*(article|wrapper)-?(body|content)|pnlArticleContent", "-", "ref-list|article_info", "^div .*(rtable__wrapper|table_wrapper)|^table ", "table_caption|^caption ", "^tfoot ", "^div .*image_table|^figure ", "image_title|caption"),
    "acs": Rules("^div .*article_header-doiurl", "articleBody_abstractText", "article_content", "|", "refs-header|ref-list", "^div .*NLM_table-wrap|^table ", "[cC]aption", "table-wrap-foot"),
    "aip": Rules("^div .*publicationContentCitation", "abstractSection|hlFld-Abstract", "sectionInfo|hlFld-Fulltext", "|", "refs-header|references", "^div .*table-wrap|^table ", "caption|title", "foot"),
    "elsevier": Rules("^a .*doi", "^div .*abstract author", "^div .*Body", "-", "bibliography|related-content", "^div .*tables|^table ", "captions", "legend|^dl .*footnotes|footnotes", "^figure ", "captions"),
    "aaas": Rules("^div .*self-citation", "^(div|section) .*abstract", "^(div|section) .*bodymatter", "|", "bibliography", "^(div|figure) .*table|^table ", "caption", "notes|foot"),
}
_VOID = frozenset("br img meta link hr input col".split())
_REFERENCE = re.compile(r"^\s*\[?\d+[a-z]?(\s*[,–-]\s*\d+[a-z]?)*\]?\s*$")


class Element:
    def __init__(self, tag: str, key: str = ""):
        self.tag, self.key, self.kids = tag, key, []

    def text(self) -> str:
        return " ".join("".join(k if isinstance(k, str) else k.text() for k in self.kids if isinstance(k, str) or not (k.tag == "a" and _REFERENCE.match(k.text()))).split())

    def walk(self):
        for k in self.kids:
            if isinstance(k, Element):
                yield k
                yield from k.walk()

    def first(self, pattern: str):
        return next((e for e in self.walk() if re.search(pattern, e.key)), None)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("root")
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        e = Element(tag, f"{tag} {own.get('class') or ''} {own.get('id') or ''} {own.get('aria-labelledby') or ''}")
        e.attrs = own
        if tag == "p" and any(s.tag == "p" for s in self.stack):
            self.handle_endtag("p")
        self.stack[-1].kids.append(e)
        if tag not in _VOID:
            self.stack.append(e)

    def handle_data(self, data):
        self.stack[-1].kids.append(data)

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return


def _table(e: Element, rules: Rules | None = None) -> str:
    """A table, or what holds one, as caption, comma-separated rows and footnotes, a line each."""
    inner = e if e.tag == "table" else next((x for x in e.walk() if x.tag == "table"), None)
    caption = notes = ""
    if rules and inner is not e:
        outside = [x for x in e.walk() if x is not inner and (inner is None or all(x is not y for y in inner.walk()))]
        caption = next((x.text() for x in outside if re.search(rules.caption, x.key) and x.text()), "")
        notes = next((x.text() for x in outside if re.search(rules.notes, x.key) and x.text()), "")
    t = Table()
    feet: list[str] = []

    def go(x: Element):
        if x.tag == "tfoot":
            feet.append(x.text())
            return
        t.open(x.tag, getattr(x, "attrs", {}))
        for k in x.kids:
            if isinstance(k, str):
                t.data(k)
            else:
                go(k)
        t.close(x.tag)

    if inner is not None:
        go(inner)
    return "\n".join(part for part in (caption, t.csv(), notes, *feet) if part)


def _elements(e: Element, rules: Rules, clutter: str, out: list, figures: bool) -> None:
    for k in e.kids:
        if isinstance(k, str) or re.search(clutter, k.key):
            continue
        if re.fullmatch("h[1-6]", k.tag):
            out.append(("SECTION_TITLE", k.tag, k.text()))
        elif k.tag == "p":
            out.append(("PARAGRAPH", None, k.text()))
        elif re.search(rules.table, k.key) and (k.tag == "table" or any(x.tag == "table" for x in k.walk())):
            out.append(("TABLE", None, _table(k, rules)))
        elif re.search(rules.figure, k.key):
            if figures:
                text = next((x.text() for x in k.walk() if re.search(rules.figure_text, x.key) and x.text()), k.text())
                out.append(("FIGURE", None, text))
        else:
            _elements(k, rules, clutter, out, figures)


def read_html(page: str, publisher: str, figures: bool = False) -> dict:
    rules, parser = RULES[publisher], _Tree()
    parser.feed(page)
    parser.close()
    root = parser.root
    title = next((e.text() for e in root.walk() if e.tag == "title"), "")
    doi, abstract, body = (root.first(p) for p in (rules.doi, rules.abstract, rules.sections))
    found: list = []
    if body is not None:
        if abstract is not None:
            abstract_key = abstract.key
            clutter = f"(?:{rules.clutter})|^{re.escape(abstract_key)}$"
        else:
            clutter = rules.clutter
        _elements(body, rules, clutter, found, figures)
    text = doi.text().lower() if doi is not None else ""
    return {
        "doi": text.split("https://doi.org/")[-1].strip() or None, "title": title.split(rules.cut)[0].strip() if rules.cut else title,
        "abstract": " ".join(p.text() for p in ([e for e in abstract.walk() if e.tag == "p"] or [abstract])) if abstract is not None else None,
        "elements": [f for f in found if f[2]],
    }


def _local(e) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _words(e) -> str:
    return " ".join("".join(e.itertext()).split())


def _column(name: str) -> int:
    return int(name.removeprefix("col"))


def _xml_table(e) -> str:
    """An XML table as caption, comma-separated rows (spans by column names and further rows) and footnotes."""
    t, notes, label, caption = Table(), [], "", ""
    for k in e:
        name = _local(k)
        if name == "label":
            label = _words(k)
        elif name == "caption":
            caption = _words(k)
        elif name in ("table-footnote", "legend"):
            notes.append(_words(k))
        elif name == "table-wrap-foot":
            notes += [_words(x) for x in k if _local(x) == "fn"] or [_words(k)]
    for row in (x for x in e.iter() if _local(x) in ("row", "tr")):
        t.open("tr", {})
        for cell in (x for x in row if _local(x) in ("entry", "td", "th")):
            own = cell.attrib
            wide = _column(own["nameend"]) - _column(own["namest"]) + 1 if "namest" in own and "nameend" in own else int(own.get("colspan", 1))
            t.open("td", {"colspan": str(wide), "rowspan": str(int(own["morerows"]) + 1 if "morerows" in own else own.get("rowspan", 1))})
            t.data(_words(cell))
            t.close("td")
    return "\n".join(x for x in (". ".join(x for x in (label, caption) if x), t.csv(), *notes) if x)


def _xml_figure(e) -> str:
    return ". ".join(x for x in (_words(k) for k in e if _local(k) in ("label", "caption")) if x)


def read_xml(text: str, figures: bool = False) -> dict:
    """Elsevier or ACS XML: labels, titles, paragraphs, tables and, if asked for, figures in document order, depth first."""
    root = ET.fromstring(text)
    publisher = "elsevier" if "elsevier" in root.tag else None
    if publisher is None:
        name = next((_words(e) for e in root.iter() if _local(e) == "publisher-name"), None)
        publisher = "acs" if name == "American Chemical Society" else None
    if publisher is None:
        raise ValueError("publisher not found")
    doi = next(("".join(e.itertext()).strip().lower() for e in root.iter() if _local(e) in ("doi", "article-id")), None)
    kinds = {"label": "SECTION_ID", "section-title": "SECTION_TITLE", "title": "SECTION_TITLE", "para": "PARAGRAPH", "simple-para": "PARAGRAPH", "p": "PARAGRAPH"}
    found: list = []

    def size(title: str):
        return "h2" if re.match(r"^\d(?!\.)", title) else "h3" if re.match(r"^\d\.\d", title) else None

    def plain(e) -> str:
        """Text of a paragraph without the floats inside it."""
        parts = [e.text or ""]
        for k in e:
            parts.append("" if _local(k) in ("table-wrap", "table", "fig", "figure") else plain(k))
            parts.append(k.tail or "")
        return "".join(parts)

    def floats(e):
        for k in e:
            name = _local(k)
            if name in ("table-wrap", "table"):
                found.append(("TABLE", None, _xml_table(k)))
            elif name in ("fig", "figure"):
                if figures:
                    found.append(("FIGURE", None, _xml_figure(k)))
            else:
                floats(k)

    def go(e):
        for k in e:
            name = _local(k)
            if name in kinds:
                body = " ".join(plain(k).split())
                found.append((kinds[name], size(body) if kinds[name] == "SECTION_TITLE" else None, body))
                floats(k)
            elif name in ("table-wrap", "table", "fig", "figure"):
                floats([k])
            elif name in ("sections", "section", "sec", "body", "article", "front", "back") or "section" in name:
                go(k)

    for top in root.iter():
        if _local(top) in ("sections", "body"):
            go(top)
            break
    title = next((_words(e) for e in root.iter() if _local(e) in ("article-title", "title")), "")
    abstract = next((_words(e) for e in root.iter() if _local(e) == "abstract"), None)
    return {"publisher": publisher, "doi": doi, "title": title, "abstract": abstract, "elements": [f for f in found if f[2]]}


def _reader(figures: bool):
    def read(source, publisher, content):
        if (content or "").lstrip().startswith("<?xml"):
            got = read_xml(content, figures)
        elif publisher in RULES:
            got = read_html(content or "", publisher, figures) | {"publisher": publisher}
        else:
            raise ValueError("publisher not found")
        head = (source, got["publisher"], got["doi"], got["title"], got["abstract"])
        return [(*head, i, *e, None) for i, e in enumerate(got["elements"])] or [(*head, None, None, None, None, None)]

    return read


def parse_publisher_files(raw: DataFrame, figures: bool = False) -> DataFrame:
    """Element rows of raw(source, content), with the captions of figures if asked for; a file that fails gives one row with its error."""
    rows = raw.select("source", detect(F.col("content")).alias("publisher"), "content")
    return read_files(rows, ELEMENTS, _reader(figures), lambda source, publisher, _, error: (source, publisher, *[None] * 7, error))


def articles(elements: DataFrame) -> DataFrame:
    """A row for each article (source, publisher, doi, title, abstract, elements) from element rows; its empty paragraphs are gone."""
    item = F.struct("pos", "type", "title_size", "text")
    rows = elements.where("error IS NULL AND (text IS NULL OR trim(text) <> '')")
    return rows.groupBy("source", "publisher", "doi", "title", "abstract").agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), item))).alias("elements"))


def sections_by_id(article: Column) -> Column:
    """map of section number to title, from the elements of an article."""
    titles = F.filter(article["elements"], lambda e: (e["type"] == "SECTION_TITLE") & e["text"].rlike(r"^\d"))
    return F.map_from_entries(F.transform(titles, lambda e: F.struct(F.regexp_extract(e["text"], r"^([\d.]*\d)", 1), F.trim(F.regexp_replace(e["text"], r"^[\d.]+", "")))))


def abstract_text(parts: Column, sentences: bool = False) -> Column:
    """An abstract given in parts: joined by line feeds or, as sentences, by blanks with full stops where they lack one."""
    if not sentences:
        return F.array_join(parts, "\n")
    return F.array_join(F.transform(parts, lambda p: F.when(F.rtrim(p).rlike(r"[.!?]$"), F.rtrim(p)).otherwise(F.concat(F.rtrim(p), F.lit(".")))), " ")


def table_cell(table: Column, row: int, column: int) -> Column:
    """A cell of a table in text form, counted from 0; null beside the table."""
    return F.get(F.split(F.get(F.split(table, "\n"), row), ","), column)


def table_shape(table: Column) -> Column:
    """struct(rows, columns) of a table in text form without caption."""
    lines = F.split(table, "\n")
    return F.struct(F.size(lines).alias("rows"), F.array_max(F.transform(lines, lambda x: F.size(F.split(x, ",")))).alias("columns"))


def figure_text(label: Column, caption: Column) -> Column:
    return F.concat_ws(". ", label, caption)
