"""Registered queries of whole flows: papers asked as a whole or in parts, requests with redo rounds, indexes kept up to date, sinks
read back, and the layout of every publisher."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalogue import query
from .catalogue_articles import _LABELLED, GATES, _paper
from .catalogue_stores import _folder
from .operators import history as H
from .operators import labels as L
from .plans import extraction as X
from .plans import requests as Q
from .sources import publishers as P
from .sources import sinks as K
from .sources.store import dealt, stored


def _marked(t, *marks):
    """Labelled paragraphs, those of each (mark, condition) beginning with a line that has the mark."""
    paras = L.label_paper(_paper(t), gates=GATES)
    for mark, condition in marks:
        paras = paras.withColumn("page_content", F.when(condition, F.concat(F.lit(f"\n{mark}"), "page_content")).otherwise(F.col("page_content")))
    return paras


@query(f"WITH {_LABELLED}, h AS (SELECT source, count(*) FILTER (list_contains(labels, 'phase') OR is_synthesis) AS n FROM l GROUP BY source) SELECT source, CASE WHEN n % 3 = 0 THEN 'FAILED' ELSE 'OK' END AS status, CASE WHEN n % 3 <> 0 THEN n END AS n FROM h WHERE n > 0")
def context_answers(t):
    """One question a paper, on all its phase and synthesis paragraphs; the model fails on every third count."""
    def model(text):
        n = text.count("\n@@")
        if n % 3 == 0:
            raise ValueError("three")
        return {"n": n}

    got = X.contextualised(_marked(t, ("@@", L.has_label("phase") | F.col("is_synthesis"))), model, ["phase"])
    return got.select("source", "status", F.get_json_object(F.try_element_at("answers", F.lit(1)), "$.n").cast("long").alias("n"))


@query(f"WITH {_LABELLED}, h AS (SELECT source, count(*) FILTER (list_contains(labels, 'strength')) AS s, count(*) FILTER (list_contains(labels, 'grain_size')) AS g, count(*) FILTER (is_synthesis) AS p FROM l GROUP BY source) "
       "SELECT source, property, n, CASE WHEN p > 0 THEN p END AS steps FROM (SELECT source, 'strength' AS property, s AS n, p FROM h UNION ALL SELECT source, 'grain_size', g, p FROM h) WHERE n > 0")
def isolated_answers(t):
    """Properties and synthesis asked apart, then joined."""
    count = lambda mark: lambda text: {"n": text.count(f"\n{mark}")}
    paras = _marked(t, ("@@", L.has_label("strength")), ("##", L.has_label("grain_size")), ("%%", F.col("is_synthesis")))
    # A paragraph with several marks has one in each of its first lines.
    got = X.isolated(paras, {"strength": count("@@"), "grain_size": count("##")}, count("%%"))
    n = lambda c: F.get_json_object(c, "$.n").cast("long")
    return got.select("source", "property", n("answer").alias("n"), n("synthesis").alias("steps"))


@query(f"WITH {_LABELLED}, a AS (SELECT source, arg_min(title, para_id) AS title, coalesce(string_agg(page_content, chr(10) ORDER BY para_id) FILTER (sub_titles = 'Abstract'), '') AS abstract FROM c GROUP BY source) "
       "SELECT source, para_id, title || chr(10) || abstract || chr(10) || page_content AS text FROM (SELECT source, para_id, page_content, labels FROM l) JOIN a USING (source) WHERE list_contains(labels, 'phase') AND para_id % 2 = 0")
def selected_paragraphs(t):
    """Paragraphs on phases that the originals have, each under its paper's title and abstract."""
    paras = L.label_paper(_paper(t), gates=GATES)
    return X.select_paragraphs(paras, L.has_label("phase"), paras.where("para_id % 2 = 0"), title=True, abstract=True)


@query(f"WITH {_LABELLED} SELECT source, para_id, is_synthesis AS synthesis, CASE WHEN len(labels) > 0 THEN array_to_string(labels, ',') END AS labels FROM l")
def labelled_sink(t):
    """Labelled paragraphs written and read: labels hold only what is set."""
    path = _folder(t("conversations"), "labelled")
    K.labelled(L.label_paper(_paper(t), gates=GATES), path)
    back = t("conversations").sparkSession.read.parquet(path)
    return back.select("source", "para_id", F.coalesce("labels.is_synthesis", F.lit(False)).alias("synthesis"), F.array_join("labels.property_types", ",").alias("labels"))


@query("SELECT pos AS task_id, CASE WHEN k % 5 < 3 THEN 'done' ELSE 'failed' END AS status FROM (SELECT row_number() OVER (ORDER BY item_id) - 1 AS pos, item_id AS k FROM benchmark)")
def redo_rounds(t):
    """Requests of which some succeed at once, some in the first or second redo round, the rest never."""
    asked = Q.requests(t("benchmark").select(F.col("item_id").cast("string").alias("file_name"), "item_id", "text"), ["item_id"], "s", "text")
    turn = iter(range(3))

    def responder(rows):
        now = next(turn)
        number = F.get_json_object("request", "$.metadata.file_name").cast("long") % 5
        return rows.select("task_id", "request", F.when(number <= now, F.lit("{}")).otherwise(Q.FAILED).alias("response"), F.when(number <= now, F.lit("done")).otherwise("failed").alias("status"))

    return Q.controlled(asked, responder, lambda df, k: stored(df, f"round-{k}"), most_redo=2).select("task_id", "status")


_KEPT = "n AS (SELECT DISTINCT source, lang, n_chars FROM documents WHERE doc_id % 3 <> 1 AND source IS NOT NULL AND lang IS NOT NULL), o AS (SELECT DISTINCT source, lang, n_chars FROM documents WHERE doc_id % 3 <> 0 AND source IS NOT NULL AND lang IS NOT NULL)"


@query(f"WITH {_KEPT} SELECT source, lang || '/' || n_chars AS page_content, CASE WHEN (source, lang, n_chars) IN (SELECT * FROM n) THEN 2 ELSE 1 END AS run FROM (SELECT * FROM n UNION SELECT * FROM o WHERE source NOT IN (SELECT source FROM n))")
def index_upkeep(t):
    """A store of documents brought up to date twice: texts that a source no longer has are gone, others keep their time or get a new
    one; the same run again changes nothing."""
    docs = t("documents").where("source IS NOT NULL AND lang IS NOT NULL").select("doc_id", "source", F.concat_ws("/", "lang", "n_chars").alias("page_content"))
    spark, base = docs.sparkSession, _folder(docs, "upkeep")
    run = lambda k, keep: H.update_index(spark, docs.where(keep).select("source", "page_content"), f"{base}/store", f"{base}/record", "ns", F.lit(f"2024-01-0{k} 00:00:00"))
    run(1, "doc_id % 3 <> 0"), run(2, "doc_id % 3 <> 1"), run(2, "doc_id % 3 <> 1")
    times = spark.read.parquet(f"{base}/record").select("uid", F.dayofmonth("updated_at").alias("run"))
    return spark.read.parquet(f"{base}/store").join(times, "uid").select("source", "page_content", "run")


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part")
def csv_columns(t):
    """Some columns of a table as CSV, read back."""
    path = _folder(t("part"), "csv")
    K.csv(t("part"), path, "p_size", "p_partkey", "p_name")
    return t("part").sparkSession.read.option("header", True).csv(path)


# Publishers

_HEAD = {
    "nature": ("Nature Publishing Group", " | Nature"), "springer": ("Springer", " | SpringerLink"), "wiley": ("John Wiley &amp; Sons, Ltd", " - Journal"), "rsc": ("The Royal Society of Chemistry", " - RSC"),
    "acs": (" American Chemical Society ", " | Journal"), "aip": ("AIP Publishing", " | AIP"), "elsevier": (None, " - ScienceDirect"), "aaas": ("American Association for the Advancement of Science", " | Science"),
}
_GRID = "<table><tr><th>x</th><th>y</th></tr><tr><td rowspan=2>1</td><td>2</td></tr><tr><td>3</td></tr></table>"
#: Where a publisher puts the DOI, the abstract, the body and a table. Fixed values.
LAYOUTS = {
    "nature": ('<span class="c-bibliographic-information__value">https://doi.org/{}</span>', '<section aria-labelledby="Abs1"><h2>Abstract</h2><p>{}</p></section>', '<div class="main-content">{}</div>', f'<div class="c-article-table"><b class="c-article-table__title caption">Table 1</b>{_GRID}<div class="c-article-table-footer"><p>note</p></div></div>'),
    "springer": ('<span class="c-bibliographic-information__value">https://doi.org/{}</span>', '<section aria-labelledby="Abs1"><p>{}</p></section>', '<div class="main-content">{}</div>', f'<div class="Table"><div class="Caption">Table 1</div>{_GRID}<div class="TableFooter"><p>note</p></div></div>'),
    "wiley": ('<a class="epub-doi">https://doi.org/{}</a>', '<div class="article-section__abstract"><p>{}</p></div>', '<section class="article-section__full">{}</section>', f'<div class="article-table-content"><header>Table 1</header>{_GRID}<div class="article-section__table-footnotes footnotes">note</div></div>'),
    "rsc": ('<div class="article_info">{}</div>', '<div class="abstract"><p>{}</p></div>', '<div id="wrapper-content" class="article-content">{}</div>', f'<div class="rtable__wrapper"><div class="table_caption">Table 1</div>{_GRID}<tfoot>note</tfoot></div>'),
    "acs": ('<div class="article_header-doiurl">https://doi.org/{}</div>', '<div class="articleBody_abstractText"><p>{}</p></div>', '<div class="article_content">{}</div>', f'<div class="NLM_table-wrap"><div class="NLM_caption">Table 1</div>{_GRID}<div class="NLM_table-wrap-foot"><p>note</p></div></div>'),
    "aip": ('<div class="publicationContentCitation">https://doi.org/{}</div>', '<div class="abstractSection"><p>{}</p></div>', '<div class="hlFld-Fulltext">{}</div>', f'<div class="table-wrap"><div class="caption">Table 1</div>{_GRID}<div class="table-foot">note</div></div>'),
    "elsevier": ('<a class="doi">https://doi.org/{}</a>', '<div class="abstract author"><p>{}</p></div>', '<div class="Body">{}</div>', f'<div class="tables"><span class="captions">Table 1</span>{_GRID}<dl class="footnotes">note</dl></div>'),
    "aaas": ('<div class="self-citation">https://doi.org/{}</div>', '<section class="abstract"><p>{}</p></section>', '<section class="bodymatter">{}</section>', f'<figure class="table"><div class="caption">Table 1</div>{_GRID}<div class="notes">note</div></figure>'),
}
_NAMES = tuple(sorted(LAYOUTS))


def _filled(template: str, *values):
    parts = template.split("{}")
    return F.concat(*(x for pair in zip(map(F.lit, parts), [*values, F.lit("")], strict=True) for x in pair))


def _articles(t):
    """A page of each part, in the layout of one of the publishers."""
    key, page = F.col("p_partkey").cast("string"), None
    for k, name in enumerate(_NAMES):
        (meta, suffix), (doi, abstract, body, table) = _HEAD[name], LAYOUTS[name]
        head = _filled((f'<html><head><meta name="{"citation_publisher" if name == "wiley" else "dc.publisher"}" content="{meta}">' if meta else "<html><head>") + f"<title>{{}}{suffix}</title></head><body>", F.col("p_name"))
        text = _filled('<h2>1 {}</h2><p>It is <a href="#r">1,2</a>{}.</p><div><h3>1.1 More</h3><p>Size {}.</p></div>' + table + "<p> </p>", F.col("p_type"), F.col("p_name"), F.col("p_size").cast("string"))
        own = F.concat(head, _filled(doi, F.concat(F.lit("10.1000/P"), key)), _filled(abstract, F.col("p_brand")), _filled(body, text), F.lit("</body></html>"))
        page = F.when(F.col("p_partkey") % len(_NAMES) == k, own) if page is None else page.when(F.col("p_partkey") % len(_NAMES) == k, own)
    return dealt(t("part").select("p_partkey", "p_name", "p_type", "p_size", "p_brand"), "p_partkey").select(key.alias("source"), page.alias("content"))


_PUBLISHER = "CASE p_partkey % 8 " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(_NAMES)) + " END"


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS source, {_PUBLISHER} AS publisher, '10.1000/p' || p_partkey AS doi, p_name AS title, true AS abstract, kind, size, text FROM part, LATERAL (VALUES "
       "('SECTION_TITLE', 'h2', '1 ' || p_type), ('PARAGRAPH', NULL, 'It is ' || p_name || '.'), ('SECTION_TITLE', 'h3', '1.1 More'), ('PARAGRAPH', NULL, 'Size ' || p_size || '.'), ('TABLE', NULL, 'Table 1' || chr(10) || 'x,y' || chr(10) || '1,2' || chr(10) || ',3' || chr(10) || 'note')) v(kind, size, text)")
def publisher_layouts(t):
    """Elements of articles in the layout of each of the eight publishers."""
    got = P.parse_publisher_files(_articles(t)).join(t("part").select(F.col("p_partkey").cast("string").alias("source"), "p_brand"), "source")
    return got.select("source", "publisher", "doi", "title", F.contains("abstract", "p_brand").alias("abstract"), F.col("type").alias("kind"), F.col("title_size").alias("size"), "text")


@query("SELECT CAST(p_partkey AS VARCHAR) AS source, CASE WHEN p_partkey % 2 = 0 THEN 'elsevier' ELSE 'acs' END AS publisher, '10.1000/p' || p_partkey AS doi, kind, text FROM part, LATERAL (VALUES "
       "('SECTION_ID', CASE WHEN p_partkey % 2 = 0 THEN '1' END), ('SECTION_TITLE', '1 ' || p_type), ('PARAGRAPH', p_name || ' tail'), ('TABLE', 'Table 1. Values' || chr(10) || 'wide,' || chr(10) || p_size || ',b' || chr(10) || 'note')) v(kind, text) WHERE text IS NOT NULL")
def publisher_xml(t):
    """The two XML formats: labels, titles, paragraphs, and tables with cells over several columns."""
    name, kind, size, doi = F.col("p_name"), F.col("p_type"), F.col("p_size").cast("string"), F.concat(F.lit("10.1000/P"), F.col("p_partkey").cast("string"))
    elsevier = _filled('<?xml version="1.0"?><full xmlns="http://www.elsevier.com/xml/svapi/article/dtd" xmlns:ce="http://www.elsevier.com/xml/common/dtd" xmlns:c="http://www.elsevier.com/xml/common/cals/dtd"><ce:doi>{}</ce:doi><ce:title>T</ce:title><ce:sections><ce:section><ce:label>1</ce:label><ce:section-title>1 {}</ce:section-title>'
                       '<ce:para>{}<ce:table><ce:label>Table 1</ce:label><ce:caption>Values</ce:caption><c:tgroup><c:row><c:entry namest="col1" nameend="col2">wide</c:entry></c:row><c:row><c:entry>{}</c:entry><c:entry>b</c:entry></c:row></c:tgroup><ce:table-footnote>note</ce:table-footnote></ce:table> tail</ce:para></ce:section></ce:sections></full>', doi, kind, name, size)  # fmt: skip
    acs = _filled('<?xml version="1.0"?><article><front><publisher-name>American Chemical Society</publisher-name><article-id>{}</article-id><article-title>T</article-title></front><body><sec><title>1 {}</title><p>{} tail</p>'
                  '<table-wrap><label>Table 1</label><caption>Values</caption><table><tr><td colspan="2">wide</td></tr><tr><td>{}</td><td>b</td></tr></table><table-wrap-foot><fn>note</fn></table-wrap-foot></table-wrap></sec></body></article>', doi, kind, name, size)  # fmt: skip
    raw = dealt(t("part").select("p_partkey", "p_name", "p_type", "p_size"), "p_partkey").select(F.col("p_partkey").cast("string").alias("source"), F.when(F.col("p_partkey") % 2 == 0, elsevier).otherwise(acs).alias("content"))
    return P.parse_publisher_files(raw).select("source", "publisher", "doi", F.col("type").alias("kind"), "text")
