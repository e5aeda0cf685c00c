"""Every publisher's rules on a page of its layout, with tables, notes and figures, and both XML formats."""

import pytest
from pyspark.sql import functions as F

from folioflow.sources import publishers as P

HEAD = {
    "nature": '<meta name="dc.publisher" content="Nature Publishing Group"><title>On alloys | Nature</title>', "springer": '<meta name="dc.publisher" content="Springer"><title>On alloys | SpringerLink</title>',
    "wiley": '<meta name="citation_publisher" content="John Wiley &amp; Sons, Ltd"><title>On alloys - Journal</title>',
    "rsc": '<meta name="dc.publisher" content="The Royal Society of Chemistry"><title>On alloys - RSC</title>', "acs": '<meta name="dc.publisher" content=" American Chemical Society "><title>On alloys | Journal</title>',
    "aip": '<meta name="dc.publisher" content="AIP Publishing"><title>On alloys | AIP</title>', "elsevier": "<title>On alloys - ScienceDirect</title>", "aaas": '<meta name="dc.publisher" content="American Association for the Advancement of Science"><title>On alloys | Science</title>',
}
GRID = "<table><tr><th>x</th><th>y</th></tr><tr><td rowspan=2>1</td><td>2</td></tr><tr><td>3</td></tr></table>"
#: (where the DOI is, abstract, body, table, figure) in the publisher's own classes.
PARTS = {
    "nature": ('<span class="c-bibliographic-information__value">https://doi.org/10.1038/X1</span>', '<section aria-labelledby="Abs1"><h2>Abstract</h2><p>In short.</p></section>', '<div class="main-content">{}</div>', f'<div class="c-article-table"><b class="c-article-table__title caption">Table 1</b>{GRID}<div class="c-article-table-footer"><p>note</p></div></div>', '<figure><figcaption class="caption">Fig. 1</figcaption></figure>'),
    "springer": ('<span class="c-bibliographic-information__value">https://doi.org/10.1007/X1</span>', '<section aria-labelledby="Abs1"><p>In short.</p></section>', '<div class="main-content">{}</div>', f'<div class="Table"><div class="Caption">Table 1</div>{GRID}<div class="TableFooter"><p>note</p></div></div>', '<figure><div class="Caption">Fig. 1</div></figure>'),
    "wiley": ('<a class="epub-doi">https://doi.org/10.1002/X1</a>', '<div class="article-section__abstract"><p>In short.</p></div>', '<section class="article-section__full">{}</section>', f'<div class="article-table-content"><header>Table 1</header>{GRID}<div class="article-section__table-footnotes footnotes">note</div></div>', '<figure><div class="figure__caption">Fig. 1</div></figure>'),
    "rsc": ('<div class="article_info">10.1039/X1</div>', '<div class="abstract"><p>In short.</p></div>', '<div id="wrapper-content" class="article-content">{}</div>', f'<div class="rtable__wrapper"><div class="table_caption">Table 1</div>{GRID}<tfoot>note</tfoot></div>', '<div class="image_table"><span class="image_title">Fig. 1</span></div>'),
    "acs": ('<div class="article_header-doiurl">https://doi.org/10.1021/X1</div>', '<div class="articleBody_abstractText"><p>In short.</p></div>', '<div class="article_content">{}</div>', f'<div class="NLM_table-wrap"><div class="NLM_caption">Table 1</div>{GRID}<div class="NLM_table-wrap-foot"><p>note</p></div></div>', '<figure><figcaption class="caption">Fig. 1</figcaption></figure>'),
    "aip": ('<div class="publicationContentCitation">https://doi.org/10.1063/X1</div>', '<div class="abstractSection"><p>In short.</p></div>', '<div class="hlFld-Fulltext">{}</div>', f'<div class="table-wrap"><div class="caption">Table 1</div>{GRID}<div class="table-foot">note</div></div>', '<figure><figcaption class="caption">Fig. 1</figcaption></figure>'),
    "elsevier": ('<a class="doi">https://doi.org/10.1016/X1</a>', '<div class="abstract author"><p>In short.</p></div>', '<div class="Body">{}</div>', f'<div class="tables"><span class="captions">Table 1</span>{GRID}<dl class="footnotes">note</dl></div>', '<figure><span class="captions">Fig. 1</span></figure>'),
    "aaas": ('<div class="self-citation">https://doi.org/10.1126/X1</div>', '<section class="abstract"><p>In short.</p></section>', '<section class="bodymatter">{}</section>', f'<figure class="table"><div class="caption">Table 1</div>{GRID}<div class="notes">note</div></figure>', '<figure><div class="caption">Fig. 1</div></figure>'),
}


def page(name):
    doi, abstract, body, table, figure = PARTS[name]
    text = f'<h2>1 Start</h2><p>First <a href="#r">1,2</a>part.</p><div><h3>1.1 More</h3><p>Second.</p></div>{table}{figure}<p> </p>'
    return f"<html><head>{HEAD[name]}</head><body>{doi}{abstract}{body.format(text)}</body></html>"


@pytest.fixture(scope="module")
def parsed(spark):
    raw = spark.createDataFrame([(n, page(n)) for n in PARTS], "source string, content string")
    return {figures: P.parse_publisher_files(raw, figures).orderBy("source", "pos").collect() for figures in (False, True)}


@pytest.mark.parametrize("name", sorted(PARTS))
def test_layout(parsed, name):
    rows = [r for r in parsed[False] if r.source == name]
    assert {r.error for r in rows} == {None} and rows[0].publisher == name
    assert rows[0].title == "On alloys" and rows[0].doi.endswith("/x1") and "In short." in rows[0].abstract
    assert [(r.type, r.title_size, r.text) for r in rows if r.type != "TABLE"] == [("SECTION_TITLE", "h2", "1 Start"), ("PARAGRAPH", None, "First part."), ("SECTION_TITLE", "h3", "1.1 More"), ("PARAGRAPH", None, "Second.")]
    assert [r.text for r in rows if r.type == "TABLE"] == ["Table 1\nx,y\n1,2\n,3\nnote"]
    assert [r.text for r in parsed[True] if r.source == name and r.type == "FIGURE"] == ["Fig. 1"]


ELSEVIER = """<?xml version="1.0"?><full xmlns="http://www.elsevier.com/xml/svapi/article/dtd" xmlns:ce="http://www.elsevier.com/xml/common/dtd" xmlns:c="http://www.elsevier.com/xml/common/cals/dtd"><ce:doi>10.1016/A.B</ce:doi><ce:title>On alloys</ce:title><ce:abstract><ce:para>In short.</ce:para></ce:abstract>
<ce:sections><ce:section><ce:label>1</ce:label><ce:section-title>1 Start</ce:section-title><ce:para>First part.<ce:table><ce:label>Table 1</ce:label><ce:caption>Values</ce:caption><c:tgroup><c:row><c:entry namest="col1" nameend="col2">wide</c:entry></c:row><c:row><c:entry morerows="1">a</c:entry><c:entry>b</c:entry></c:row><c:row><c:entry>c</c:entry></c:row></c:tgroup><ce:table-footnote>note</ce:table-footnote></ce:table> tail</ce:para>
<ce:figure><ce:label>Fig. 1</ce:label><ce:caption>Curve</ce:caption></ce:figure><ce:section><ce:section-title>1.1 More</ce:section-title><ce:para>Second.</ce:para></ce:section></ce:section></ce:sections></full>"""
ACS = """<?xml version="1.0"?><article><front><publisher-name>American Chemical Society</publisher-name><article-id>10.1021/Z</article-id><article-title>On alloys</article-title><abstract>In short.</abstract></front>
<body><sec><title>1 Start</title><p>First part.</p><table-wrap><label>Table 1</label><caption>Values</caption><table><tr><td colspan="2">wide</td></tr><tr><td>a</td><td>b</td></tr></table><table-wrap-foot><fn>note</fn></table-wrap-foot></table-wrap><fig><label>Fig. 1</label><caption>Curve</caption></fig></sec></body></article>"""


def test_xml():
    got = P.read_xml(ELSEVIER, figures=True)
    assert (got["publisher"], got["doi"], got["title"], got["abstract"]) == ("elsevier", "10.1016/a.b", "On alloys", "In short.")
    assert got["elements"] == [
        ("SECTION_ID", None, "1"), ("SECTION_TITLE", "h2", "1 Start"), ("PARAGRAPH", None, "First part. tail"), ("TABLE", None, "Table 1. Values\nwide,\na,b\n,c\nnote"), ("FIGURE", None, "Fig. 1. Curve"), ("SECTION_TITLE", "h3", "1.1 More"), ("PARAGRAPH", None, "Second."),
    ]
    got = P.read_xml(ACS)
    assert got["publisher"] == "acs" and got["elements"] == [("SECTION_TITLE", "h2", "1 Start"), ("PARAGRAPH", None, "First part."), ("TABLE", None, "Table 1. Values\nwide,\na,b\nnote")]
    with pytest.raises(ValueError):
        P.read_xml("<?xml version='1.0'?><a/>")


def test_article_objects(spark, parsed):
    elements = spark.createDataFrame(parsed[False], P.ELEMENTS)
    got = P.articles(elements).where("source = 'nature'").select(F.struct("elements").alias("a")).select("a", P.sections_by_id(F.col("a")).alias("s")).first()
    assert len(got.a.elements) == 5 and got.s == {"1": "Start", "1.1": "More"}
    df = spark.createDataFrame([("a,b\n1,2\n3", ["One", "two."], "Fig. 1", "Curve")], "t string, p array<string>, l string, c string")
    got = df.select(P.table_cell(F.col("t"), 1, 1).alias("cell"), P.table_cell(F.col("t"), 9, 9).alias("out"), P.table_shape(F.col("t")).alias("s"), P.abstract_text(F.col("p")).alias("a"), P.abstract_text(F.col("p"), True).alias("b"), P.figure_text(F.col("l"), F.col("c")).alias("f")).first()
    assert (got["cell"], got.out, got.s.rows, got.s.columns, got.a, got.b, got.f) == ("2", None, 3, 2, "One\ntwo.", "One. two.", "Fig. 1. Curve")
