"""Registered queries of extraction plans, requests and sinks, with deterministic functions in the place of models."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .catalogue import query
from .catalogue_articles import _LABELLED, _PAPER, GATES, _paper
from .operators import history as H
from .operators import labels as L
from .plans import extraction as X
from .plans import requests as Q
from .sources import documents as S
from .sources import sinks as K
from .sources.store import dealt


def _words(text: str):
    if "red" in text:
        raise ValueError("no red")
    return [{"w": w} for w in text.split() if w != "widget"]


@query("SELECT p_partkey, CAST(len(list_filter(string_split(p_name, ' '), lambda w: w <> 'widget' AND NOT contains(p_name, 'red'))) AS INTEGER) AS n, CASE WHEN contains(p_name, 'red') THEN 'ValueError: no red' END AS error FROM part")
def model_answers(t):
    """Answers of a model that fails on some texts: their rows say so, the others go on."""
    return X.answers(t("part").select("p_partkey", "p_name"), "p_name", _words).select("p_partkey", F.size("answers").alias("n"), "error")


@query("SELECT p_partkey, CAST(i - 1 AS INTEGER) AS answer_id, w[i] AS word FROM (SELECT p_partkey, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda w: w <> 'widget') AS w FROM part WHERE NOT contains(p_name, 'red')))")
def extracted_answers(t):
    return X.extracted(t("part").select("p_partkey", "p_name"), "p_name", _words).select("p_partkey", "answer_id", F.get_json_object("answer", "$.w").alias("word"))


_SAID = "CASE p_size % 5 WHEN 0 THEN '{\"ys\": \"' || p_name || '\"}' WHEN 1 THEN '{\"n\": ' || p_size || '}' WHEN 2 THEN '{\"ys\": \"x\", \"n\": \"many\"}' WHEN 3 THEN '{\"ys\": \"x\", \"more\": 1}' ELSE 'nothing' END"


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 'ys is missing' WHEN 2 THEN 'n is no int' WHEN 3 THEN 'more is not known' ELSE 'not an object,ys is missing' END AS errors, CASE WHEN p_size % 5 = 0 THEN p_name END AS ys FROM part")
def checked_answers(t):
    """Answers against the fields they should have."""
    c = X.checked(F.expr(_SAID), {"ys": ("string", True), "n": ("int", False)})
    return t("part").select("p_partkey", c.alias("c")).select("p_partkey", F.array_join("c.errors", ",").alias("errors"), "c.value.ys")


@query("SELECT o_orderkey, 'Order ' || o_orderkey || ' is {' || o_orderstatus || '}.' AS text FROM orders")
def filled_prompts(t):
    return t("orders").select("o_orderkey", X.prompt("Order {key} is {{{status}}}.", key=F.col("o_orderkey"), status=F.col("o_orderstatus")).alias("text"))


@query("SELECT item_id, CASE WHEN len(text) % 3 = 0 THEN 'short' WHEN len(text) % 3 = 1 THEN 'long' END AS class FROM benchmark")
def classified_texts(t):
    """A classifier whose third answer is none of the classes."""
    return X.classified(t("benchmark"), "text", lambda s: ("short", "long", "else")[len(s) % 3], ["short", "long"]).select("item_id", "class")


@query("SELECT item_id FROM benchmark WHERE len(text) % 2 = 0")
def judged_texts(t):
    return X.accepted(t("benchmark"), "text", lambda s: {"valid": len(s) % 2 == 0}).select("item_id")


@query("SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'cheap' WHEN p_type = 'SMALL' THEN 'little' ELSE p_type END AS material FROM part WHERE p_type <> 'PROMO' AND p_size % 10 <> 0")
def standard_names(t):
    """Names without those to drop and without unknown values, acronyms spelled out."""
    spark = t("part").sparkSession
    found = t("part").select("p_partkey", F.col("p_type").alias("material"), F.when(F.col("p_size") % 10 == 0, "unknown").otherwise("1").alias("band_gap"))
    known = spark.createDataFrame([("ECONOMY", "cheap"), ("SMALL", "little")], "acronym string, full string")
    return X.standard_names(found, spark.createDataFrame([("PROMO",)], "name string"), known, value="band_gap").select("p_partkey", "material")


def _made(text: str):
    n = int(text)
    return [{"reaction_type": "solid-state" if n % 3 else "other", "precursors": ["A", "B"][: n % 2 + 1], "target": f"T{n}"}, {"reaction_type": "solid-state", "precursors": [], "target": "none"}]


@query("SELECT p_partkey, 't' || p_partkey AS target, CAST(p_partkey % 2 + 1 AS INTEGER) AS n FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0")
def reaction_program(t):
    """Reactions extracted, those of the solid state resolved, those with precursors cleaned."""
    resolve = lambda s: [{**r, "target": r["target"].lower()} for r in json.loads(s)]
    clean = lambda s: [r for r in json.loads(s) if int(r["target"][1:]) % 5]
    got = X.reactions(t("part").select("p_partkey", F.col("p_partkey").cast("string").alias("t")), "t", _made, resolve, clean)
    return got.select("p_partkey", F.inline("reactions")).select("p_partkey", "target", F.size("precursors").alias("n"))


@query(f"WITH {_LABELLED}, h AS (SELECT source, count(*) FILTER (list_contains(labels, 'strength')) AS n FROM l GROUP BY source) SELECT source, n FROM h WHERE n > 0")
def property_answers(t):
    """What a model sees of each paper's strength paragraphs: here it counts the marked lines."""
    paras = L.label_paper(_paper(t), gates=GATES).withColumn("page_content", F.when(L.has_label("strength"), F.concat(F.lit("\n@@"), "page_content")).otherwise(F.col("page_content")))
    got = X.extract_properties(paras, {"strength": lambda s: {"n": s.count("\n@@")}})
    return got.select("source", F.get_json_object("answer", "$.n").cast("long").alias("n"))


@query("SELECT pos AS task_id, CASE WHEN k % 4 = 0 THEN 'failed' ELSE 'done' END AS status, CASE WHEN k % 4 = 0 THEN 'Failed' ELSE CAST(k AS VARCHAR) END AS response FROM (SELECT row_number() OVER (ORDER BY item_id) - 1 AS pos, item_id AS k FROM benchmark)")
def bulk_responses(t):
    """Requests asked twice: what fails at first for one reason is mended, the rest stays failed."""
    asked = Q.requests(t("benchmark").select(F.col("item_id").cast("string").alias("file_name"), "item_id", "text"), ["item_id"], "s", "text")
    number = lambda s: int(json.loads(s)["metadata"]["file_name"])
    first = Q.respond(asked, lambda s: str(number(s)) if number(s) % 4 and number(s) % 3 else None, attempts=1)
    again = Q.respond(Q.redo(first), lambda s: str(number(s)) if number(s) % 4 else None, attempts=1)
    return Q.merged(first, again).select("task_id", "status", "response")


@query("SELECT a.p AS place, c_custkey, p_partkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS p FROM customer) a JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS p FROM part) b ON a.p = b.p")
def zipped_rows(t):
    prices = t("part").select("p_partkey", (-F.col("p_retailprice")).alias("o"))
    return Q.zipped(t("customer").select("c_custkey"), prices, ["c_custkey"], ["o", "p_partkey"]).select("place", "c_custkey", "p_partkey")


@query("SELECT d.doc_id, l.quality, d.lang AS text FROM labels l JOIN documents d USING (doc_id)")
def verdict_texts(t):
    corpus = t("documents").select(F.col("doc_id").alias("task_id"), F.lit(0).alias("pos"), F.col("lang").alias("text"))
    twice = corpus.unionByName(corpus.withColumn("pos", F.lit(1)).withColumn("text", F.lit("later")))
    return Q.verdict_texts(t("labels").select(F.col("doc_id").alias("task_id"), "quality"), twice).select(F.col("task_id").alias("doc_id"), "quality", "text")


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 150) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def limited_keys(t):
    past = t("labels").select(F.col("doc_id").alias("key"), F.lit("ns").alias("namespace"))
    return Q.limited_keys(t("documents").select("doc_id"), past, "doc_id", "ns", 150, "doc_id")


@query("SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS place, n_nationkey * 10 + n_regionkey AS result FROM nation")
def ordered_results(t):
    return Q.ordered_map(t("nation").select("n_nationkey", "n_regionkey"), lambda a, b: a * 10 + b, ["n_nationkey"], ["n_nationkey", "n_regionkey"], "long").select("n_nationkey", "place", "result")


@query("SELECT CAST(ceil(count(*) / 7.0) AS BIGINT) <= count(*) AS batches, count(*) AS n FROM customer")
def bulk_batches(t):
    got = Q.bulk(t("customer").select("c_custkey"), lambda pdf: pdf.assign(size=len(pdf)), "c_custkey long, size long", 7)
    return got.agg((F.max("size") <= 7).alias("batches"), F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) FILTER (a AND NOT b) AS added, 0 AS updated, count(*) FILTER (a AND b) AS skipped, count(*) FILTER (b AND NOT a) AS deleted FROM (SELECT source || lang AS uid, bool_or(doc_id % 3 <> 0) AS a, bool_or(doc_id % 5 <> 0) AS b FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY uid)")
def index_counters(t):
    docs = t("documents").where("lang IS NOT NULL AND source IS NOT NULL").select("doc_id", F.concat("source", "lang").alias("uid"), F.lit("s").alias("source"))
    side = lambda keep: docs.where(keep).select("uid", "source").distinct()
    return H.index_counts(H.index_diff(side("doc_id % 3 <> 0"), side("doc_id % 5 <> 0"), "full"))


@query("SELECT p_partkey, '<table><caption>' || p_name || '</caption><tr><th>a</th><th>b</th></tr><tr><td>' || p_size || '</td><td></td></tr></table><p>n &amp; m</p>' AS html, p_name || chr(10) || 'a,b' || chr(10) || p_size || ',' || chr(10) || ',c' AS csv FROM part")
def table_forms(t):
    """A table written as HTML, and a canonical page's table with a cell over two rows read back as text."""
    rows = F.array(F.array(F.lit("a"), F.lit("b")), F.array(F.col("p_size").cast("string"), F.lit(None).cast("string")))
    page = F.concat(F.lit('<html><head><title>T</title></head><body><div id="sections"><table><caption>'), "p_name", F.lit("</caption><tr><td>a</td><td>b</td></tr><tr><td rowspan=2>"), F.col("p_size").cast("string"), F.lit("</td><td></td></tr><tr><td>c</td></tr></table></div></body></html>"))
    read = S.load(dealt(t("part").select("p_partkey", "p_name", "p_size"), "p_partkey").select(F.col("p_partkey").cast("string").alias("source"), page.alias("content"))).select(F.col("source").cast("long").alias("p_partkey"), F.col("page_content").alias("csv"))
    made = t("part").select("p_partkey", K.table_html(F.col("p_name"), rows, F.array(F.lit("n & m"))).alias("html"))
    return made.join(read, "p_partkey")


@query("SELECT p_partkey, 'table' AS type_, 'C' || chr(10) || 'a' AS page_content FROM part UNION ALL SELECT p_partkey, 'text', 'Title: ' || p_name || chr(10) || 'In short.' || chr(10) || 'Size ' || p_size FROM part")
def full_text_rows(t):
    """Tables first, then the rest of the body under its title."""
    page = F.concat(F.lit("<html><head><title>"), "p_name", F.lit('</title></head><body><div id="abstract"><p>In short.</p></div><div id="sections"><table><caption>C</caption><tr><td>a</td></tr></table><p>Size '), F.col("p_size").cast("string"), F.lit("</p></div></body></html>"))
    got = S.load(dealt(t("part").select("p_partkey", "p_name", "p_size"), "p_partkey").select(F.col("p_partkey").cast("string").alias("source"), page.alias("content")), full_text=True)
    return got.select(F.col("source").cast("long").alias("p_partkey"), "type_", "page_content")


@query(f"WITH {_LABELLED}, u AS (SELECT source, para_id, page_content, unnest(labels) AS property FROM l) SELECT DISTINCT property, NULL AS source, '<h2>' || property || '</h2>' AS html FROM u UNION ALL SELECT property, source, string_agg('<p><b>' || source || '</b> ' || replace(replace(replace(replace(page_content, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '<br>') || '</p>', '' ORDER BY para_id) AS html FROM u GROUP BY property, source")
def label_pages(t):
    return K.label_html(L.label_paper(_paper(t), gates=GATES))


@query(f"WITH {_PAPER}, w AS (SELECT source, string_agg(page_content, chr(10) ORDER BY para_id) AS text FROM c GROUP BY source), s AS (SELECT source, para_id, instr(page_content, 'FCC') AS at FROM c WHERE contains(page_content, 'FCC')) "
       "SELECT source, CAST(len(text) AS INTEGER) AS n, coalesce(k, 0) AS spans, true AS exact FROM w LEFT JOIN (SELECT source, count(*) AS k FROM s GROUP BY source) USING (source)")
def global_spans(t):
    """Spans of paragraphs moved to their places in the whole text: the text there is what was marked."""
    paras = _paper(t)
    at = F.instr("page_content", "FCC")
    spans = paras.where(at > 0).select("source", "para_id", (at - 1).alias("start"), (at + 2).alias("end"), F.lit("phase").alias("label"))
    got = K.spans_jsonl(paras, spans).select("source", F.from_json("value", "text string, spans array<struct<start: int, end: int, label: string>>").alias("v")).select("source", "v.text", "v.spans")
    exact = F.forall("spans", lambda s: F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]) == "FCC")
    return got.select("source", F.length("text").alias("n"), F.size("spans").cast("long").alias("spans"), exact.alias("exact"))
