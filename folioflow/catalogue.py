"""Registered queries of the engine's own operators over the driver's tables, and the SQL that each must agree with.

documents stand for papers (a line of text is a paragraph), source for the publisher, conversations for record groups,
events for measurements of a material (user_id), embeddings for chunk vectors, pages for raw articles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import normalize as N
from .functions import text as X
from .functions.formula import normalise_formula
from .operators import analysis as A
from .operators import documents as D
from .operators import history as H
from .operators import records as R
from .plans.models import embedder, extract, valid_json
from .plans.pipeline import Pipeline, run_with_history, validators, where
from .sources import publishers as P
from .sources import sinks as K
from .sources.articles import parse_articles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (table reader) under its name, with its SQL if there is one."""

    def wrap(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__ = f.__name__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return wrap


#: Each line of a document with its number from 0, blank lines left out.
_PARAS = "p AS (SELECT doc_id, i - 1 AS para_id, l[i] AS para FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE trim(l[i]) <> '')"
_RULES = {"digits": r"[0-9]{2,}", "address": r"[A-Za-z0-9.]+@[A-Za-z0-9.]+", "license": r"(?i)licen[sc]e", "secret": r"(?i)(token|secret|password|api_?key)"}
_LABELS = ", ".join(f"CASE WHEN regexp_matches(para, '{p}') THEN '{k}' END" for k, p in _RULES.items())
_LABELLED = f"{_PARAS}, q AS (SELECT *, list_filter([{_LABELS}], lambda x: x IS NOT NULL) AS property_types FROM p)"


def _labelled(t):
    rules = {k: F.col("para").rlike(p) for k, p in _RULES.items()}
    rules["address"] = F.col("para").contains("@") & rules["address"]  # the pattern alone tries every word
    return D.label(D.paragraphs(t("documents"), "doc_id"), rules)


# Documents and paragraphs


@query(f"WITH {_LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY len(property_types) DESC, para_id) AS rank FROM q WHERE len(property_types) > 0) "
       "SELECT doc_id, string_agg(para, chr(10) ORDER BY para_id) AS rendered, count(*) AS n FROM r WHERE rank <= 3 GROUP BY doc_id")
def flagship(t):
    """Measurement-bearing paragraphs, the best three of each paper rendered together."""
    plan = Pipeline(where(F.size("property_types") > 0)) + (lambda df: D.top_n(df, "doc_id", 3, F.desc(F.size("property_types")), F.col("para_id")))
    top = plan(_labelled(t))
    return D.render(top, "doc_id", "para_id", "para", count="n")


@query("SELECT doc_id, lang, n_chars FROM documents WHERE source = 'src3'")
def doc_scan_by_key(t):
    return t("documents").where(F.col("source") == "src3").select("doc_id", "lang", "n_chars")


@query("SELECT doc_id, source, first_value(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_chars FROM documents")
def doc_with_first(t):
    return D.with_first(t("documents").select("doc_id", "source", "n_chars"), "source", "doc_id", F.col("n_chars"), "first_chars").select("doc_id", "source", "first_chars")


@query(f"WITH {_PARAS} SELECT doc_id, CAST(para_id AS INTEGER) AS para_id, para FROM p")
def para_explode(t):
    return D.paragraphs(t("documents"), "doc_id")


@query(f"WITH {_LABELLED} SELECT doc_id, CAST(para_id AS INTEGER) AS para_id, array_to_string(property_types, ',') AS labels FROM q")
def multi_label(t):
    return _labelled(t).select("doc_id", "para_id", F.array_join("property_types", ",").alias("labels"))


@query(f"WITH {_LABELLED} SELECT doc_id, CAST(para_id AS INTEGER) AS para_id FROM q WHERE list_has_any(property_types, ['address', 'secret'])")
def label_overlap(t):
    return D.with_labels(_labelled(t), "address", "secret").select("doc_id", "para_id")


@query(f"WITH {_LABELLED} SELECT label, count(*) AS n, count(DISTINCT doc_id) AS papers FROM (SELECT doc_id, unnest(property_types) AS label FROM q) GROUP BY label")
def label_report(t):
    return _labelled(t).select("doc_id", F.explode("property_types").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("papers"))


@query(f"WITH {_LABELLED} SELECT doc_id, array_to_string(list_sort(list_distinct(flatten(list(property_types)))), ',') AS labels FROM q GROUP BY doc_id")
def label_union(t):
    labels = _labelled(t).select("doc_id", F.explode_outer("property_types").alias("label"))
    got = labels.groupBy("doc_id").agg(F.array_sort(F.collect_set("label")).alias("a"))
    return got.select("doc_id", F.array_join("a", ",").alias("labels"))


@query(f"WITH {_PARAS} SELECT doc_id, CAST(max(para_id) AS INTEGER) AS para_id, arg_max(para, para_id) AS para FROM p WHERE regexp_matches(para, '^[A-Z]') GROUP BY doc_id")
def last_matching_para(t):
    rows = D.paragraphs(t("documents"), "doc_id").where(F.col("para").rlike("^[A-Z]"))
    return rows.groupBy("doc_id").agg(F.max("para_id").alias("para_id"), F.max_by("para", "para_id").alias("para"))


@query("SELECT d.doc_id FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)")
def paper_filter_semi(t):
    return t("documents").select("doc_id").join(t("labels").where("quality = 1 AND toxic = 0"), "doc_id", "left_semi")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS rendered FROM (SELECT DISTINCT conv_id, turn, first_value(text) OVER (PARTITION BY conv_id, turn ORDER BY text) AS text FROM conversations WHERE trim(text) <> '') GROUP BY conv_id")
def render_paper(t):
    rows = t("conversations").where(F.trim("text") != "").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    return D.render(rows, "conv_id", "turn", "text")


@query("WITH s AS (SELECT doc_id, source, lang, lag(lang) OVER (PARTITION BY source ORDER BY doc_id) AS b FROM documents) "
       "SELECT doc_id, array_to_string(list_filter([source, lang], lambda x: b IS NULL OR (x <> source AND x <> b)), '/') AS new_parts FROM s")
def heading_on_change(t):
    rows = t("documents").select("doc_id", "source", F.concat_ws("/", "source", "lang").alias("path"))
    return D.headings_on_change(rows, "source", "doc_id", "path").select("doc_id", F.array_join("new_parts", "/").alias("new_parts"))


@query("WITH e AS (SELECT event_id, user_id, event_type, CAST(event_id % 3 + 1 AS INTEGER) AS lvl FROM events), "
       "a AS (SELECT *, last_value(CASE WHEN lvl = 1 THEN event_id END IGNORE NULLS) OVER w AS r1, last_value(CASE WHEN lvl = 1 THEN event_type END IGNORE NULLS) OVER w AS t1, last_value(CASE WHEN lvl = 2 THEN event_id END IGNORE NULLS) OVER w AS r2, "
       "last_value(CASE WHEN lvl = 2 THEN event_type END IGNORE NULLS) OVER w AS t2, last_value(CASE WHEN lvl = 3 THEN event_id END IGNORE NULLS) OVER w AS r3, last_value(CASE WHEN lvl = 3 THEN event_type END IGNORE NULLS) OVER w AS t3 "
       "FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) "
       "SELECT event_id, concat_ws('/', t1, CASE WHEN r2 > coalesce(r1, -1) THEN t2 END, CASE WHEN r3 > greatest(coalesce(r1, -1), coalesce(r2, -1)) THEN t3 END) AS sub_titles FROM a")
def heading_stack(t):
    rows = t("events").select("event_id", "user_id", "event_type", (F.col("event_id") % 3 + 1).cast("int").alias("lvl"))
    return D.heading_stack(rows, "user_id", "event_id", "lvl", F.col("event_type"), 3).select("event_id", "sub_titles")


@query(f"WITH {_PARAS}, w AS (SELECT DISTINCT string_split(text, ' ')[1] AS term FROM benchmark WHERE text <> ''), "
       "h AS (SELECT term, doc_id, para_id, row_number() OVER (PARTITION BY term ORDER BY doc_id, para_id) AS r FROM w JOIN p ON contains(para, term) AND regexp_matches(para, '(^|[^\\p{L}\\p{M}\\p{N}_])' || regexp_escape(term) || '($|[^\\p{L}\\p{M}\\p{N}_])')) "
       "SELECT term, doc_id, CAST(para_id AS INTEGER) AS para_id FROM h WHERE r = 1")
def first_mention(t):
    terms = t("benchmark").select(F.element_at(F.split("text", " "), 1).alias("term"))
    return D.first_mention(terms, D.paragraphs(t("documents"), "doc_id"), "term", "doc_id", "para_id", "para").drop("para")


# Sources and text


@query("SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS n_paras FROM pages")
def page_title_and_paras(t):
    return t("pages").select("page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<p>")).alias("n_paras"))


@query("SELECT page_id, CASE WHEN url LIKE '%/en/%' THEN 'english' WHEN url LIKE '%/de/%' THEN 'german' WHEN url LIKE '%/fr/%' THEN 'french' END AS publisher FROM pages WHERE url LIKE '%/en/%' OR url LIKE '%/de/%' OR url LIKE '%/fr/%'")
def page_url_route(t):
    spark = t("pages").sparkSession
    routes = spark.createDataFrame([("en", "english"), ("de", "german"), ("fr", "french")], "prefix string, publisher string")
    rows = t("pages").select("page_id", F.regexp_extract("url", "/(en|de|fr)/", 1).alias("prefix"))
    return rows.join(F.broadcast(routes), "prefix").select("page_id", "publisher")  # three rows


@query("SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) = 7")
def json_path_filter(t):
    return t("events").where(F.get_json_object("props", "$.k").try_cast("int") == 7).select("event_id")


@query("SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(url, '/', '&sol;'), '\\', '&bs;'), '?', '&qm;'), '*', '&st;'), ':', '&cl;'), '|', '&vb;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;') || '.html' AS file_name, url AS back FROM pages")
def filename_roundtrip(t):
    name = X.to_file_name(F.col("url"))
    return t("pages").select("page_id", name.alias("file_name"), X.from_file_name(name).alias("back"))


@query("WITH h AS (SELECT doc_id, text, sha1(unhex('000000000000000000000000000007c0') || sha1(text)::BLOB) AS h FROM documents), "
       "u AS (SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uid FROM h) "
       "SELECT uid, min(doc_id) AS doc_id FROM u GROUP BY uid")
def hash_dedup(t):
    return H.hashed(t("documents").select("doc_id", "text"), "text", "doc_id").select("uid", "doc_id")


@query("SELECT event_id, replace(replace(replace(replace('<b>' || event_type || '&' || props, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '<br>') AS safe FROM events")
def html_escape(t):
    return t("events").select("event_id", X.escape_html(F.concat(F.lit("<b>"), "event_type", F.lit("&"), "props")).alias("safe"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def fenced_json_extract(t):
    said = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nDone."))
    return t("events").select("event_id", F.from_json(X.fenced_json(said), "k int")["k"].alias("k"))


@query("SELECT vec_id, label, d AS similarity FROM (SELECT vec_id, label, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings WHERE vec_id = 0) AS DOUBLE[])), 6) AS d, "
       "row_number() OVER (PARTITION BY label ORDER BY list_dot_product(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings WHERE vec_id = 0) AS DOUBLE[])) DESC, vec_id) AS r FROM embeddings) WHERE r <= 5")
def topn_similar(t):
    """The five most similar chunks of each paper to one query vector."""
    e = t("embeddings")
    query = e.where("vec_id = 0").select("embedding").scalar()
    rows = e.withColumn("query", query).select("vec_id", "label", X.dot(F.col("embedding"), F.col("query")).alias("d"))
    return D.top_n(rows, "label", 5, F.desc("d"), F.col("vec_id")).select("vec_id", "label", F.round("d", 6).alias("similarity"))


@query(None)
def chunked_documents(t):
    return t("documents").select("doc_id", F.posexplode(X.chunk_text("text")).alias("chunk_id", "chunk"))


@query(None)
def fulltext_windows(t):
    return t("documents").select("doc_id", F.posexplode(X.safe_windows("text")).alias("window_id", "chunk"))


@query("SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '[ \\t\\n\\r\\f]+'), lambda w: w <> '')) AS INTEGER) AS n_tokens FROM documents")
def token_counts(t):
    return t("documents").select("doc_id", X.tokens(F.col("text")).alias("n_tokens"))


@query(None)
def canonical_articles(t):
    """Pages put into the canonical layout and parsed again into abstract and section rows."""
    body = F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1)
    page = F.concat(F.lit("<html><head><title>"), F.regexp_extract("html", "<title>(.*?)</title>", 1), F.lit('</title></head><body><div id="sections">'), body, F.lit("</div></body></html>"))
    return parse_articles(t("pages").select(F.col("page_id").cast("string").alias("source"), page.alias("content"))).drop("error")


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS ys, '25' AS temperature, NULL::VARCHAR AS error FROM part")
def model_extraction(t):
    rows = t("part").select("p_partkey", F.concat("p_name", F.lit(" reached "), "p_size", F.lit(" MPa at 25 °C")).alias("text"))
    got = extract(rows, "text")
    return got.select("p_partkey", valid_json(F.col("result"), "ys string, temperature string", ["ys"]).alias("r"), "error").select("p_partkey", "r.ys", "r.temperature", "error")


@query(None)
def hashed_embeddings(t):
    return t("benchmark").select("item_id", embedder(16)("text").alias("embedding"))


@query("SELECT p_partkey FROM part WHERE p_size >= 10 AND p_name LIKE '%a%'")
def validator_gadgets(t):
    rows = t("part").select("p_partkey", F.struct("p_size", "p_name").alias("info"))
    gates = validators(lambda c: F.when(c["p_size"] >= 10, c), lambda c: F.when(c["p_name"].contains("a"), c))
    return gates(rows).select("p_partkey")


# Joins, history, sets


@query("SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def history_anti(t):
    past = t("labels").select(F.col("doc_id").alias("key"), F.lit("ns").alias("namespace"))
    return H.not_done(t("documents").select("doc_id"), past, "doc_id", "ns")


@query("SELECT d.doc_id, d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS done FROM documents d")
def history_flags(t):
    past = t("labels").where("quality = 1").select(F.col("doc_id").alias("key"), F.lit("ns").alias("namespace"))
    return H.done_flags(t("documents").select("doc_id"), past, "doc_id", "ns")


@query("SELECT CAST(d.doc_id AS VARCHAR) AS key, 'phase' AS namespace FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels) AND d.n_chars >= 1000")
def history_run(t):
    """A plan run over the keys that history lacks: what it fails on is not recorded as done."""
    past = t("labels").select(F.col("doc_id").alias("key"), F.lit("phase").alias("namespace"))
    plan = Pipeline() + (lambda df: df.withColumn("words", X.tokens(F.col("text")))) + (lambda df: df.withColumn("status", F.when(F.col("n_chars") < 1000, "FAILED").otherwise("OK")))
    return run_with_history(t("documents").select("doc_id", "text", "n_chars"), past, "doc_id", "phase", plan, "status")[1]


@query("WITH n AS (SELECT DISTINCT md5(text) AS uid, source FROM documents WHERE doc_id % 3 <> 0), o AS (SELECT DISTINCT md5(text) AS uid, source FROM documents WHERE doc_id % 3 <> 1) "
       "SELECT coalesce(n.uid, o.uid) AS uid, coalesce(n.source, o.source) AS source, CASE WHEN o.uid IS NULL THEN 'added' WHEN n.uid IS NULL THEN 'deleted' ELSE 'skipped' END AS action FROM n FULL JOIN o ON n.uid = o.uid AND n.source = o.source "
       "WHERE n.uid IS NOT NULL OR o.source IN (SELECT source FROM n)")
def incremental_index_diff(t):
    docs = t("documents").select("doc_id", "source", F.md5("text").alias("h"))
    side = lambda keep: docs.where(keep).select(F.concat_ws("|", "h", "source").alias("uid"), "source").distinct()
    got = H.index_diff(side("doc_id % 3 <> 0"), side("doc_id % 3 <> 1"))
    return got.select(F.element_at(F.split("uid", "\\|"), 1).alias("uid"), "source", "action")


@query("SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey ORDER BY o.o_orderkey LIMIT 100")
def export_join_limit(t):
    got = t("orders").select("o_orderkey", "o_custkey").join(t("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return got.select("o_orderkey", "c_name").orderBy("o_orderkey").limit(100)


@query("SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS lines FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey")
def fk_multi_result(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber").join(t("orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    got = rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("l_linenumber")).alias("a"))
    return got.select("l_orderkey", "n", F.array_join(F.col("a").cast("array<string>"), ",").alias("lines"))


@query("SELECT p.p_partkey, x.first_order FROM part p LEFT JOIN (SELECT l_partkey, min(l_orderkey) AS first_order FROM lineitem GROUP BY l_partkey) x ON p.p_partkey = x.l_partkey")
def first_match_left_join(t):
    right = t("lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_orderkey").alias("first_order"), F.col("l_orderkey").alias("o"))
    return R.first_match(t("part").select("p_partkey"), right, "p_partkey", "o", "first_order")


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def set_difference(t):
    return t("customer").select("c_custkey").subtract(t("orders").select("o_custkey"))


@query("SELECT event_id AS id, value, 'event' AS kind, NULL::VARCHAR AS status FROM events UNION ALL SELECT o_orderkey, NULL, 'order', o_orderstatus FROM orders")
def set_union_tag(t):
    a = t("events").select(F.col("event_id").alias("id"), "value", F.lit("event").alias("kind"))
    return a.unionByName(t("orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"), F.col("o_orderstatus").alias("status")), allowMissingColumns=True)


@query("SELECT doc_id, CAST(floor((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) / 12) AS BIGINT) AS batch FROM documents")
def batch_slices(t):
    return D.slices(t("documents").select("doc_id", "source"), "source", "doc_id", 12).select("doc_id", "batch")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) <= 20")
def cutoff_guard(t):
    return A.value_counts(t("orders"), "o_custkey").where("n <= 20")


# Records: resolution, merging, conflicts


_RECORDS = "r AS (SELECT p_brand AS paper, CAST(p_partkey AS INTEGER) AS pos, replace(p_type, ' ', '  ') AS comp0, split_part(p_name, ' ', 1) || ' ,' AS label0, string_split(p_name, ' ') AS kw0 FROM part)"


def _records(t):
    return t("part").select(
        F.col("p_brand").alias("paper"), F.col("p_partkey").cast("int").alias("pos"), F.replace("p_type", F.lit(" "), F.lit("  ")).alias("composition"),
        F.concat(F.element_at(F.split("p_name", " "), 1), F.lit(" ,")).alias("label"), F.split("p_name", " ").alias("processing_kw"),
    )


@query(f"WITH {_RECORDS} SELECT paper, replace(comp0, ' ', '') AS comp, trim(rtrim(label0, ',')) AS label, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS members FROM r GROUP BY paper, comp, label, kw0")
def strict_partition(t):
    got = R.partition_strict(_records(t))
    return got.select("paper", "comp", "label", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query(None)
def fuzzy_partition(t):
    return R.partition_fuzzy(_records(t)).select("paper", "comp", "label", F.array_join("kw", "|").alias("kw"), F.array_join(F.col("members").cast("array<string>"), ",").alias("members"), "confidence")


@query("SELECT p_brand AS paper, bool_and(p_partkey % 50 <> 0 AND p_partkey % 50 <> 1) AS covered FROM part GROUP BY p_brand")
def partition_coverage(t):
    """Papers whose records are all in one partition each: some are taken out and some put in twice."""
    records = _records(t)
    spoiled = F.flatten(F.transform("members", lambda m: F.when(m % 50 == 0, F.array().cast("array<int>")).when(m % 50 == 1, F.array(m, m)).otherwise(F.array(m))))
    return R.covers(R.partition_strict(records).withColumn("members", spoiled), records)


@query("SELECT user_id, event_type, min(event_id) AS first_pos, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS members FROM events GROUP BY user_id, event_type")
def rule_group(t):
    got = R.group_by_rule(t("events"), ["user_id", "event_type"], "event_id", "event_id")
    return got.select("user_id", "event_type", "first_pos", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query("SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS properties, bool_or(o_orderstatus = 'F') AS extract_syn FROM orders GROUP BY o_custkey")
def merge_partitions(t):
    rows = t("orders").withColumn("referred", F.col("o_orderstatus") != "F")
    got = R.merge(rows, ["o_custkey"], "o_orderkey", ["o_orderpriority"], F.col("o_orderstatus"), "referred")
    return got.select("o_custkey", "o_orderpriority", F.array_join("properties", ",").alias("properties"), "extract_syn")


@query("SELECT props, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM events WHERE event_type <> 'error' GROUP BY props UNION ALL SELECT NULL, CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'error'")
def merge_by_json_key(t):
    rows = t("events").select("event_id", F.when(F.col("event_type") != "error", F.col("props")).alias("props"))
    return R.merge_by_json(rows, "props", "props", "event_id", "ids").select("props", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query("SELECT concat_ws('|', c_mktsegment, CASE WHEN c_acctbal > 0 THEN 'pos' END) AS key, count(*) AS n FROM customer WHERE c_custkey % 5 <> 0 GROUP BY key UNION ALL SELECT NULL, 1 FROM customer WHERE c_custkey % 5 = 0")
def concat_key_bypass(t):
    key = F.concat_ws("|", "c_mktsegment", F.when(F.col("c_acctbal") > 0, "pos"))
    rows = t("customer").select("c_custkey", key.alias("key"))
    grouped = rows.where("c_custkey % 5 <> 0").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return grouped.union(rows.where("c_custkey % 5 = 0").select(F.lit(None).cast("string"), F.lit(1).cast("long")))


@query("SELECT l_orderkey, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1")
def conflict_keep_consistent(t):
    return R.keep_consistent(t("lineitem"), "l_orderkey", "l_returnflag", "l_linenumber")


@query("WITH s AS (SELECT o_custkey, CAST(epoch(o_orderdate) / 86400 AS BIGINT) AS a, CAST(epoch(o_orderdate) / 86400 AS BIGINT) + 30 AS b FROM orders), "
       "m AS (SELECT *, max(b) OVER (PARTITION BY o_custkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s), "
       "g AS (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM m) "
       "SELECT o_custkey, min(a) AS a, max(b) AS b FROM g GROUP BY o_custkey, island")
def spans_merge(t):
    day = F.unix_date(F.to_date("o_orderdate")).cast("long")
    return R.merge_spans(t("orders").select("o_custkey", day.alias("a"), (day + 30).alias("b")), ["o_custkey"], "a", "b")


@query("SELECT o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity > 0")
def nested_flatten(t):
    """Nested records exploded into flat rows."""
    items = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("items"))
    rows = t("orders").select("o_orderkey").join(items, "o_orderkey")
    return rows.select("o_orderkey", F.inline("items")).where("l_quantity > 0")


# Normalisers


@query("WITH s AS (SELECT p_partkey, p_partkey % 5 AS k, CAST(p_size AS DOUBLE) AS n FROM part) "
       "SELECT p_partkey, CASE k WHEN 0 THEN (n + n + 10) / 2 WHEN 1 THEN n WHEN 2 THEN n WHEN 3 THEN n + 0.5 END AS value, CASE k WHEN 0 THEN 'nm' WHEN 1 THEN 'um' WHEN 2 THEN 'nm' WHEN 3 THEN 'MPa' END AS unit FROM s")
def value_unit_parse(t):
    n = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 5
    said = F.when(k == 0, F.concat(n, F.lit(" – "), (F.col("p_size") + 10).cast("string"), F.lit(" nm"))).when(k == 1, F.concat(n, F.lit(" ± 2 um"))).when(k == 2, F.concat(F.lit("≥ "), n, F.lit("nm"))).when(k == 3, F.concat(F.lit("∼"), n, F.lit(".5 MPa"))).otherwise("invalid")
    return t("part").select("p_partkey", N.value_unit(said).alias("v")).select("p_partkey", "v.value", "v.unit")


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size * 0.001 WHEN 1 THEN CAST(p_size AS DOUBLE) END AS grain, CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE p_size * 1000.0 END AS strength FROM part")
def size_and_strength(t):
    k, n = F.col("p_partkey") % 3, F.col("p_size").cast("string")
    said = F.when(k == 0, F.concat(n, F.lit(" nm"))).when(k == 1, F.concat(n, F.lit(" µm"))).otherwise(F.concat(n, F.lit(" GPa")))
    return t("part").select("p_partkey", N.grain_size_um(said).alias("grain"), N.strength_mpa(said).alias("strength"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN p_size - 273.15 WHEN 2 THEN (p_size - 32) * 5.0 / 9.0 ELSE 25.0 END AS c, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size - 273 WHEN 2 THEN p_size END AS INTEGER) AS whole FROM part")
def temperatures(t):
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    said = F.when(k == 0, F.concat(n, F.lit(" °C"))).when(k == 1, F.concat(n, F.lit(" K"))).when(k == 2, F.concat(n, F.lit("F"))).otherwise("Room temperature")
    return t("part").select("p_partkey", N.temperature_c(said).alias("c"), N.temperature_int(said).alias("whole"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN CASE WHEN p_size > 1 THEN p_size * 100.0 ELSE CAST(p_size AS DOUBLE) END ELSE 0.05 END AS strain, CASE p_partkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.001 ELSE 5e10 END AS rate, CASE p_partkey % 3 WHEN 0 THEN 0.0001 WHEN 1 THEN 0.001 ELSE 5.0 END AS rate_fixed FROM part")
def strains(t):
    k, n = F.col("p_partkey") % 3, F.col("p_size").cast("string")
    s = F.when(k == 0, F.concat(n, F.lit(" %"))).when(k == 1, n).otherwise("0.05")
    r = F.when(k == 0, "1 x 10^-4 s^-1").when(k == 1, "1e-3 s-1").otherwise("5·10")
    return t("part").select("p_partkey", N.strain(s).alias("strain"), N.strain_rate(r).alias("rate"), F.round(N.strain_rate(r, "fixed"), 9).alias("rate_fixed"))


@query("SELECT user_id, string_agg(DISTINCT p, '+' ORDER BY p) AS phases, CASE WHEN bool_or(p IN ('FCC', 'BCC')) AND bool_or(p IN ('L12', 'B2')) THEN 'SS+IM' WHEN bool_or(p IN ('FCC', 'BCC')) THEN 'SS' WHEN bool_or(p IN ('L12', 'B2')) THEN 'IM' END AS class "
       "FROM (SELECT user_id, CASE event_type WHEN 'click' THEN 'FCC' WHEN 'purchase' THEN 'BCC' WHEN 'error' THEN 'L12' WHEN 'signup' THEN 'B2' ELSE 'AM' END AS p FROM events) GROUP BY user_id")
def phase_classify(t):
    said = F.when(F.col("event_type") == "click", "f.c.c. matrix").when(F.col("event_type") == "purchase", "body-centered cubic").when(F.col("event_type") == "error", "ordered FCC").when(F.col("event_type") == "signup", "B2 phase").otherwise("amorphous")
    got = t("events").groupBy("user_id").agg(F.array_sort(F.collect_set(N.phase_name(said))).alias("p"))
    return got.select("user_id", F.array_join("p", "+").alias("phases"), N.phase_class(F.col("p")).alias("class"))


@query("SELECT user_id, CASE WHEN bool_and(event_type IN ('click', 'purchase')) THEN array_to_string(list_concat(list_filter(list(CASE event_type WHEN 'click' THEN 'FCC' ELSE 'BCC' END), lambda x: x = 'FCC'), list_filter(list(CASE event_type WHEN 'click' THEN 'FCC' ELSE 'BCC' END), lambda x: x = 'BCC')), '+') END AS signature, "
       "CASE WHEN bool_or(event_type NOT IN ('click', 'purchase', 'error')) THEN 'unknown' WHEN bool_or(event_type = 'error') AND bool_or(event_type <> 'error') THEN 'ss+im' WHEN bool_or(event_type = 'error') THEN 'im' ELSE 'ss' END AS row_class FROM events GROUP BY user_id")
def phase_signature(t):
    name = F.when(F.col("event_type") == "click", "FCC").when(F.col("event_type") == "purchase", "BCC").when(F.col("event_type") == "error", "L12").otherwise("AM")
    got = t("events").groupBy("user_id").agg(F.collect_list(name).alias("p"))
    return got.select("user_id", N.solid_signature(F.col("p")).alias("signature"), N.row_class(F.col("p")).alias("row_class"))


@query("SELECT conv_id, r[1] = 'user' AS loose, r[1] = 'user' AND list_bool_and(list_transform(r, lambda x: x IN ('user', 'assistant'))) AS strict FROM (SELECT conv_id, list(role ORDER BY turn, role) AS r FROM conversations GROUP BY conv_id)")
def route_filter(t):
    steps = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("s")).select("conv_id", F.transform("s", lambda x: x["role"]).alias("s"))
    return steps.select("conv_id", N.melted_route(F.col("s"), ["user"]).alias("loose"), N.melted_route(F.col("s"), ["user"], ["User", "Assistant"]).alias("strict"))


_SHARE = "regexp_replace(format('{{:.3f}}', {}), '[.]?0+$', '')"


@query(f"SELECT p_partkey, 'Al' || {_SHARE.format('600 / (3 * g + 6)')} || ' Co' || {_SHARE.format('100 * g / (3 * g + 6)')} || ' Cr' || {_SHARE.format('100 * g / (3 * g + 6)')} || ' Ni' || {_SHARE.format('100 * g / (3 * g + 6)')} AS composition FROM (SELECT p_partkey, round(p_size / 3.0::DOUBLE, 3) AS g FROM part)")
def formula_normalise(t):
    said = F.concat(F.lit("(CoCrNi)"), F.col("p_size").cast("string"), F.lit("Al6"))
    return t("part").select("p_partkey", normalise_formula(said).alias("composition"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 1.0 WHEN p_size < 20 THEN 0.5 ELSE 0.0 END AS shared FROM part")
def overlap_fraction(t):
    kw = F.when(F.col("p_size") < 10, F.array(F.lit("A"), F.lit("b"))).when(F.col("p_size") < 20, F.array(F.lit("a"), F.lit("c"))).otherwise(F.array(F.lit("x")))
    return t("part").select("p_partkey", X.overlap(kw, F.array(F.lit("a"), F.lit("B"))).alias("shared"))


@query("SELECT p_partkey, p_brand || ',' || upper(p_type) AS kw FROM part")
def ci_array_dedup(t):
    kw = F.array(F.col("p_brand"), F.upper("p_type"), F.lower("p_brand"), F.col("p_type"))
    return t("part").select("p_partkey", F.array_join(N.first_spellings(kw), ",").alias("kw"))


# Analysis


@query("SELECT event_type, round(avg(value), 6) AS mean_value FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def mean_by_key(t):
    return A.mean_by(t("events"), ["event_type"], "value").select("event_type", F.round("mean_value", 6).alias("mean_value"))


@query("SELECT count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std, min(l_quantity) AS least, round(quantile_cont(l_quantity, 0.25), 6) AS q25, round(quantile_cont(l_quantity, 0.5), 6) AS q50, round(quantile_cont(l_quantity, 0.75), 6) AS q75, max(l_quantity) AS most FROM lineitem")
def describe(t):
    return A.describe(t("lineitem"), "l_quantity")


@query("SELECT CAST(least(19, floor((value - lo) / (hi - lo) * 20)) AS INTEGER) AS bin, count(*) AS n FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) GROUP BY bin")
def histogram(t):
    return A.histogram(t("events"), "value")


@query("SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_counts_nonnull(t):
    return A.value_counts(t("documents"), "lang")


@query("SELECT source, count(DISTINCT lang) AS langs FROM documents GROUP BY source")
def nunique(t):
    return t("documents").groupBy("source").agg(F.countDistinct("lang").alias("langs"))


@query("SELECT event_type, n, round(n / sum(n) OVER (), 6) AS share FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)")
def category_share(t):
    return A.shares(t("events"), "event_type")


@query("SELECT tp, fp, fn, CAST(round_even(2 * tp / (2 * tp + fp + fn), 2) AS DOUBLE) AS f1 FROM (SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 0 AND toxic = 1) AS fp, count(*) FILTER (quality = 1 AND toxic = 0) AS fn FROM labels)")
def f1_scoring(t):
    flag = lambda c: F.expr(c).cast("int")
    rows = t("labels").select(flag("quality = 1 AND toxic = 1").alias("tp"), flag("quality = 0 AND toxic = 1").alias("fp"), flag("quality = 1 AND toxic = 0").alias("fn"))
    return A.f1(rows, "tp", "fp", "fn")


@query("SELECT user_id, round(avg(value), 6) AS mean_value, arg_max(value, event_id) AS last_value FROM events GROUP BY user_id")
def avg_and_last(t):
    return t("events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("mean_value"), F.max_by("value", "event_id").alias("last_value"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def sort_topk(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_acctbal < 4000 AND c_mktsegment IS NOT NULL")
def range_filter(t):
    return t("customer").where("c_acctbal > 0 AND c_acctbal < 4000").na.drop(subset=["c_mktsegment"]).select("c_custkey", "c_acctbal")


# Publishers, sinks and further record operators


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'springer' WHEN 1 THEN 'wiley' WHEN 2 THEN 'elsevier' END AS publisher, '10.1002/x' || page_id AS doi, CASE WHEN page_id >= 0 THEN 'wiley' END AS routed FROM pages")
def publisher_detect(t):
    k = F.col("page_id") % 4
    meta = F.when(k == 0, '<meta name="dc.Publisher" content="Springer">').when(k == 1, '<meta name="citation_publisher" content="John Wiley & Sons, Ltd">').otherwise("")
    title = F.when(k == 2, "<title>A study - ScienceDirect</title>").otherwise("<title>A study</title>")
    doi = P.doi_of(F.concat(F.lit("https://doi.org/10.1002/X"), "page_id"))
    return t("pages").select("page_id", P.detect(F.concat(F.lit("<html><head>"), meta, title, F.lit("</head>"))).alias("publisher"), doi.alias("doi"), P.route(doi).alias("routed"))


@query("SELECT '10.1038/' || doc_id AS doi FROM documents WHERE doc_id % 3 < 2")
def doi_list(t):
    k = F.col("doc_id") % 3
    said = F.when(k == 0, F.concat(F.lit("https://doi.org/10.1038/"), "doc_id")).when(k == 1, F.concat(F.lit("10.1038/"), "doc_id")).otherwise("no doi here")
    return P.doi_lines(t("documents").select(said.alias("value")))


@query(None)
def publisher_elements(t):
    page = F.concat(F.lit('<html><head><meta name="dc.publisher" content="Nature Publishing Group"></head><body><div class="main-content">'), F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1), F.lit("</div></body></html>"))
    return P.parse_publisher_files(t("pages").select(F.col("page_id").cast("string").alias("source"), page.alias("content"))).select("source", "publisher", "pos", "type", "title_size", "text")


@query("SELECT doc_id, source FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id % 2 = 1")
def upsert_rows(t):
    old = t("documents").select("doc_id", "source")
    return K.upsert(old, old.where("doc_id % 2 = 1").select("doc_id", F.lit("new").alias("source")), "doc_id")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def clear_with_results(t):
    docs = t("customer").select(F.col("c_custkey").alias("document_id"))
    return K.delete_with_results(docs, t("orders").select(F.col("o_custkey").alias("document_id"))).select(F.col("document_id").alias("c_custkey"))


@query("SELECT c_custkey, '{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\"}' AS line FROM customer")
def json_lines(t):
    return t("customer").select("c_custkey", F.to_json(F.struct("c_custkey", "c_name")).alias("line"))


@query("WITH k AS (SELECT text, doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents), s AS (SELECT text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents WHERE doc_id % 2 = 0) SELECT k.doc_id AS place, md5(text) AS h FROM s JOIN k USING (text, k)")
def reorder_docs(t):
    docs = t("documents").select("doc_id", "text")
    return D.reorder(docs.where("doc_id % 2 = 0"), docs, "text", "doc_id").select("place", F.md5("text").alias("h"))


@query("SELECT conv_id, '| turn | n | role |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || CASE WHEN b IS NOT DISTINCT FROM turn THEN '' ELSE CAST(turn AS VARCHAR) END || ' | ' || n || ' | ' || role || ' |', chr(10) ORDER BY turn, n) AS \"table\" "
       "FROM (SELECT conv_id, turn, n, role, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn, n) AS b FROM (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations)) GROUP BY conv_id")
def record_markdown(t):
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return D.markdown_table(t("conversations").select("conv_id", "turn", "role", n.alias("n")), "conv_id", "turn", "n", "role")


@query("WITH e AS (SELECT user_id, event_id, CASE event_id % 3 WHEN 0 THEN 'SECTION_ID' WHEN 1 THEN 'SECTION_TITLE' ELSE 'PARAGRAPH' END AS kind, event_type AS txt FROM events), "
       "w AS (SELECT *, lag(kind) OVER o AS bk, lag(txt) OVER o AS b, lead(kind) OVER o AS a FROM e WINDOW o AS (PARTITION BY user_id ORDER BY event_id)) "
       "SELECT event_id, CASE WHEN kind = 'SECTION_TITLE' AND bk = 'SECTION_ID' THEN b || ' ' || txt ELSE txt END AS txt FROM w WHERE NOT (kind = 'SECTION_ID' AND coalesce(a, '') = 'SECTION_TITLE')")
def joined_titles(t):
    k = F.col("event_id") % 3
    kind = F.when(k == 0, "SECTION_ID").when(k == 1, "SECTION_TITLE").otherwise("PARAGRAPH")
    return D.join_titles(t("events").select("user_id", "event_id", kind.alias("kind"), F.col("event_type").alias("txt")), "user_id", "event_id", "kind", "txt").select("event_id", "txt")


@query("SELECT user_id, event_type, g, event_id FROM (SELECT user_id, event_type, event_id % 3 AS g, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3, event_id) AS r FROM events) WHERE r = 1")
def dedup_across_groups(t):
    rows = t("events").select("user_id", "event_type", (F.col("event_id") % 3).alias("g"), "event_id")
    return R.dedup_across_groups(rows, "user_id", ["event_type"], "g", "event_id").select("user_id", "event_type", "g", "event_id")


@query("SELECT o_orderkey, CAST(g AS INTEGER) AS group_index, CAST(i AS INTEGER) AS index, CASE WHEN g = 0 AND i = 0 THEN o_orderstatus WHEN g = 0 THEN 'b' ELSE o_orderpriority END AS record FROM orders, (VALUES (0, 0), (0, 1), (1, 0)) v(g, i)")
def record_groups(t):
    rows = t("orders").select("o_orderkey", F.array(F.array("o_orderstatus", F.lit("b")), F.array("o_orderpriority")).alias("groups"))
    return R.flatten_groups(rows, "groups")


@query("SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 1 AND doc_id % 5 NOT IN (1, 3)")
def all_verdicts(t):
    said = F.element_at(F.array(*(F.lit(x) for x in ("True", "it is fALSe", "fine", "False", "no"))), (F.col("doc_id") % 5 + 1).cast("int"))
    rows = t("labels").select("doc_id", F.create_map(F.lit("q"), F.col("quality") == 1, F.lit("t"), F.col("toxic") == 1).alias("v"), said.alias("s"))
    return rows.where(R.all_true(F.col("v")) & R.none_false(F.col("s"))).select("doc_id")


@query("SELECT p_brand, min(p_partkey) AS head, CAST(count(*) AS INTEGER) AS n FROM part GROUP BY p_brand, left(p_type, 2)")
def hierarchical_groups(t):
    """Parts of a brand grouped by the beginning of their type, twelve at a time, until a brand's groups fit one batch."""
    def by_letter(texts):
        found: dict[str, list[int]] = {}
        for i, x in enumerate(texts):
            found.setdefault(x[:2], []).append(i)
        return list(found.values())

    got = R.group_rounds(t("part").select("p_brand", "p_partkey", "p_type"), "p_brand", "p_partkey", "p_type", by_letter, depth=20)
    return got.select("p_brand", "head", F.size("members").alias("n"))


@query("SELECT l_returnflag, l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey) AS r FROM lineitem) WHERE r = 1")
def best_candidate(t):
    return A.best_of_iteration(t("lineitem"), "l_returnflag", "l_extendedprice", "l_orderkey").select("l_returnflag", "l_orderkey", "l_extendedprice")


@query("SELECT source, CASE WHEN n > 100 THEN 30 ELSE 10 END AS probe, n <= CASE WHEN n > 100 THEN 30 ELSE 10 END AS stop FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def probe_sizes(t):
    return A.value_counts(t("documents"), "source").select("source", A.probe_size(F.col("n")).alias("p")).select("source", "p.probe", "p.stop")


@query(None)
def token_bucket_replay(t):
    rows = t("events").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), F.lit(30).alias("need"))
    return A.token_bucket(rows, "user_id", "s", "need", 0.01, 100)


@query("SELECT user_id, CASE event_type WHEN 'click' THEN 'CH4' WHEN 'error' THEN 'C3H6' ELSE event_type END AS gas, count(*) AS n FROM events GROUP BY user_id, gas")
def gas_names(t):
    said = F.when(F.col("event_type") == "click", "Methane").when(F.col("event_type") == "error", "propane").otherwise(F.col("event_type"))
    return t("events").groupBy("user_id", N.gas_name(said).alias("gas")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Fe' || p_size END AS formula, CASE p_partkey % 3 WHEN 0 THEN 'h2' WHEN 1 THEN 'h3' END AS level FROM part")
def compositions_and_levels(t):
    k, n = F.col("p_partkey") % 3, F.col("p_size").cast("string")
    c = F.when(k == 0, F.concat(F.lit("Fe"), n, F.lit("@at"))).when(k == 1, F.concat(F.lit("Fe"), n, F.lit("@at+TiC"))).otherwise("Fe@wt")
    title = F.when(k == 0, "1 Introduction").when(k == 1, "1.2 Samples").otherwise("Methods")
    return t("part").select("p_partkey", N.atomic_composition(c).alias("formula"), N.title_level(title).alias("level"))
