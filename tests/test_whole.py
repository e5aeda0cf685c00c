"""Queries that once left out rows: every row takes part now."""

import re

from folioflow import catalogue
from folioflow.operators import documents as D

from .test_catalogue import DATA, duck, plain  # noqa: F401


def test_phase_signature_of_all_events(spark, duck):  # noqa: F811
    cut = " WHERE event_id % 40 < 3"
    sql = catalogue.ORACLE_SQL["phase_signature"]
    got = catalogue.QUERIES["phase_signature"](spark, DATA).toPandas()
    want = duck.execute(sql.replace(cut, "")).df()
    assert len(got) == spark.read.parquet(f"{DATA}/events.parquet").select("user_id").distinct().count()
    assert plain(got) == plain(want)


def brute(terms, paras):
    out = {}
    for term in terms:
        seen = [p for p in paras if (term or "").strip() and p[2] and re.search(rf"(?<!\w){re.escape(term)}(?!\w)", p[2])]
        if seen:
            out[term] = min(seen)[:2]
    return out


def test_first_mention_of_any_term(spark):
    texts = ["Fe-Mnx and xFe-Mn, eFe", "so Fe-Mn, (BO2F2)3- a_b", "Ré R high entropy alloys", "high entropy alloy \\E. 50 % *** a+b", "étude a_bc Fe Mn", None, ""]
    terms = ["Fe-Mn", "Ré", "R", "high entropy alloy", "a_b", "a", "étude", "(BO2F2)3-", "\\E.", "***", "a+b", "%", "Fe", "entropy", "none", "", " ", None]
    paras = [(d, p, t) for d in (2, 1) for p, t in enumerate(texts)]
    got = D.first_mention(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame(paras, "doc_id long, para_id int, para string"), "term", "doc_id", "para_id", "para").collect()
    assert {r.term: (r.doc_id, r.para_id) for r in got} == brute(terms, paras)


def test_first_mention_takes_every_term(spark):
    terms = {r.text.split(" ")[0] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    paras = [(r.doc_id, i, line) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() for i, line in enumerate((r.text or "").split("\n"))]
    got = catalogue.QUERIES["first_mention"](spark, DATA).collect()
    assert {r.term: (r.doc_id, r.para_id) for r in got} == brute(terms, paras)
