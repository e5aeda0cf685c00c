"""Queries on labelled paragraphs against their SQL where words meet other letters, other white space and other cases than ASCII."""

import duckdb
import pytest

from folioflow import catalogue, catalogue_flows, catalogue_plans, catalogue_stores  # noqa: F401

from .test_catalogue import plain

TEXTS = (
    "ñbococi que", "éFCC", "FCCé", "x FCC.", "5\x0b% of it", "5\u00a0%", "5\r%", "f\rc\u2028c. x", "fñcñcé x", "b\nc\nc\n", "12 MPaé", "é12 GPa", "ſtrength", "the ſtrain rate", "strain\u00a0rate", "grain\x0bsize 3 µm",
    "grain ñ size 3 mm", "grains of ſize 3 Μm", "grain size 3 ñmm", "grain size of micronſ", "a 3at.%", "é3 wt\x0b%", "at.\u2009%", "Ban\u212a roll", "caſt", "ſinter", "hexagonal cloſe-pac\u212aed", "bandgap éeV", "Band\x0bGap eV", "Egé eV", "cm3\x0bg", "mmol g", "٣ %", "3٫5 %", "L12ſ", "IM\u0301 ", "plain",
)
NAMES = ["context_answers", "isolated_answers", "label_pages", "labelled_roundtrip", "labelled_sink", "labels_asked_once", "para_labels", "property_answers", "regroup_targets", "relevant_paragraphs", "section_filters", "selected_paragraphs"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("odd")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (conv_id BIGINT, turn INTEGER, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, 'user', ?)", [(c, k, TEXTS[(c * 14 + k) % len(TEXTS)]) for c in range(56) for k in range(14)])
    con.execute(f"COPY t TO '{path}/conversations.parquet'")
    return str(path)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    got, want = catalogue.QUERIES[name](spark, folder).toPandas(), con.execute(catalogue.ORACLE_SQL[name]).df()
    assert plain(got) == plain(want)
