"""Queries that SQL cannot say, over whole tables against plain loops of another make."""

import re

import pytest
from pyspark.sql import functions as F

from folioflow import catalogue, catalogue_articles  # noqa: F401

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def chunks(spark, name, at):
    got = {}
    for r in catalogue.QUERIES[name](spark, DATA).orderBy("doc_id", at).collect():
        got.setdefault(r.doc_id, []).append(r.chunk)
    return got


def test_chunked_documents(spark, documents):
    """From where a chunk begins, the first sentence beyond 400 words ends it, if 200 are left and it is not the last."""
    def cut(text):
        if len(text.split()) <= 400:
            return [text]
        parts = [s for s in re.split(r"(?<=[.!?])\s+", text) if s]
        size, out, a = [len(s.split()) for s in parts], [], 0
        while True:
            over = next((i for i in range(a + (a > 0), len(parts) - 1) if sum(size[a : i + 1]) > 400), None)
            if over is None or sum(size[over:]) < 200:
                return [*out, " ".join(parts[a:])]
            out += [" ".join(parts[a:over])] if over > a else []
            if over == a:  # the first sentence alone is too long: no empty chunk, the next one counts from it
                over = a if a else 0
                rest = next((i for i in range(a + 1, len(parts) - 1) if sum(size[a : i + 1]) > 400), None)
                if rest is None or sum(size[rest:]) < 200:
                    return [*out, " ".join(parts[a:])]
                out.append(" ".join(parts[a:rest]))
                over = rest
            a = over

    got = chunks(spark, "chunked_documents", "chunk_id")
    assert got == {i: cut(t) for i, t in documents.items()}
    assert sum(len(c) > 1 for c in got.values()) > 20


def test_fulltext_windows(spark, documents):
    got = chunks(spark, "fulltext_windows", "window_id")
    assert got.keys() == {i for i, t in documents.items() if t.split()}
    for i, parts in got.items():
        words = documents[i].split()
        assert [w for p in parts for w in p.split()] == words and all(len(p.split()) <= 5000 for p in parts)
        if len(words) <= 5000:
            assert parts == [documents[i].strip()]
    long = spark.createDataFrame([("a b\n" * 4000,), ("word " * 12000,)], "t string")
    from folioflow.functions import text

    a, b = (r[0] for r in long.select(text.safe_windows("t")).collect())
    assert [len(p.split()) for p in b] == [5000, 5000, 2000] and all(p.endswith("b") and p.startswith("a") for p in a) and sum(len(p.split()) for p in a) == 8000


def test_token_chunks(spark, documents):
    """A chunk ends at the last full stop within a half and one and a half of 300 words, else at 300 words."""
    short = re.compile(r"(ca\.)|(calc\.)|(cal\.)|(no\.)|(e\.g\.)|(i\.e\.)", re.I)

    def cut(text):
        words, out, a = re.findall(r"\s*\S+", text), [], 0
        while a < len(words):
            ends = []
            for k in range(a + 151, min(a + 450, len(words)) + 1):
                after = words[k] if k < len(words) else None
                if words[k - 1].endswith(".") and (after is None or not (re.match(r"\w", after) or short.search("".join(words[max(a, k - 4) : k])))):
                    ends.append(k)
            b = max(ends, default=min(a + 300, len(words)))
            out.append("".join(words[a:b]).strip())
            a = b
        return out

    got = chunks(spark, "token_chunks", "chunk_id")
    assert got == {i: c for i, t in documents.items() if (c := cut(t))}


def test_fuzzy_partition(spark):
    records = catalogue._records(lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")).orderBy("pos").collect()
    parts = {}  # (paper, composition, label) -> [first keywords seen in order, members, grade]
    for r in records:
        key = (r.paper, re.sub(r"\s", "", r.composition), r.label.strip().rstrip(",").strip())
        words = [w for w in r.processing_kw]
        for own in parts.setdefault(key, []):
            mine, known = {w.lower() for w in words}, {w.lower() for w in own[0]}
            both = mine & known
            if words == own[0]:
                grade = "high"
            elif not mine or not known or len(both) == min(len(mine), len(known)):
                grade = "medium"
            elif max(len(both) / len(mine), len(both) / len(known)) >= 0.5:
                grade = "low"
            else:
                continue
            if grade != "high":
                own[0], own[2] = own[0] + [w for w in words if w.lower() not in known], grade
            own[1].append(r.pos)
            break
        else:
            parts[key].append([words, [r.pos], "high"])
    want = sorted((*key, "|".join(kw), ",".join(map(str, m)), g) for key, own in parts.items() for kw, m, g in own)
    got = catalogue.QUERIES["fuzzy_partition"](spark, DATA)
    assert sorted(tuple(r) for r in got.select("paper", "comp", "label", "kw", "members", "confidence").collect()) == want


def paragraphs(html):
    """Text of an article of the tables' pages: its headings and paragraphs, each up to the next of them."""
    body = re.search(r"(?s)<article>(.*?)</article>", html or "")
    return body[1] if body else ""


def test_canonical_articles_keep_every_word(spark):
    """What is read back from the canonical layout is the article's text, its words in order."""
    import html as entities

    pages = {str(r.page_id): paragraphs(r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = {}
    for r in catalogue.QUERIES["canonical_articles"](spark, DATA).orderBy("source", "para_id").collect():
        got.setdefault(r.source, []).append(r)
    checked = 0
    for source, rows in got.items():
        body = pages[source]
        if re.search(r"<(?!/?(?:p|b|i|em|strong|a|br|h1)\b)", body):
            continue  # lists, tables and quotations have rules of their own
        words = entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"(?s)<h\d.*?</h\d>", " ", body))).split()
        assert "".join("".join(r.page_content.split()) for r in rows) == "".join(words)
        checked += 1
    assert checked > 50


def test_publisher_elements_are_the_articles_text(spark):
    import html as entities

    pages = {str(r.page_id): paragraphs(r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = {}
    for r in catalogue.QUERIES["publisher_elements"](spark, DATA).where("text IS NOT NULL").orderBy("source", "pos").collect():
        got.setdefault(r.source, []).append(r.text)
    checked = 0
    for source, texts in got.items():
        body = pages[source]
        if re.search(r"<(?!/?(?:p|b|i|em|strong|br|h1)\b)", body):
            continue
        assert "".join("".join(t.split()) for t in texts) == "".join(entities.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        checked += 1
    assert checked > 20


def test_token_bucket_replay(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s")).collect()
    want = {}
    for r in sorted(events, key=lambda r: r.s):
        have, last, served, refused = want.get(r.user_id, (100.0, r.s, 0, 0))
        have = min(100.0, have + (r.s - last) * 0.01)
        ok = have >= 30
        want[r.user_id] = (have - 30 if ok else have, r.s, served + ok, refused + (not ok))
    got = {r.user_id: (r.have, r.served, r.refused) for r in catalogue.QUERIES["token_bucket_replay"](spark, DATA).collect()}
    assert got == {u: (pytest.approx(h, abs=1e-5), s, n) for u, (h, _, s, n) in want.items()}


def test_hashed_embeddings(spark):
    import zlib

    import numpy as np

    texts = {r.item_id: r.text or "" for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    for r in catalogue.QUERIES["hashed_embeddings"](spark, DATA).collect():
        v = [0.0] * 16
        for h in (zlib.crc32(w.encode()) for w in texts[r.item_id].lower().split()):
            v[h % 16] += 1.0 if h >= 2**31 else -1.0
        assert np.allclose(r.embedding, np.array(v) / np.linalg.norm(v), atol=1e-6)
