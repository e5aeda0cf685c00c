"""Suffix-array dedup against brute force: hash-hostile strings, repeated ids, hot keys, long texts, whole tables."""

import random
from hashlib import sha256

import pytest
from folioflow.llm import suffix_dedup as S
from folioflow.llm.common import Workspace

DATA = "/root/testdata/sf0.001"


def brute(texts):
    """{place: (n_bytes, n_removed, n_spans, sha)} of texts in order."""
    seen, out = set(), {}
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            w = raw[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[k] = (len(raw), sum(gone), spans, sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


def result(df):
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()]


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.suffix_dedup(df).collect()}
    assert got == brute(texts)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = brute([r.text for r in rows])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.suffix_dedup(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    assert got == {r.doc_id: want[k] for k, r in enumerate(rows)}


def thue_morse(n, a, b):
    s = a
    while len(s) < n:
        s += s.translate(str.maketrans({a: b, b: a}))
    return s[:n]


def test_strings_that_polynomial_hashes_confuse(spark):
    one, two = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    tail = "the same words stand before and after, " * 3
    check(spark, [tail + one + tail, tail + two + tail, one + "x", two + "y", one])


def test_repeats_of_every_kind(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    block, texts = word(130), []
    for k in range(60):
        cut = rng.randrange(90, 131)
        texts.append(word(rng.randrange(200)) + block[:cut] + word(rng.randrange(150)) + (block[20:] if k % 3 else "") + word(k))
    texts += [texts[3], "ab" * 900, "ab" * 500, None, "", "x" * 99, "x" * 100, "x" * 101, block]
    check(spark, texts)


@pytest.mark.parametrize("hot", [2, 5, 1 << 15])
def test_hot_keys(spark, hot):
    rng = random.Random(hot)
    phrase = "".join(rng.choice("abcdefgh ") for _ in range(95))
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(120))) + phrase + "".join(rng.choice("ab") for _ in range(rng.randrange(8))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    runs = S.repeated_runs(df, Workspace(spark, f"hot-{hot}"), hot).collect()
    gone = {k: set() for k in range(len(texts))}
    for r in runs:
        gone[r.doc_id] |= set(range(r.start, r.start + r.len))
    assert {k: len(v) for k, v in gone.items()} == {k: v[1] for k, v in brute(texts).items()}


def test_one_key_over_several_shards(spark, monkeypatch):
    rng = random.Random(9)
    phrase = "".join(rng.choice("abcdefgh ") for _ in range(80))
    rows = []
    for k in range(60):
        body = "".join(rng.choice("xy") for _ in range(8)) + phrase + "".join(rng.choice("ab") for _ in range(30))
        rows.append((7, k, 0, body.encode()))
    want = brute([r[3].decode() for r in rows])
    got = {k: set() for k in range(60)}
    for doc, start, size in S.covered(rows, 600):
        for d, a, n in zip(doc.tolist(), start.tolist(), size.tolist(), strict=True):
            got[d] |= set(range(a, a + n))
    assert {k: len(v) for k, v in got.items()} == {k: v[1] for k, v in want.items()}


def test_repeated_and_missing_ids(spark):
    same = "q" * 60 + "".join(chr(97 + i % 7) for i in range(110))
    texts = [None, "z" + same, same + "1", same + "2" * 40, "other text " * 4, same + "1"]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[5]), (5, texts[3]), (6, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.n_bytes, r.n_removed, r.kept_sha256) for r in S.suffix_dedup(df).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = brute([t for _, t in order])
    assert got == sorted(((d is not None, d or 0), *want[k][:2], want[k][3]) for k, (d, _) in enumerate(order))


def test_text_over_eight_megabytes(spark):
    rng = random.Random(4)
    part = "".join(rng.choice("abcdefghij") for _ in range(5 << 20))
    long = part + "|" + part + "." * 5 + part[:1000]
    df = spark.createDataFrame([(1, long), (2, "x" + part[5_000:8_000])], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in S.suffix_dedup(df).collect()}
    assert len(long) > 8 << 20 and got[1] == (len(long), len(part) + 1000, 2) and got[2] == (3001, 3000, 1)
    assert S.LENGTH == 100
