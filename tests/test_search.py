"""Retrieval by words, tokens by a tokenizer file, learned embeddings, grouping rounds and prompts, each against brute force."""

import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as plain
from folioflow.functions import tokens
from folioflow.operators import records, retrieval
from folioflow.plans import models, optimiser

DATA = "/root/testdata/sf0.001"
SCHEMA = "source string, para_id int, sub_titles string, page_content string"


@pytest.fixture(scope="module")
def paras(spark):
    rng = random.Random(2)
    words = ["the"] * 12 + ["steel", "phase", "fcc", "Grain", "size", "é", "5", "rate", "strain"]
    rows = [(f"p{k % 5}", k, rng.choice(["Results", "Methods", "1. Results and more", ""]) if k % 5 != 3 else "Other", " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))) + rng.choice(["", ".", "; the end"])) for k in range(120)]
    return spark.createDataFrame([*rows, ("p9", 0, None, None), ("p9", 1, "x", "!!")], SCHEMA)


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_bm25(rows, query, keep=lambda r: True):
    docs = {(r.source, r.para_id): Counter(words_of(r.page_content)) for r in rows}
    docs = {k: c for k, c in docs.items() if c}
    mean = sum(sum(c.values()) for c in docs.values()) / len(docs)
    out = {}
    for r in rows:
        c = docs.get((r.source, r.para_id))
        if c and keep(r):
            score = 0.0
            for w in set(words_of(query)) & c.keys():
                df = sum(w in d for d in docs.values())
                score += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
            if set(words_of(query)) & c.keys():
                out[r.source, r.para_id] = round(score, 9)
    return out


@pytest.fixture(scope="module")
def index(paras, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('words')}/index"
    retrieval.write_index(paras, path)
    return path


QUERIES = [(1, "Grain SIZE, grain"), (2, "the strain rate"), (3, "nothing known"), (4, ""), (5, "é 5 fcc")]


@pytest.mark.parametrize("few", [100_000, -1])
def test_bm25(spark, paras, index, few, monkeypatch):
    monkeypatch.setattr(retrieval, "FEW", few)
    rows, queries = paras.collect(), spark.createDataFrame(QUERIES, "query_id int, text string")
    got = {}
    for r in retrieval.bm25(spark, index, queries, 1000).collect():
        got.setdefault(r.query_id, {})[r.source, r.para_id] = r.score
    assert {q: s for q, t in QUERIES if (s := brute_bm25(rows, t))}.keys() == got.keys() == {1, 2, 5}
    for q, t in QUERIES:
        want = brute_bm25(rows, t)
        assert got.get(q, {}).keys() == want.keys() and all(abs(got[q][k] - want[k]) < 1e-6 for k in want)
    top = retrieval.bm25(spark, index, queries, 2, per=None).where("query_id = 2").orderBy("rank").collect()
    assert [(r.source, r.para_id) for r in top] == sorted(brute_bm25(rows, QUERIES[1][1]), key=lambda k: (-brute_bm25(rows, QUERIES[1][1])[k], k))[:2]


def test_sections_and_fusion(spark, paras, index):
    rows, queries = paras.collect(), spark.createDataFrame(QUERIES, "query_id int, text string")
    has = {r.source for r in rows if r.sub_titles and "result" in r.sub_titles.lower()}
    inside = lambda r: r.source not in has or bool(r.sub_titles and "result" in r.sub_titles.lower())
    got = retrieval.retrieve(spark, index, paras, queries, k=2).where("query_id = 1").collect()
    want = brute_bm25(rows, QUERIES[0][1], inside)
    for source in {k[0] for k in want}:
        best = sorted((k for k in want if k[0] == source), key=lambda k: (-want[k], k))[:2]
        assert [(r.source, r.para_id) for r in sorted(got, key=lambda r: r.rank) if r.source == source] == best
    vectors = paras.select("source", "para_id", F.array(F.col("para_id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    asked = spark.createDataFrame([(1, "grain size", [1.0, 0.0])], "query_id int, text string, embedding array<double>")
    fused = {(r.source, r.para_id): r.score for r in retrieval.retrieve(spark, index, paras, asked, vectors, k=40).collect()}
    words = brute_bm25(rows, "grain size", inside)
    for source in {"p0", "p3"}:
        by_word = sorted((k for k in words if k[0] == source), key=lambda k: (-words[k], k))
        by_place = sorted(((r.source, r.para_id) for r in rows if r.source == source and inside(r)), key=lambda k: -k[1])
        for k in by_place:
            want_score = 1 / (61 + by_place.index(k)) + (1 / (61 + by_word.index(k)) if k in by_word else 0)
            assert abs(fused[k] - want_score) < 1e-8


def test_phrases(spark, paras, index):
    asked = [(1, "strain rate"), (2, "the the the"), (3, "Grain size, the"), (4, "not there")]
    got = {(r.query_id, r.source, r.para_id): r.n for r in retrieval.phrases(spark, index, spark.createDataFrame(asked, "query_id int, text string")).collect()}
    want = {}
    for q, t in asked:
        p = words_of(t)
        for r in paras.collect():
            w = words_of(r.page_content)
            if n := sum(w[i : i + len(p)] == p for i in range(len(w) - len(p) + 1)):
                want[q, r.source, r.para_id] = n
    assert got == want and want


# Tokens


def tokenizer_files():
    public = pytest.importorskip("public_tokenizers")
    return [public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")]


ODD = ["", " ", "  ", "a ", "  lead", "a  b\n\n c <|endoftext|> x", "é ñ 😀 don't 'll 12345", "a  \n b\t c  d 　e", "x y", "\n\n\n", "a" * 3000]


@pytest.mark.parametrize("which", [0, 1])
def test_counts_are_the_librarys(spark, which):
    path = tokenizer_files()[which]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([*((-1 - i, t) for i, t in enumerate(ODD)), (-99, None)], "doc_id long, text string"))
    got = {r.doc_id: r.n for r in docs.select("doc_id", tokens.token_count(F.col("text"), path).alias("n")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == len(tokens.tokenizer(path).encode(r.text or "", add_special_tokens=False).ids), r.text


def test_chunks_are_brute_force(spark):
    path = tokenizer_files()[0]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "One. " * 900)], "doc_id long, text string"))
    size = lambda s: len(tokens.tokenizer(path).encode(s, add_special_tokens=False).ids)
    got = {r.doc_id: list(r.c) for r in docs.select("doc_id", tokens.chunked(F.col("text"), path, 120, 60).alias("c")).collect()}
    cut = 0
    for r in docs.collect():
        assert got[r.doc_id] == plain.chunk(r.text or "", 120, 60, size)
        cut += len(got[r.doc_id]) > 1
    assert cut > 20


def test_windows_follow_the_ids(spark):
    path = tokenizer_files()[0]
    docs = spark.createDataFrame([(0, "Grüße an alle, 😀 die das lesen. " * 20), (1, ""), (2, None), (3, "short")], "id int, text string")
    got = {r.id: r.w for r in docs.select("id", tokens.windows_by_ids(F.col("text"), path, 50, 10).alias("w")).collect()}
    text = docs.first().text
    offsets = tokens.tokenizer(path).encode(text, add_special_tokens=False).offsets
    assert got[1] == [] and got[2] == [] and [w.text for w in got[3]] == ["short"]
    assert [(w.start, w.end) for w in got[0]] == [(offsets[a][0], offsets[min(a + 50, len(offsets)) - 1][1]) for a in range(0, len(offsets), 40) if a == 0 or a + 10 < len(offsets)]
    assert all(w.text == text[w.start : w.end] for w in got[0]) and got[0][-1].end == len(text)
    with pytest.raises(ValueError):
        tokens.spans("x", path, 5, 5)


# Embeddings


def test_neighbours_by_learned_embedding(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("text IS NOT NULL").select("doc_id", "text").dropDuplicates(["text"])
    embed = models.learned_embedder(docs, "text", 128)
    rows = docs.select("doc_id", "text", embed("text").alias("v")).collect()
    copy = {r.doc_id: np.array(r.v) for r in docs.select("doc_id", embed(F.regexp_replace("text", r"(\S+ )(\S+)$", "$2")).alias("v")).collect()}
    ids, matrix = [r.doc_id for r in rows], np.array([r.v for r in rows])
    long = [i for i, r in enumerate(rows) if len(words_of(r.text)) >= 40]
    best = sum(ids[int(np.argmax(matrix @ copy[ids[i]]))] == ids[i] or matrix[i] @ copy[ids[i]] > 0.999 for i in long)
    assert len(long) > 100 and best >= 0.95 * len(long)  # a text is nearest to itself with a word left out
    assert np.allclose(np.linalg.norm(matrix[long], axis=1), 1, atol=1e-5)
    none = spark.createDataFrame([("",), (None,), ("!!",)], "t string").select(embed("t").alias("v")).collect()
    assert all(not any(r.v) for r in none)


def test_rare_words_weigh_more(spark):
    docs = spark.createDataFrame([("common " + w,) for w in ("alpha", "beta", "gamma", "delta")] * 5 + [("common",)] * 30, "page_content string")
    embed = models.learned_embedder(docs)
    a, b, c = (np.array(r.v) for r in spark.createDataFrame([(0, "common alpha"), (1, "alpha"), (2, "common")], "i int, t string").orderBy("i").select(embed("t").alias("v")).collect())
    assert a @ b > a @ c


# Grouping in rounds


def test_rounds_are_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"k{i % 3}" if i % 7 else None, i, f"{rng.choice('abcdef')}{i}") for i in range(400)] + [("one", 1000, "z")]
    df = spark.createDataFrame(rows, "k string, pos long, item string")

    def by_letter(texts):
        found = {}
        for i, x in enumerate(texts):
            found.setdefault(x[0], []).append(i)
        return list(found.values())

    for depth in (1, 2, 3, 9):
        got = sorted(((r.k or "", r.head, tuple(r.members)) for r in records.group_rounds(df, "k", "pos", "item", by_letter, size=10, depth=depth).collect()))
        want = []
        for key in {r[0] for r in rows}:
            now = [(p, (p,), t) for k, p, t in rows if k == key]
            for k in range(depth):
                order = {r.head: r.h for r in spark.createDataFrame([(h,) for h, *_ in now], "head long").select("head", F.xxhash64("head", F.lit(7 + k)).alias("h")).collect()}
                dealt = sorted(now, key=lambda x: (order[x[0]], x[0]))
                cut = [sorted(dealt[a : a + 10]) for a in range(0, len(dealt), 10)]
                now = [(own[ids[0]][0], tuple(sorted(m for i in ids for m in own[i][1])), own[ids[0]][2]) for own in cut for ids in by_letter([x[2] for x in own])]
                if len(cut) == 1:
                    break
            want += [(key or "", h, m) for h, m, _ in now]
        assert got == sorted(want)
        assert sorted(m for *_, ms in got for m in ms) == sorted(p for _, p, _ in rows)


# Prompts


def model(prompt, text):
    if "fail" in prompt:
        raise RuntimeError("no")
    k = int(re.search(r"\d+", prompt)[0])
    return [w for w in text.split() if len(w) > k]


@pytest.fixture(scope="module")
def dev(spark):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 8))]
        rows.append((i, " ".join(words), list(dict.fromkeys(w for w in words if len(w) > 4))))
    return spark.createDataFrame(rows, "id long, input string, expected array<string>")


def brute_f1(rows, prompt):
    tp = fp = fn = 0
    for r in rows:
        got, want = set(model(prompt, r.input)), set(r.expected)
        tp, fp, fn = tp + len(got & want), fp + len(got - want), fn + len(want - got)
    return 2 * tp / (2 * tp + fp + fn)


def test_scores_of_all_prompts_at_once(dev):
    prompts = [f"longer than {k}" for k in range(1, 8)] + ["fail 3"]
    got = optimiser.scored(prompts, dev, model)
    assert got[:-1] == pytest.approx([brute_f1(dev.collect(), p) for p in prompts[:-1]]) and got[-1] == 0
    tried = optimiser.attempts(["fail 3"], dev.limit(3), model).collect()
    assert all(r.error == "RuntimeError: no" and r.got == [] and r.tp == 0 and r.fn == len(r.expected) for r in tried)
    assert optimiser.halved(prompts, dev, model, keep=2)[0] == ("longer than 4", 1.0)


def test_optimising(dev):
    rows = dev.collect()
    seen = []

    def propose(prompt, failed, passed, tried):
        seen.append((prompt, len(failed), len(passed), tried))
        k = int(re.search(r"\d+", prompt)[0])
        assert all(r.f1 < 1 for r in failed) and all(r.f1 == 1 for r in passed) and tried == sorted(tried, key=lambda x: -x[1])
        return [f"Longer than {k + 1}", f"longer  THAN {k}"]

    got = optimiser.optimise(["longer than 1", "LONGER than 1"], dev.where("id % 2 = 0"), dev.where("id % 2 = 1"), model, propose, iterations=6, examples=2)
    assert [s[0][-1] for s in seen] == ["1", "2", "3"] and 0 < seen[0][1] <= optimiser.FAILED and seen[0][2] <= optimiser.PASSED
    assert got[0].validation == 1.0 and got[0].train == 1.0 and {a.prompt[:13].lower() for a in got} == {"longer than 4", "longer than 3", "longer than 2"}
    shown = next(a.prompt for a in got if a.iteration == -1 and a.prompt.startswith("Longer than 4"))
    for part in shown.split("\n\n")[1:]:
        text, answer = re.fullmatch(r"Input: (.*)\nOutput: (.*)", part).groups()
        assert json.loads(answer) == next(r.expected for r in rows if r.input == text and r.id % 2 == 0)
    assert shown.count("Input: ") == 2
    short = optimiser.optimise(["longer than 1"], dev, dev, model, propose, iterations=2, keep=1, examples=0)
    assert [a.prompt for a in short] == ["Longer than 2"] and short[0].validation == pytest.approx(brute_f1(rows, "Longer than 2"))
