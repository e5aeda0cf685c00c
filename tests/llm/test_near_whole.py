"""Near-duplicate links against brute force over whole tables, hash-hostile words, repeated and missing ids."""

import random
import re
from itertools import combinations

import pytest
from folioflow.llm import near_dedup as N

DATA = "/root/testdata"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(texts):
    """{id: (n_shingles, component, kept)} and the number of linked pairs of different sets."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_set, links = {}, 0
    for i in sorted(sets):
        by_set.setdefault(sets[i], i)
        if sets[i]:
            root[i] = by_set[sets[i]] if by_set[sets[i]] != i else i
    heads = [(s, i) for s, i in by_set.items() if s]
    for (a, i), (b, j) in combinations(heads, 2):
        if 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)):
            both = len(a & b)
            if 100 * both >= 85 * (len(a) + len(b) - both):
                links += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}, links


def result(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df, **options).collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    """Recall and precision are 1: every component is the one of all links found by comparing all pairs."""
    docs = spark.read.parquet(f"{DATA}/{sf}/documents.parquet").select("doc_id", "text")
    want, _ = brute({r.doc_id: r.text for r in docs.collect()})
    assert sum(not w[2] for w in want.values()) >= 10 and result(docs) == want


def test_recall_at_the_threshold(spark):
    """Pairs just above a similarity of 0.85, each alone: all of 400 are found, and none just below."""
    rng, texts, want = random.Random(8), {}, {}
    for k in range(400):
        words = [f"p{k}w{i}" for i in range(204)]  # 200 shingles; e edits far apart change 5 of them each
        other = list(words)
        edits = 3 if k % 2 else 4
        for at in rng.sample(range(0, 195, 15), edits):
            other[at + 5] = f"e{at}"
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join(other)
        a, b = shingles(texts[2 * k]), shingles(texts[2 * k + 1])
        want[k] = 100 * len(a & b) >= 85 * len(a | b)
    got = result(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {k: got[2 * k + 1][1] == 2 * k for k in range(400)} == want and 150 < sum(want.values()) < 250


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_rounds_do_not_matter(spark, rounds):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    texts, base = {}, [rng.choice(words) for _ in range(90)]
    for k in range(70):
        own = list(base) if k % 9 else [rng.choice(words) for _ in range(90)]
        for _ in range(rng.randrange(4)):
            own[rng.randrange(90)] = f"e{rng.randrange(10**6)}"
        if k % 9 == 0:
            base = own
        texts[k] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert result(df, rounds=rounds) == brute(texts)[0]
    assert result(df.where("doc_id = 3"), rounds=rounds)[3][1:] == (3, True)


def thue_morse(n, a, b):
    s = a
    while len(s) < n:
        s += s.translate(str.maketrans({a: b, b: a}))
    return s[:n]


def test_words_that_polynomial_hashes_confuse(spark):
    one, two = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    texts = {1: " ".join(f"{one}{k}" for k in range(8)), 2: " ".join(f"{two}{k}" for k in range(8)), 3: one, 4: two}
    assert result(spark.createDataFrame(list(texts.items()), "doc_id long, text string")) == {1: (4, 1, True), 2: (4, 2, True), 3: (1, 3, True), 4: (1, 4, True)}


def test_ids_nulls_and_odd_white_space(spark):
    long = " ".join(f"x{k}" for k in range(60))
    rows = [(5, long), (None, long), (7, long.upper()), (9, " \t" + long.replace(" ", "\r\n\x0b\x0c") + " "), (9, "alone here"), (11, "ALONE\nhere"), (12, "alone here"), (None, ""), (13, None), (14, "É é"), (15, "é é"), (16, "\x1falone here")]
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [(g[0][1], *g[1:]) for g in got if not g[0][0]] == [(5, 56, 5, True), (7, 56, 5, False), (9, 1, 5, False), (9, 56, 5, False), (11, 1, 5, False), (12, 1, 12, True), (13, 0, 13, True), (14, 1, 14, True), (15, 1, 15, True), (16, 1, 16, True)]
    assert sorted(g[1:] for g in got if g[0][0]) == [(0, None, True), (56, None, True)]
