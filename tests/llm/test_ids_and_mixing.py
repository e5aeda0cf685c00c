"""Rows without an id or with the id of others, learned topics, targets, SQL of the base operators on such rows."""

import random

import numpy as np
import pytest
from folioflow.llm import decontaminate, exact_dedup, language, mixing, secrets
from pyspark.sql import functions as F


def words(rng, n, k=40):
    return " ".join(f"w{rng.randrange(k)}" for _ in range(n))


def test_contamination_by_row(spark):
    item = " ".join(f"b{k}" for k in range(30))
    short = "only five words are here"
    bench = spark.createDataFrame([(1, item), (2, short), (3, ""), (4, None), (2, short)], "item_id long, text string")
    docs = spark.createDataFrame([(7, item), (7, "clean text"), (None, "x " + item), (None, "also clean"), (8, short + " more"), (9, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {(7, 30): (30, 1, True), (7, 2): (0, 0, False), (None, 31): (30, 1, True), (None, 2): (0, 0, False), (8, 6): (5, 1, True), (9, 0): (0, 0, False)}
    assert sorted(str(r.text) for r in decontaminate.decontaminate(docs, bench).collect()) == ["None", "also clean", "clean text"]
    assert decontaminate.contamination(docs, bench, broadcast_bytes=0).where("contaminated").count() == 3


def test_exact_groups_without_ids(spark):
    docs = spark.createDataFrame([(5, "a b"), (None, "ab"), (None, "a  b "), (6, "c"), (None, "c"), (None, None), (7, " ")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()))
    assert got == [(0, 0, 3, True), (0, 0, 3, True), (0, 6, 2, False), (0, 7, 2, False), (5, 0, 3, False), (6, 6, 2, True), (7, 7, 2, True)]
    assert exact_dedup.exact_dedup(docs).count() == 4


def test_topics_are_learned_and_do_not_depend_on_partitions(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(f"{'abcd'[k % 4]}{rng.randrange(60)}" for _ in range(50)), "en", "s") for k in range(200)] + [(200, None, "en", "s"), (None, "a1 a2", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    a, b = ({(r.doc_id, r.n_tokens): r.topic for r in mixing.mixture(docs.repartition(n)).collect()} for n in (1, 7))
    assert a == b and a[200, 0] == -1
    by_letter = [{a[k, 50] for k in range(200) if k % 4 == letter} for letter in range(4)]
    assert not any(x & y for i, x in enumerate(by_letter) for y in by_letter[:i])  # no topic mixes two vocabularies


def test_targets(spark):
    rows = [(k, "x y z", "en" if k % 3 else "de", f"s{k % 2}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    topic = mixing.mixture(docs).first().topic
    goal = {"source": {"s0": 0.2, "s1": 0.8}, "lang": {"en": 0.5, "de": 0.5}, "topic": {topic: 1.0}}
    got = mixing.mixture(docs, fraction=0.3, targets=goal)
    tokens = {c: {r[0]: r[1] for r in got.groupBy(c).agg(F.sum(F.col("probability") * F.col("n_tokens"))).collect()} for c in ("source", "lang")}
    assert all(abs(tokens[c][v] / 540 - share) < 1e-6 for c in tokens for v, share in goal[c].items()) and got.first().converged
    kept = mixing.sample(docs, fraction=0.3, targets=goal)
    assert kept.columns == docs.columns and abs(kept.count() * 3 / 540 - 1) < 0.2
    for wrong in ({"s0": 0.5}, {"s0": -0.5, "s1": 1.5}, {"s0": 0.5, "other": 0.5}):
        with pytest.raises(ValueError):
            mixing.mixture(docs, targets=goal | {"source": wrong})
    apart = docs.where("lang = 'en' OR source = 's0'")  # de only in s0: half of the tokens cannot be de with 0.2 for s0
    with pytest.warns(RuntimeWarning):
        assert not mixing.mixture(apart, targets=goal).first().converged


def test_raking_is_brute_force():
    """Against plain loops over cells, to the last sweep."""
    import pandas as pd

    rng = np.random.default_rng(2)
    cells = pd.DataFrame([(s, g, t, int(rng.integers(1, 500))) for s in "ab" for g in "xyz" for t in (0, 1)], columns=["source", "lang", "topic", "tokens"])
    goal = {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.2, "y": 0.2, "z": 0.6}, "topic": {0: 0.5, 1: 0.5}}
    mass = {i: r.tokens / cells.tokens.sum() for i, r in enumerate(cells.itertuples())}
    for _ in range(mixing.SWEEPS):
        for d in mixing.DIMS:
            have = {}
            for i, r in enumerate(cells.itertuples()):
                have[getattr(r, d)] = have.get(getattr(r, d), 0) + mass[i]
            mass = {i: mass[i] * goal[d][getattr(r, d)] / have[getattr(r, d)] for i, r in enumerate(cells.itertuples())}
    assert np.allclose(mixing.rake(cells, goal), [mass[i] for i in range(len(cells))], rtol=1e-8)


def test_bounded_raking_is_the_nearest_mixture():
    """Marginals meet their targets, full cells stay at their tokens, and all others are the tokens times a factor for each of
    their values: the conditions under which no other mixture within the bounds is nearer to the tokens."""
    import pandas as pd

    rng = np.random.default_rng(5)
    cells = pd.DataFrame([(s, g, t, int(rng.integers(1, 400))) for s in "abcd" for g in "xyz" for t in (0, 1, 2)], columns=[*mixing.DIMS, "tokens"])
    wanted = np.minimum(cells.tokens, rng.integers(1, 1200, len(cells)) * np.where(cells.source == 'a', 1.0, 0.1)).astype(float)  # a mixture that can be had
    budget = wanted.sum()
    goal = {d: (wanted.groupby(cells[d]).sum() / budget).to_dict() for d in mixing.DIMS}
    mass = mixing.rake(cells, goal, budget=budget)
    for d in mixing.DIMS:
        assert all(abs(mass[(cells[d] == v).to_numpy()].sum() - share) < 1e-6 for v, share in goal[d].items())
    ratio = mass * budget / cells.tokens
    assert ratio.max() <= 1 + 1e-9 and (ratio > 1 - 1e-6).any() and (ratio < 0.999).any()
    factors = pd.get_dummies(cells[list(mixing.DIMS)].astype(str)).to_numpy(float)
    free = (ratio < 1 - 1e-6).to_numpy()
    fitted = factors @ np.linalg.lstsq(factors[free], np.log(ratio[free]), rcond=None)[0]
    assert np.allclose(fitted[free], np.log(ratio[free]), atol=1e-4) and (fitted[~free] > -1e-3).all()


def test_targets_beyond_what_there_is(spark):
    """A value that is asked for more than it has gives all, the others take the rest up, and the result says which missed."""
    rows = [(k, "x y z", "en" if k % 10 else "de", f"s{k % 2}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    topic = mixing.mixture(docs).first().topic
    goal = {"source": {"s0": 0.5, "s1": 0.5}, "lang": {"en": 0.2, "de": 0.8}, "topic": {topic: 1.0}}
    for cells in (100_000, 0):
        with pytest.warns(RuntimeWarning, match="lang de 0.2000 of 0.8000"):
            got = mixing.mixture(docs, targets=goal, driver_cells=cells)
        assert not got.first().converged
        assert {r[0]: round(r[1], 6) for r in got.groupBy("lang").agg(F.avg("probability")).collect()} == {"de": 1.0, "en": round(720 / 1620, 6)}


def test_default_mixture_meets_its_targets(spark):
    got = mixing.mixture(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).persist()
    total = got.agg(F.sum("n_tokens"), F.sum(F.col("probability") * F.col("n_tokens"))).first()
    topics = {r[0]: r[1] / total[0] for r in got.where("n_tokens > 0").groupBy("topic").agg(F.sum("n_tokens")).collect()}
    assert len(topics) == mixing.TOPICS and min(topics.values()) > 0.005 and max(topics.values()) < 0.5
    assert got.where("NOT converged").isEmpty() and abs(total[1] - 0.5 * total[0]) < 1
    has = {(d, r[0]): (r[1], r[2]) for d in mixing.DIMS for r in got.groupBy(d).agg(F.sum("n_tokens"), F.sum(F.col("probability") * F.col("n_tokens"))).collect()}
    # Shares of a dimension are powers of the present ones unless there is no room: more of a value never lowers its share.
    for d in mixing.DIMS:
        own = sorted(v for k, v in has.items() if k[0] == d)
        assert all(a[1] <= b[1] * (1 + 1e-3) for a, b in zip(own, own[1:], strict=False))
    got.unpersist()


def test_language_is_held_out_accurate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert n > 100 and right >= 0.97


def test_secrets_link_over_the_whole_scope(spark):
    far = "." * 2000
    docs = spark.createDataFrame([(1, f"ASIA1234567890ABCDEF {far} password=hunter2222"), (2, f"ASIA1234567890ABCDEF\n\n{far} password=hunter2222"), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r.spans.count("weak_access") for r in secrets.find_secrets(docs).collect()}
    assert got == {1: 1, 2: 0, None: 0}


def test_equal_items_and_an_empty_benchmark(spark):
    item = " ".join(f"b{k}" for k in range(20))
    bench = spark.createDataFrame([(k, item) for k in range(50)] + [(99, "b1 b2 b3")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{item} {item} {item}"), (2, "x b1 b2 b3 y"), (3, None)], "doc_id long, text string")
    for broadcast in (64 << 20, 0):
        got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench, broadcast_bytes=broadcast).collect()}
        assert got == {1: (60, 51, True), 2: (3, 1, True), 3: (0, 0, False)}
        none = decontaminate.contamination(docs, bench.limit(0), broadcast_bytes=broadcast).collect()
        assert sorted((r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in none) == [(1, 0, 0, False), (2, 0, 0, False), (3, 0, 0, False)]


def test_secrets_of_rows_without_ids_and_long_texts(spark):
    far = "filler words " * 200_000
    docs = spark.createDataFrame([(None, "token = abcdef123"), (None, "token = abcdef123"), (1, f"{far} password: hunter2222 {far}"), (2, "")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_assign) for r in secrets.find_secrets(docs).collect())
    assert got == [(0, 1), (0, 1), (1, 1), (2, 0)]


def test_languages_by_text_alone(spark):
    rows = [(k, f"kato miro suna {k}", "aa") for k in range(40)] + [(100 + k, f"blurg vroth zekk {k}", "bb") for k in range(40)]
    rows += [(None, "kato miro", "bb"), (7, "blurg zekk vroth", None), (7, "kato miro suna 7", "aa"), (8, "blurg vroth " * 100_000, None), (9, "12 34", None), (10, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("doc_id", "text", "lang", "'x' AS lang_pred", "1 AS score")
    got = [(r.doc_id, r.held_out, r.lang_pred) for r in language.identify(docs).collect()]
    assert len(got) == len(rows) and (None, False, "aa") in got and {p for i, _, p in got if i == 7} == {"aa", "bb"}
    assert {p for i, _, p in got if i == 8} == {"aa", "bb"} and {p for i, _, p in got if i in (9, 10)} >= {"und"}
    assert language.identify(docs.limit(0)).count() == 0
    model = language.train(docs.unionByName(docs.select(F.lit(500).cast("long").alias("doc_id"), F.repeat(F.lit("blurg "), 4000).alias("text"), F.lit("aa").alias("lang"), "lang_pred", "score").limit(1)), sample_bytes=4000)
    assert model.langs == ["aa", "bb"]
