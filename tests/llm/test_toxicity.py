"""Toxicity: scores against brute force, quotation, held-out accuracy, repeated and missing ids."""

import math

import numpy as np
import pytest
from folioflow.llm import toxicity

DATA = "/root/testdata"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def terms_of(lexicon):
    out = []

    def go(node, path):
        if lexicon.stem[node]:
            out.append((path, True, lexicon.fuzzy[node]))
        if lexicon.word[node]:
            out.append((path, False, lexicon.fuzzy[node]))
        for c, kid in lexicon.kids[node].items():
            go(kid, path + c)

    go(0, "")
    return out


def brute_match(word, terms):
    best = 0
    for term, stem, fuzzy in terms:
        forms = [word[:k] for k in range(len(word) + 1)] if stem else [word]
        least = min(distance(f, term) for f in forms)
        if least == 0:
            return 1
        if least == 1 and fuzzy:
            best = 2
    return best


def test_scores_are_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    lexicon, weights = toxicity.train(docs, labels)
    terms = terms_of(lexicon)
    assert terms
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    for r in docs.collect():
        words = (r.text or "").lower().split()
        kinds = [brute_match(w.strip(toxicity._EDGE), terms) for w in words]
        inside = toxicity.quoted(words)
        weak = [w.strip(toxicity._EDGE) for i, w in enumerate(words) if not kinds[i] and not inside[i] and any(w.strip(toxicity._EDGE).startswith(t) for t in lexicon.weak)]
        spots = [i for i, k in enumerate(kinds) if k and not inside[i]]
        exact, fuzzy = sum(kinds[i] == 1 for i in spots), sum(kinds[i] == 2 for i in spots)
        aside = sum(1 for i, k in enumerate(kinds) if k and inside[i])
        densest = max((sum(i <= j < i + toxicity.SPAN for j in spots) for i in spots), default=0)
        weight = exact + 0.7 * fuzzy
        x = [1.0, float(weight > 0), math.log1p(weight), math.log1p(aside), math.log1p(densest), min(1.0, 10 * len(spots) / len(words)) if words else 0.0]
        x += [math.log1p(len(weak)), math.log1p(max(0, len(set(weak)) - 1))]
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-float(np.dot(x, weights))))) < 1e-9, r.doc_id


@pytest.mark.parametrize(("text", "want"), [
    ('he said "you scoundrel go" again', "2-4"), ('a 5" pipe you scoundrel', ""), ('12" and 5" wide', ""), ("she's 'a scoundrel' now", "1-2"), ("„du schuft“ ja", "0-1"),
    ("« le coquin » dit", "0-3"), ('"never closed scoundrel and on', ""), ('"one" two "three four."', "0-0 2-3"), ('"stray and "then this" end', "2-3"), ("‘a b’ c", "0-1"), ("don't can't", ""),
])
def test_quotation(text, want):
    words = text.split()
    inside = {k for part in want.split() for k in range(int(part.split("-")[0]), int(part.split("-")[1]) + 1)}
    assert {k for k, q in enumerate(toxicity.quoted(words)) if q} == inside


@pytest.mark.parametrize(("sf", "recall", "precision"), [("sf0.01", 0.85, 0.95), ("sf0.1", 0.9, 0.95)])
def test_held_out(spark, sf, recall, precision):
    docs, labels = (spark.read.parquet(f"{DATA}/{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out")
    n = {(r[0], r[1]): r[2] for r in got.groupBy("toxic", "predicted").count().collect()}
    hit, missed, wrong = n.get((1, 1), 0), n.get((1, 0), 0), n.get((0, 1), 0)
    assert hit >= recall * (hit + missed) and hit >= precision * (hit + wrong), n


def test_rows_stand_alone(spark):
    bad = [f"w{k} you scoundrel x{k}" for k in range(12)]
    fine = [f"a{k} quiet b{k} day" for k in range(40)]
    rows = [(k, t) for k, t in enumerate(bad + fine)] + [(0, "a fine text"), (None, "oh scoundrel"), (None, None), (60, ""), (60, "scoundrell " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' AS score", "1 AS predicted", "2 AS toxic")
    labels = spark.createDataFrame([(k, int(k < 12), 1) for k in range(52)], "doc_id long, toxic int, quality int")
    got = toxicity.toxicity(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(rows)
    assert got.where("doc_id IS NULL AND NOT held_out").count() == 2
    kept = [(r.doc_id, r.text) for r in toxicity.drop_toxic(docs, labels).collect()]
    assert (0, "a fine text") in kept and (None, None) in kept and (60, "") in kept and (None, "oh scoundrel") not in kept and not any("scoundrel" in (t or "") for _, t in kept)


def test_long_texts_are_read_in_runs(monkeypatch):
    """Features do not depend on where a text is cut into runs of words."""
    import random

    rng = random.Random(3)
    lexicon = toxicity.Lexicon(["scoun"], ["idiot"], frozenset(), frozenset(["grumb"]))
    parts = ["idiot", "idiott", '"idiot"', "scoundrel,", '"so', 'it"', "plain", "grumbaa", "(grumbbb)", "don't", "«", "»", '5"', "\n\n", "'a", "b'"]
    for _ in range(200):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))
        monkeypatch.setattr(toxicity, "_RUN", 1 << 20)
        want, first = toxicity.Scorer(lexicon).features(text), toxicity._first_places(text)
        words = text.lower().split()
        inside = toxicity.quoted(words)
        kinds = [lexicon.match(w.strip(toxicity._EDGE)) for w in words]
        assert want[3] == math.log1p(sum(1 for k, q in zip(kinds, inside, strict=True) if k and q))
        assert want[2] == math.log1p(sum({0: 0, 1: 1, 2: 0.7}[k] for k, q in zip(kinds, inside, strict=True) if not q)) or abs(want[2] - math.log1p(sum({0: 0, 1: 1, 2: 0.7}[k] for k, q in zip(kinds, inside, strict=True) if not q))) < 1e-9
        for size in (1, 7, 40):
            monkeypatch.setattr(toxicity, "_RUN", size)
            assert toxicity.Scorer(lexicon).features(text) == want and toxicity._first_places(text) == first


def test_weak_terms_speak_together(spark):
    """A stem that clean texts have once is no term; two words that begin with it are."""
    ends = [chr(97 + i) + chr(97 + j) for i in range(12) for j in range(12)]
    bad = [f"p{k} grumb{ends[k]} q{k} grumb{ends[k + 40]} r{k} grumb{ends[k + 80]} s{k}" for k in range(30)]
    fine = [f"p{k} grumb{ends[k]} q{k}" if k % 4 == 0 else f"p{k} quiet q{k}" for k in range(120)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(bad + fine)] + [(900, "grumbzz and grumbyy grumbxx"), (901, "one grumbzz"), (902, '"grumbzz and grumbyy grumbxx" they said'), (903, "grumbzz " * 5)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 30)) for k in range(150)], "doc_id long, toxic int")
    lexicon, _ = toxicity.train(docs, labels)
    assert lexicon.weak and all(t.startswith("grum") for t in lexicon.weak)
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).where("doc_id >= 900").collect()}
    assert got[900] > 0.7 > 0.5 > got[901] and got[902] < 0.5 and got[903] < got[900]


def test_copies_make_no_term():
    names = ["x" * 5 + chr(97 + k) for k in range(20)]
    rows = [(1, f"{n} idiot {n}{k} rare copyword here") for k, n in enumerate(names)] + [(0, f"calm {n}") for n in names]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows]), pa.array([t for _, t in rows])], ["toxic", "text"])
    got = {t: (a, b, bin(p & (2**64 - 1)).count("1")) for out in toxicity._tally([batch]) for t, a, b, p in zip(*(c.to_pylist() for c in out.columns), strict=True)}
    assert got["idiot$"][:2] == (20, 0) and got["idiot$"][2] > 10 and got["copyword$"] == (20, 0, 1)
