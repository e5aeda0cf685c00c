"""URL filter and vector codes against brute force, and on rows that are missing, repeated, long or odd."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from folioflow.llm import url_filter as urls
from folioflow.llm import vector_codes as codes


def brute_url(url, rules=urls.RULES, vocabulary=urls.VOCABULARY):
    url = url or ""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url)
    rest = url.partition("://")[2] if "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    hits = {t: n for t in vocabulary if (n := len(re.findall(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low)))}
    fits = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    best = max(fits, key=lambda x: x[0], default=None)
    verdict = best[2] if best else "block" if sum(vocabulary[t] for t in hits) >= 1 else "allow"
    return host, path, best[1] if best else None, verdict, sum(n for t, n in hits.items() if vocabulary[t] >= 1), sum(n for t, n in hits.items() if vocabulary[t] < 1), ",".join(sorted(hits))


CASES = [
    None, "", "no scheme/free/win", "http://", "://net/", "HTTP://A.NET", "http://a.net/", "http://net/x?y=casino", "http://anet/", "http://EXAMPLE.net/en/", "http://x.example.net/en", "http://x.example.net/en/a",
    "http://example.com/de/x", "http://b.example.com/DE/x", "http://q.org/fr/#free-win", "http://q.org/fr?x", "http://u:p@h.org:80/fr/", "http://a.io/free", "http://a.io/freewin", "http://a.io/free/win", "http://a.io/FREE_free-free",
    "http://a.io/xcasino", "http://a.io/é-casino-é", "http://a.io/casino", "http://a.io/%20porn%20", "a://b://net/fr/", "http://a.io/x\n/porn", "http://porn", "casino", "http://a.io/xxx-xxx", "http://ü.net/", "http://a.io?/x", "http://a.io#://b.net/",
]


def test_urls_are_brute_force(spark):
    rng = random.Random(5)
    parts = [*urls.STRICT[:3], *urls.SOFT[:8], "-", "_", "/", ".", "x", "7", "é", "Win", "FREE"]
    more = ["http://" + "".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    # A term on every side of a cut, in urls longer than one piece.
    more += ["http://a.io/" + "q" * k + "/free/" + "z" * 600 + "?win" + "q" * k for k in range(236, 262)] + ["http://a.io/" + "abc/" * 50_000 + "casino"]
    rows = [(i, u, "mine", 1) for i, u in enumerate([*CASES, *more])] + [(None, "http://a.io/porn", None, None), (3, CASES[3], "x", 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string, n_soft int")
    got = urls.url_verdicts(df.repartition(3))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "terms"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, *brute_url(u)) for i, u, *_ in rows), key=repr)
    kept = urls.keep_allowed(df)
    assert kept.columns == df.columns and kept.count() == sum(brute_url(u)[3] == "allow" for _, u, *_ in rows)
    assert urls.url_verdicts(df.limit(0)).count() == 0


def test_own_rules_and_words(spark):
    df = spark.createDataFrame([(1, "http://a.b.c/x/y"), (2, "http://b.c/x"), (3, "http://d/he-she"), (4, "http://d/hers he"), (5, "http://c/")], "page_id long, url string")
    rules, words = (("allow", "b.c/x/"), ("block", "c/"), ("block", "b.c/")), {"he": 0.4, "she": 0.4, "hers": 0.3, "he-she": 0.2}
    got = {r.page_id: (r.rule, r.verdict, r.terms) for r in urls.url_verdicts(df, rules=rules, vocabulary=words).collect()}
    assert got == {1: ("b.c/x/", "allow", ""), 2: ("b.c/", "block", ""), 3: (None, "block", "he,he-she,she"), 4: (None, "allow", "he,hers"), 5: ("c/", "block", "")}
    none = urls.url_verdicts(df, rules=(), vocabulary={})
    assert {r.verdict for r in none.collect()} == {"allow"}


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = []
    for i, x, label in rows:
        if x is not None and all(v is not None and np.isfinite(v) for v in x):
            kept.append((i, [int(np.floor(float(v) * scale)) for v in x], label))
    step = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    kept = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(i, [*v, *[0] * (step * parts - len(v))], label) for i, v, label in kept]
    order = kept[:entries]
    cut = lambda v, k: v[k * step : (k + 1) * step]
    books = [[cut(v, k) for _, v, _ in order] for k in range(parts)]
    near = lambda v, k: min(((sum((a - b) ** 2 for a, b in zip(cut(v, k), e, strict=True)), j) for j, e in enumerate(books[k])))
    for _ in range(rounds):
        for k in range(parts):
            own = [[] for _ in books[k]]
            for _, v, _ in kept:
                own[near(v, k)[1]].append(cut(v, k))
            books[k] = [[sum(c) // len(o) for c in zip(*o, strict=True)] if o else e for o, e in zip(own, books[k], strict=True)]
    digest = sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    done = [(i, "".join(f"{near(v, k)[1]:02x}" for k in range(parts)), sum(near(v, k)[0] for k in range(parts)), label) for i, v, label in kept]
    return sorted(((i, code, e, sum(x[2] for x in done if x[3] == label), digest) for i, code, e, label in done), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_codes_are_brute_force(spark, seed):
    rng = random.Random(seed)
    draw = lambda n: [rng.choice([0.0, -0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(n)]  # noqa: E731  many ties
    rows = [(i, draw(20 + seed), rng.choice(["a", "b", None])) for i in range(90)]
    rows += [(None, draw(5), "a"), (4, draw(8), None), (3, None, "a"), (2, [], "b"), (1, [1.0, None], "b"), (9, [float("nan")] * 8, "b"), (9, [float("-inf")] * 8, None), *rows[:5]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label string, code string, error int")
    rows = [(i, None if x is None else [None if v is None else float(np.float32(v)) for v in x], label) for i, x, label in rows]
    got = sorted((tuple(r) for r in codes.compress(df.repartition(4)).collect()), key=repr)
    assert got == brute_codes(rows)


def test_few_large_and_no_vectors(spark):
    few = spark.createDataFrame([(2, [1.0, 2.0**40, -3.0], 1), (1, [0.5, -(2.0**40), 9.0], 1), (3, [0.5, -(2.0**40), 9.0], 2)], "vec_id long, embedding array<double>, label int")
    want = brute_codes([(2, [1.0, 2.0**40, -3.0], 1), (1, [0.5, -(2.0**40), 9.0], 1), (3, [0.5, -(2.0**40), 9.0], 2)])
    assert sorted((tuple(r) for r in codes.compress(few).collect()), key=repr) == want
    assert codes.compress(few.limit(0)).count() == 0
    assert codes.compress(few.selectExpr("vec_id", "label", "CAST(NULL AS array<double>) AS embedding")).count() == 0
    with pytest.raises(ValueError):
        codes.compress(few, entries=300)


def test_labels_beyond_a_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i % 7), 1.0], i % 3 or None) for i in range(40)], "vec_id long, embedding array<float>, label int")
    want = sorted((tuple(r) for r in codes.compress(df).collect()), key=repr)
    monkeypatch.setattr(codes, "_LABELS", 0)
    assert sorted((tuple(r) for r in codes.compress(df).collect()), key=repr) == want


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(7)
    for n, d in ((1, 3), (2, 1), (16, 8), (16, 1), (200, 4)):
        entries, points = rng.integers(-3, 4, (n, d)), rng.integers(-4, 5, (500, d))
        index, best = codes.KdTree(entries).nearest(points)
        far = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (index == far.argmin(1)).all() and (best == far.min(1)).all()
        index, best = codes.KdTree(entries.astype(object)).nearest(points.astype(object))
        assert (index == far.argmin(1)).all() and (best == far.min(1)).all()


def test_more_entries_leave_less_error(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    errors = [codes.compress(rows, entries=n).agg({"error": "sum"}).first()[0] for n in (2, 16, 64)]
    assert errors[0] > errors[1] > errors[2] >= 0
