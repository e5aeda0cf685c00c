"""Wrappers do not depend on partitions or rows' order, and what is constant is what brute force says."""

import random

import pytest
from folioflow.llm import html_text as H
from folioflow.llm.common import Workspace


def hosts(seed, pages=40):
    rng = random.Random(seed)
    rows = []
    for k in range(pages):
        host = f"h{rng.randrange(3)}.example.org"
        parts = ["<h1>Title {}</h1>".format(rng.randrange(1000))]
        for _ in range(rng.randrange(1, 6)):
            parts.append(rng.choice(["<p>Para {0}</p>", "<ul><li>a{0}<li>b</ul>", "<blockquote>q{0}</blockquote>", "<h2>Part</h2>", "<div class='x'>same</div>", "<ol><li>1</ol>"]).format(rng.randrange(1000)))
        rows.append((k, f"https://{host}/{k}", f"<body><div class='top'>Site</div><div id=content>{''.join(parts)}</div><div class=end>All rights</div></body>"))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_any_partitions(spark, seed):
    rows = hosts(seed)
    got = []
    for n, order in ((1, rows), (32, rows[::-1]), (5, rows + rows[:7])):
        df = spark.createDataFrame(order, "page_id long, url string, html string").repartition(n)
        wrapped = H.wrappers(df.select(H.host_of(df["url"]).alias("host"), "html"), Workspace(spark, "t"), group=4)
        got.append((sorted(map(tuple, wrapped.collect())), sorted({tuple(r) for r in H.extract(df).collect()})))
    assert got[0][1] == got[1][1] == got[2][1]
    assert got[0][0] == got[1][0]


def test_constants_are_brute_force(spark):
    """Slots that every page of a host fills alike, found by comparing all pages place by place."""
    rows = [(k, f"https://a.example.org/{k}", f"<body><div>Brand</div><article><h1>T{k}</h1><p>Body {k}</p></article><p>Foot</p></body>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    wrapped = H.wrappers(df.select(H.host_of(df["url"]).alias("host"), "html"), Workspace(spark, "t"), group=2).first().wrapper

    def slots(node, path, out):
        for kid in node.kids:
            at = H._at(path, f"{kid.tag}.{kid.names}" if kid.names else kid.tag)
            if kid.tag == "#":
                out.add((at, H._slot(kid.text)))
            else:
                slots(kid, at, out)
        return out

    every = [slots(H.parse(html), "/#root", set()) for _, _, html in rows]
    assert H.fixed_slots(H.load(wrapped)) == set.intersection(*every) != set()
    assert H.expression(H.load(wrapped)) == "<#root><body><div>Brand</><article><h1>#text</><p>#text</></><p>Foot</></></>"


def test_matching_is_a_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(9))] for _ in range(2))
        pairs = list(H._matched(a, b))
        assert [x for x, _ in pairs if x is not None] == list(range(len(a))) and [y for _, y in pairs if y is not None] == list(range(len(b)))
        both = [(x, y) for x, y in pairs if x is not None and y is not None]
        assert all(a[x] == b[y] for x, y in both)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(both) == best[-1][-1]


def test_joined_templates_and_clashing_columns(spark):
    rows = [(k, f"https://a.example.org/{k}" if k else None, f"<div class=post><p>Body {k}</p><p class=s>Sub{'scribe' if k else ''}</p></div>" if k != 5 else None, "x", 1, "y", 2) for k in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, wrapper string, salt int, fixed string, host int")
    a, b = ({r.page_id: r.text for r in H.extract(df, broadcast_bytes=n).collect()} for n in (1 << 20, 0))
    assert a == b and a[5] == "" and a[1] == "Body 1" and a[0] == "Body 0\nSub"


@pytest.mark.parametrize("name", ["related-work", "legal-history", "search-algorithms", "comments-on-plato", "promo-codes-explained", "notice-of-results"])
def test_sections_named_like_furniture_stay(spark, name):
    rows = [(k, f"https://a.example.org/{k}", f"<body><nav>Menu</nav><article><h1>Weekly report</h1><p>A first part of the text {k} that is long enough.</p><section id='{name}'><h2>On it {k}</h2><p>Its own words {k}.</p></section></article></body>") for k in range(3)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(f"Its own words {k}." in got[k] for k in got), got
