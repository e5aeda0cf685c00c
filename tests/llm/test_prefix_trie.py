"""The prefix trie against plain lists, whatever is an upper level, with conversations that fill several tasks."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from folioflow.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, lo string, size int"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], (role, text)))
    own = {c: [t for *_, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, out = defaultdict(int), []
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), kids[node], leaves[node], saved[node], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df, **how):
    return sorted((tuple(r) for r in trie.prefix_trie(df, **how).collect()), key=repr)


def conversations(seed, n=60):
    """Few distinct turns, so that prefixes are shared; missing numbers, repeated rows, rows without a conversation."""
    rng, rows = random.Random(seed), []
    for c in [*range(n), -3, -5, 1000, 2**40]:
        for t in range(rng.randrange(1, 14)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", None, ""]) if rng.random() < 0.2 else "user", rng.choice(["", None, "é", "same"]) if rng.random() < 0.7 else f"t{rng.randrange(3)}", "x", 1))
    return [*rows, *rows[:7], (None, 1, "user", "nobody", "x", 1), (None, None, None, None, None, None)]


@pytest.mark.parametrize("heavy", [0, 3, 40, trie.HEAVY])
def test_is_brute_force(spark, heavy):
    rows = conversations(heavy + 1)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert got(df.repartition(5), heavy=heavy) == want


def test_conversations_over_several_tasks(spark, monkeypatch):
    """One conversation, and one prefix, with most of the rows; chunks and pieces of a few rows."""
    monkeypatch.setattr(trie, "CHUNK", 16)
    rows = [(5, t, "user", f"turn {t % 7}", None, None) for t in range(400)] + [(5 + 5 * k, t, "user", f"turn {t % 7}", None, None) for k in range(1, 60) for t in range(k % 6)]
    rows += [(c, t, "user", "long " * 20_000, None, None) for c in (7, 8) for t in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    for heavy in (0, 30, trie.HEAVY):
        assert got(df, heavy=heavy) == brute(rows)


def test_broadcast_is_no_condition(spark, monkeypatch):
    monkeypatch.setattr(trie, "FEW", -1)
    rows = conversations(9)
    assert got(spark.createDataFrame(rows, SCHEMA), heavy=10) == brute(rows)


def test_empty_and_turnless(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    c = next(c for c in range(1, 99) if c % 5 and crc32(str(c).encode()) % 9 > 1)  # its only turn is replaced by none
    rows = [(c, 0, "user", "gone", None, None)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == [(c, 0, None, 1, 0, 1, 0, sha256(str(c).encode()).hexdigest())]


def test_bits():
    """A root with two children, of which the first has three and the second none."""
    t = trie.Louds(np.array([2, 3, 0, 0, 0, 0]), np.arange(5))
    assert "".join(map(str, t._bits())) == "11011100000" and t.degrees().tolist() == [2, 3, 0, 0, 0, 0] and t.parents().tolist() == [0, 0, 1, 1, 1]


def test_sums_go_on_where_the_last_range_ended(spark):
    from folioflow.llm.common import Workspace
    from pyspark.sql import functions as F

    df = spark.range(1000).select(F.when(F.col("id") < 900, F.lit(1)).otherwise(F.col("id")).cast("long").alias("k"), "id")
    big = lambda batch: (batch.column(1).to_numpy().astype(np.uint64) * np.uint64(2**60 + 7))[:, None]
    out = trie.running(df, Workspace(spark, "sums-test"), "sums", [F.col("k"), F.col("id")], big, 1, prior=True).collect()
    for r in out:
        want = sum(i * (2**60 + 7) for i in range(r.id + 1)) if r.k == 1 else r.id * (2**60 + 7)
        assert (r.run0 - want) % 2**64 == 0 and (r.run0 - r.before0 - r.id * (2**60 + 7)) % 2**64 == 0
    assert len(out) == 1000
