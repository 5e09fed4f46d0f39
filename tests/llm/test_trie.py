"""Conversation prefix trie: brute force, the scans and the contraction by themselves."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklens.llm import trie

TURNS = "conv_id long, turn long, role string, text string, depth long, node string"


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    full = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, t in full.items():
        ends[tuple(t)].append(c)
        for d in range(len(t) + 1):
            members[tuple(t[:d])].add(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            kids[n[:-1]] += 1
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(m) - 1) * (len(n[-1][1]) if n else 0)
    return [(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids.get(n, 0), leaves[n], saved[n],
             hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items()]


def some_turns():
    rng = np.random.default_rng(3)
    rows = []
    for c in [*range(0, 260), 999, 1000, 2_000_007]:
        for t in range(int(rng.integers(1, 8))):
            rows.append((c, t, "user" if t % 2 else "system", f"text {rng.integers(0, 3)}"))
    rows += [(5000, t, "user", "again") for t in range(70)]         # a deep chain
    rows += [(5001, t, "user", "again") for t in range(90)]         # that shares most of another
    rows += [(c, 0, "user", "alone") for c in range(7001, 7030)]    # family without a first one, some turnless
    rows += [(8000, None, None, None), (8000, 1, "", ""), (8000, 1, "b", "tie"), (8000, 1, "a", "tie"),
             (8000, 1, "a", "tie"), (8001, None, "x", None), (None, 1, "user", "nobody"), (8002, 3, "1:", "x"),
             (8003, 3, "1", ":x"), (8004, 0, "user", "é😀" * 3000)]
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "n") for r in rows], TURNS)


def test_trie_equals_brute_force(spark):
    rows = some_turns()
    df = trie.prefix_trie(frame(spark, rows))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                          "saved_tokens", "ends_sha256"]
    want = sorted(plain(rows), key=lambda r: (r[0], r[1]))
    assert result(df) == want
    assert any(r[1] == 0 and r[7] != hashlib.sha256().hexdigest() for r in want)  # turnless ones


def test_trie_of_nothing(spark):
    empty = frame(spark, some_turns()[:3]).where(F.lit(False))
    assert trie.prefix_trie(empty).collect() == []
    one = trie.prefix_trie(frame(spark, [(3, 0, "user", "hi")])).collect()
    assert len(one) == len(plain([(3, 0, "user", "hi")]))


def test_running_over_many_partitions(spark):
    """A key that holds most rows, and lies in many partitions, is numbered without a gap."""
    rng = np.random.default_rng(1)
    rows = [(4, i, int(x)) for i, x in enumerate(rng.integers(0, 2**60, 3000))]
    rows += [(k, 0, k * 31) for k in (1, 2, 3, 5, 6)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "k long, o long, x long")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.k, r.o): (r.n, r.x) for r in trie.running(df, "k", ["o"], ["x"], "n", "t").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    at, x = defaultdict(int), defaultdict(int)
    for k, o, v in sorted(rows):
        at[k] += 1
        x[k] ^= v
        assert got.pop((k, o)) == (at[k], x[k])
    assert not got


@pytest.mark.parametrize("shape", ["chain", "star", "comb", "random", "forest"])
def test_contraction(spark, shape):
    n = 300
    rng = np.random.default_rng(8)
    parent = {"chain": lambda i: i - 1, "star": lambda i: 0, "comb": lambda i: i - 1 if i % 2 else max(0, i - 2),
              "random": lambda i: int(rng.integers(0, i)), "forest": lambda i: None if i % 50 == 0 else i - 1}[shape]
    rows = [(i, None if i == 0 else parent(i), i * i, 1) for i in range(n)]
    names = [int(x) for x in rng.permutation(n)]  # names say nothing about the order
    tree = spark.createDataFrame([(names[i], None if p is None else names[p], v, w) for i, p, v, w in rows],
                                 "node long, parent long, v long, w long")
    rounds = []
    got = {r.node: (r.v, r.w) for r in trie.subtree_totals(tree, ["v", "w"], rounds).collect()}
    want = {i: [v, w] for i, _, v, w in rows}
    for i, p, _, _ in reversed(rows):
        if p is not None:
            want[p][0] += want[i][0]
            want[p][1] += want[i][1]
    assert got == {names[i]: tuple(x) for i, x in want.items()}
    assert len(rounds) <= 9 and max(rounds) <= 10  # logarithmic, chains of 300 included
    if shape == "chain":
        assert len(rounds) == 1


def test_ends_in_chunks(spark, monkeypatch):
    ends = spark.createDataFrame([(1, i) for i in range(120_000)] + [(2, 7), (2, 3), (-4, 0)], "k long, conv_id long")
    got = {r.k: r.ends_sha256 for r in trie.ends_digest(ends, ["k"]).collect()}

    def sha(ids):
        return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()

    assert got == {1: sha(range(120_000)), 2: sha([3, 7]), -4: sha([0])}
