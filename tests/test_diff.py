"""Token diff against a longest common subsequence by dynamic programming."""

from __future__ import annotations

import random

from quire.operators import diff as D


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def edited(rng, a):
    out = []
    for w in a:
        r = rng.random()
        out += [w] if r < 0.85 else [f"new{rng.randrange(99)}"] if r < 0.9 else [w, "the"] if r < 0.95 else []
    return out


def test_runs_rebuild_both_sides_and_keep_nearly_what_can_be_kept():
    rng = random.Random(2)
    kept = best = 0
    for n, words in [(0, 5), (1, 1), (5, 2), (40, 10), (200, 60), (300, 2000)] * 15:
        a = [f"w{int(rng.paretovariate(0.6)) % words}" for _ in range(n)]
        near = rng.random() < 0.8
        b = edited(rng, a) if near else rng.sample(a, len(a))
        found = D.runs(a, b)
        side = lambda other, own, at: [w for r in found if r[0] != other for w in own[r[at] : r[at] + r[3]]]
        assert side(D.ADDED, a, 1) == a and side(D.LOST, b, 2) == b
        assert all(x[0] != y[0] for x, y in zip(found, found[1:], strict=False))
        assert all(a[i : i + k] == b[j : j + k] for kind, i, j, k in found if kind == D.KEPT)
        mine, most = sum(r[3] for r in found if r[0] == D.KEPT), longest(a, b)
        assert mine <= most
        if len(set(a)) == len(a) and len(set(b)) == len(b):
            assert mine == most  # all tokens are unique: anchors are a longest common subsequence
        kept, best = kept + near * mine, best + near * most
    assert kept > 0.93 * best


def test_chain_is_a_longest_ascending_one():
    rng = random.Random(4)
    for n in (0, 1, 2, 7, 30, 100):
        j = rng.sample(range(n), n)
        chain = D.ascending(list(enumerate(j)))
        assert chain == sorted(chain) and all(x[1] < y[1] for x, y in zip(chain, chain[1:], strict=False))
        assert len(chain) == longest(list(range(n)), j)


def test_diff_and_its_report(spark):
    left = spark.createDataFrame([(1, "a b  c d"), (2, None), (3, "x y"), (4, "only left"), (5, "same\nhere")], "k long, text string")
    right = spark.createDataFrame([(1, "a c e d"), (2, " "), (3, None), (6, "only right"), (5, "same here")], "k long, text string")
    found = D.diff(left, right, "k")
    got = sorted((r["k"], r["run"], r["kind"], r["left_at"], r["right_at"], r["n"], r["text"]) for r in found.collect())
    assert got == [(1, 1, "kept", 0, 0, 1, "a"), (1, 2, "lost", 1, 1, 1, "b"), (1, 3, "kept", 2, 1, 1, "c"), (1, 4, "added", 3, 2, 1, "e"), (1, 5, "kept", 3, 3, 1, "d"), (3, 1, "lost", 0, 0, 2, "x y"), (5, 1, "kept", 0, 0, 2, "same here")]
    assert sorted(map(tuple, D.report(found, "k").collect())) == [(1, 4, 4, 0.75, True), (3, 2, 0, 0.0, True), (5, 2, 2, 1.0, False)]
    long = " ".join(f"w{i}" for i in range(60_000))
    one = spark.createDataFrame([(1, long)], "k long, text string")
    assert D.diff(one, spark.createDataFrame([(1, long.replace("w500 ", "") + " end")], "k long, text string"), "k").count() == 4
