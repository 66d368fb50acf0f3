"""Keys with very many rows, and long chains: the same results whether sides are broadcast, split or shuffled."""

from __future__ import annotations

import random

from quire.llm import simhash, storage
from quire.llm.components import components


def by_union(edges):
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in list(parent)}


def test_components_of_stars_and_chains(spark, monkeypatch):
    rng = random.Random(6)
    star = [(5, 100 + i) for i in range(1600)]
    chain = [(3000 + i, 3001 + i) for i in range(300)]
    more = [(rng.randrange(20_000, 20_300), rng.randrange(20_000, 20_300)) for _ in range(150)] + [(19_999, 19_999)]
    edges = star + chain + more
    rng.shuffle(edges)
    table = spark.createDataFrame(edges, "a long, b long")
    want = by_union(edges)
    assert {r["id"]: r["component"] for r in components(table).collect()} == want
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 50)  # hot nodes by broadcast, others by a shuffle
    assert {r["id"]: r["component"] for r in components(table).collect()} == want


def test_fingerprints_that_many_share(spark, monkeypatch):
    rows = [(i, "one and the same text of a page that is not there") for i in range(1500)] + [(2000 + i, f"text {i} of its own with word w{i} and x{i * 7}") for i in range(50)] + [(9000, None), (9001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 50)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == few
    assert len(few) == len(rows) and {c for d, _, c in few if d < 1500} == {0} and {c for d, _, c in few if d >= 9000} == {9000}
