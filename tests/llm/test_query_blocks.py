"""Top-k: a task holds one block of queries and one chunk of rows."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from quire.llm import topk


def test_queries_are_grouped_by_block(spark):
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(200)], "vec_id long, embedding array<double>")
    out = topk.top_k(table, k=3, query_every=4, chunk=50, block=7)
    plan = out._jdf.queryExecution().toString()
    assert re.search(r"FlatMapCoGroupsInPandas \[chunk#\d+, block#\d+\], \[chunk#\d+, block#\d+\]", plan)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, topk.top_k(table, k=3, query_every=4).collect()))


def test_large_components_ties_and_repeats(spark):
    big = 2**27  # after scaling: scores beyond 2^53
    rows = [(50, [big, 1]), (1, [big, 3]), (4, [big, 2]), (3, [big, 2]), (3, [big, 2]), (3, [big + 1, 9])]
    table = spark.createDataFrame([(i, [x / 256 for x in v]) for i, v in rows], "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in topk.top_k(table, k=5).orderBy("rank").collect()]
    top = big * (big + 1) + 9
    assert got == [(50, 1, 3, top), (50, 2, 1, big * big + 3), (50, 3, 3, big * big + 2), (50, 4, 3, big * big + 2), (50, 5, 4, big * big + 2)]


def test_rows_that_repeat_an_id_count_each(spark):
    rows = [(50, [1, 2]), (50, [3, 1]), (1, [1, 1]), (1, [5, 5]), (2, [0.5, 0.5]), (None, [9, 9]), (3, [])]
    table = spark.createDataFrame([(i, [float(x) / 256 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(table, k=2).collect()))
    # (1, [5, 5]) is best for both queries; each query's other row is a candidate
    assert got == [(50, 1, 1, 15), (50, 1, 1, 20), (50, 2, 50, 5), (50, 2, 50, 5)]


def test_floors_lose_no_row(spark):
    rng = np.random.default_rng(21)
    v = rng.integers(-9, 9, (400, 40))
    table = spark.createDataFrame([(i, [float(x) / 256 for x in row]) for i, row in enumerate(v.tolist())], "vec_id long, embedding array<double>").repartition(3)
    scores = v @ v.T
    want = []
    for q in range(0, 400, 20):
        best = sorted((r for r in range(400) if r != q), key=lambda r: (-scores[q, r], r))[:4]
        want += [(q, i + 1, r, int(scores[q, r])) for i, r in enumerate(best)]
    for chunk in (25, 90, 1000):
        assert sorted(map(tuple, topk.top_k(table, k=4, query_every=20, chunk=chunk, block=6).collect())) == want
