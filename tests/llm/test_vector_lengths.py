"""Vectors whose length the pivot sample lacks still link."""

from __future__ import annotations

import pytest

from quire.llm import vectors


@pytest.mark.parametrize("block", [vectors.BLOCK, 2])
def test_lengths_outside_the_sample_link(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "SAMPLE", 1)  # one length at most is in it
    rows = [(10 * n + i, [float(i + 1)] + [2.0 * (i + 1)] * (n - 1)) for n in (2, 3, 4) for i in range(3)]
    rows += [(90, [1.0, -5.0]), (91, [1.0] * 7)]
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=block).collect()}
    assert out == {10 * n + i: (2, 10 * n) for n in (2, 3, 4) for i in range(3)} | {90: (0, 90), 91: (0, 91)}
