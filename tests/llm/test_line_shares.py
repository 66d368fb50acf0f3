"""Planted repeated lines at several shares of hosts of several sizes, with the operator's own ratio and support."""

from __future__ import annotations

import pytest

from quire.llm import lines


@pytest.mark.parametrize(("pages", "share", "goes"), [(4, 4, True), (4, 2, False), (10, 3, True), (50, 3, True), (50, 2, False), (500, 6, True), (500, 22, True), (500, 5, False), (2900, 29, False), (2900, 30, True)])
def test_planted_lines_go_by_their_share(spark, pages, share, goes):
    rows = [(i, f"line {i}\n  Subscribe here \nend {i}" if i < share else f"line {i}\nend {i}", "h") for i in range(pages)]
    out = lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sum(r["lines_dropped"] for r in out) == (share if goes else 0)
    assert all(("Subscribe" in r["text"]) == (not goes and r["doc_id"] < share) for r in out)
