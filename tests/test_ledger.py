"""Only what changed is computed again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.operators import ledger, snapshots

SCHEMA = "k string, total long"


def test_second_runs_compute_what_changed(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "s"), []

    def compute(rows):
        out = rows.groupBy("k").agg(F.sum("v").alias("total"))
        seen.append(sorted(r["k"] for r in out.collect()))
        return out

    def run(rows, override=None):
        table = spark.createDataFrame(rows, "k string, v long").repartition(3).withColumn("digest", F.lit("clash"))
        done = ledger.refresh(spark, root, table, "k", ["v"], compute, SCHEMA, override)
        return done, {r["k"]: (r["total"], r["version"]) for r in ledger.results(spark, root, "k", SCHEMA).collect()}

    first = [("a", 1), ("a", 2), ("b", 5), ("c", None), (None, 9)]
    assert run(first) == ((3, 0), {"a": (3, 1), "b": (5, 1), "c": (None, 1)})
    # order doesn't matter, and nothing is computed or committed
    assert run(first[::-1])[0] == (0, 0) and snapshots.last_version(spark, root) == 1 and len(seen) == 1
    # a repeated row, a key more, one gone
    assert run([("a", 1), ("a", 2), ("a", 2), ("c", None), ("d", 7)]) == ((2, 1), {"a": (5, 2), "c": (None, 1), "d": (7, 2)})
    assert seen[-1] == ["a", "d"]
    assert run([("a", 1), ("a", 2), ("a", 2), ("c", None), ("d", 7)], F.col("k").isin("c", "gone")) == ((1, 0), {"a": (5, 2), "c": (None, 3), "d": (7, 2)})
    assert seen[-1] == ["c"]
    # a run broken off before its commit leaves all as it was, a key that comes back is new
    with monkeypatch.context() as m:
        m.setattr(snapshots.Commit, "publish", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run([("b", 6)])
    assert run([("a", 1), ("a", 2), ("a", 2), ("c", None), ("b", 6)]) == ((1, 1), {"a": (5, 2), "c": (None, 3), "b": (6, 4)})
    assert run([]) == ((0, 3), {})


def test_digests_differ_by_any_value(spark):
    sets = [[(1, "a"), (2, "b")], [(1, "b"), (2, "a")], [(1, "a")], [(1, "a"), (1, "a")], [(1, None), (2, "b")], [(None, "a"), (2, "b")], [(1, ""), (2, "b")]]
    rows = [(i, x, y) for i, pairs in enumerate(sets) for x, y in pairs]
    got = ledger.digests(spark.createDataFrame(rows, "k int, x int, y string"), "k", ["x", "y"]).collect()
    assert len({r["digest"] for r in got}) == len(sets)
