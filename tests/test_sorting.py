"""Bundles kept in order while documents arrive."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quire.streaming import sorting

SCHEMA = "bundle string, id string, position string"


def run(spark, folder, batches):
    """The rows written for batches that arrive one after another, in runs of their own."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        rows = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        query = sorting.sorted_stream(rows).writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def places(rows):
    return sorted((r["bundle"], r["place"], r["id"], r["position"]) for r in sorting.current(rows).collect())


def test_three_batches_give_the_order_of_one(spark, tmp_path):
    rng = random.Random(5)
    docs = [(rng.choice("ab"), f"d{i:03}", f"{rng.randrange(40):05}") for i in range(90)]
    three = run(spark, str(tmp_path / "three"), [docs[:30], docs[30:60], [*docs[60:], *docs[:5], ("a", None, "1"), (None, "x", "1"), ("a", "y", None)]])
    one = run(spark, str(tmp_path / "one"), [docs])
    want = sorted((b, i + 1, d, p) for b in "ab" for i, (p, d) in enumerate(sorted((p, d) for c, d, p in docs if c == b)))
    assert places(three) == places(one) == want
    # each document is written once: neighbours stay where they are
    assert three.count() == len(docs)
    backwards = sorting.current(three, F.col("bundle") == "a").where("place = 1").collect()
    assert {r["bundle"]: r["id"] for r in backwards} == {"a": max((p, d) for c, d, p in docs if c == "a")[1], "b": min((p, d) for c, d, p in docs if c == "b")[1]}


def test_a_document_moves_and_ranks_that_run_out_are_spread(spark, tmp_path):
    first = [("a", "x", "5"), ("a", "y", "7")]
    # always between the same two: the room halves each time
    between = [("a", f"n{i:03}", "6") for i in range(99, 9, -1)]
    rows = run(spark, str(tmp_path / "m"), [first, between, [("a", "x", "9"), ("a", "y", "1")]])
    assert [r[2] for r in places(rows)] == ["y", *sorted(d for _, d, _ in between), "x"]


def test_insertion_of_any_order_keeps_ranks_ascending():
    rng = random.Random(8)
    for _ in range(30):
        keys, ids, ranks = [], [], []
        for i in range(80):
            if sorting.insert(keys, ids, ranks, f"{rng.randrange(50):02}{i}", str(i)) is None:
                ranks = sorting.spread(len(ranks))
        assert keys == sorted(keys) and ranks == sorted(set(ranks))


def kept(spark, folder, batches):
    """The rows that keep_sorted has written for batches that arrive one after another."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        sorting.keep_sorted(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/state", parts=4)
    return spark.read.parquet(f"{folder}/out")


def test_a_table_of_bundles_has_the_order_of_the_state_store(spark, tmp_path):
    rng = random.Random(6)
    docs = [(rng.choice("abc"), f"d{i:03}", f"{rng.randrange(40):05}") for i in range(90)]
    rows = kept(spark, str(tmp_path / "t"), [docs[:30], docs[30:60], [*docs[60:], *docs[:5], ("a", None, "1"), (None, "x", "1"), ("a", "y", None)]])
    want = sorted((b, i + 1, d, p) for b in "abc" for i, (p, d) in enumerate(sorted((p, d) for c, d, p in docs if c == b)))
    assert places(rows) == want
    # each document is written once: neighbours stay where they are
    assert rows.count() == len(docs)
    # a batch that is repeated adds none
    sorting.keep_sorted(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/t/in"), f"{tmp_path}/t/out", f"{tmp_path}/t/again", parts=4)
    assert spark.read.parquet(f"{tmp_path}/t/out").count() == len(docs)


def test_documents_of_a_table_move_and_ranks_that_run_out_are_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sorting, "TOP", 16)
    batches = [[("a", "x", "5"), ("a", "y", "7"), ("b", "z", "1")], [("a", "m", "6"), ("a", "n", "6")], [("a", f"o{i}", "6") for i in range(4)], [("a", "x", "9"), ("a", "y", "1")]]
    rows = kept(spark, str(tmp_path / "m"), batches)
    assert [r[:3] for r in places(rows)] == [*[("a", i + 1, d) for i, d in enumerate(["y", "m", "n", "o0", "o1", "o2", "o3", "x"])], ("b", 1, "z")]
    last = rows.where("version = 3 and bundle = 'a'").orderBy("position", "id").collect()
    assert [r["rank"] for r in last] == [16 // 9 * (i + 1) for i in range(8)]  # all leave once where there is no room
