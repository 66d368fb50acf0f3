"""Documents of bundles in their order, kept as they arrive: a document takes its place between its neighbours.

The state of a bundle is its documents by rank. A batch moves only documents that arrive or change, by a rank between those
of their neighbours, so nothing is sorted anew and no other row is written. Ranks are fractions with a fixed number of
bits; where two neighbours leave no room, and only then, the bundle's ranks are spread out again and all of its rows
leave once.

Two ways keep that state: `sorted_stream` in Spark's state store, a bundle at a time in Python, for streams whose batches touch
few bundles; `keep_sorted` as a table, by windows over all bundles of a batch at once, for batches of any size.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources import shared

#: The largest rank; ranks of a bundle start in the middle and at the ends leave half of what is free.
TOP = 1 << 62
OUT = "bundle string, id string, position string, rank long, version long"
STATE = "keys array<string>, ids array<string>, ranks array<long>, version long"
MARK = "\0"
#: Parts of a table of bundles, by a hash of the bundle; documents that a task sorts, about.
PARTS, ROWS = 64, 250_000


def insert(keys: list[str], ids: list[str], ranks: list[int], key: str, document: str) -> int | None:
    """Put a document in its place among keys in order; its rank, None where its neighbours leave no room."""
    at = bisect_left(keys, key)
    low, high = ranks[at - 1] if at else 0, ranks[at] if at < len(ranks) else TOP
    rank = (low + high) // 2
    keys.insert(at, key)
    ids.insert(at, document)
    ranks.insert(at, rank)
    return rank if low < rank < high else None


def spread(n: int) -> list[int]:
    return [TOP // (n + 1) * (i + 1) for i in range(n)]


def place(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    keys, ids, ranks, version = (list(state.get[0]), list(state.get[1]), list(state.get[2]), state.get[3]) if state.exists else ([], [], [], 0)
    arrived: dict[str, str] = {}
    for rows in batches:
        for position, document in zip(rows["position"], rows["id"], strict=True):
            arrived[document] = min(arrived.get(document, position), position)
    changed, tight, version = [], False, version + 1
    for document, position in sorted(arrived.items()):
        if document in ids:
            at = ids.index(document)
            if keys[at] == position + MARK + document:
                continue
            del keys[at], ids[at], ranks[at]
        changed.append(document)
        tight |= insert(keys, ids, ranks, position + MARK + document, document) is None
    if not changed:
        return
    if tight:
        ranks, changed = spread(len(ids)), list(ids)
    state.update((keys, ids, ranks, version))
    of = {d: i for i, d in enumerate(ids)}
    rows = [(key[0], d, keys[of[d]].split(MARK)[0], ranks[of[d]], version) for d in changed]
    yield pd.DataFrame(rows, columns=["bundle", "id", "position", "rank", "version"])


def sorted_stream(documents: DataFrame) -> DataFrame:
    """Of a stream of (bundle, id, position), rows (bundle, id, position, rank, version) that came or moved.

    Ranks ascend with position, then id, within a bundle; of a document's rows the last version counts (`current`). A
    document that comes again with another position moves; of several positions in one batch the least counts. Rows without
    a bundle, id or position are left out. The state of a bundle is as large as the bundle.
    """
    whole = documents.select(F.col("bundle").cast("string"), F.col("id").cast("string"), F.col("position").cast("string")).dropna()
    return whole.groupBy("bundle").applyInPandasWithState(place, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def ranked(documents: DataFrame) -> DataFrame:
    """Rows that came or moved, of documents (part, cell, bundle, id, arrived, held: position, rank, version): OUT and part.

    Documents without a rank stand in runs between neighbours that have one; a run shares their room evenly. Runs and
    neighbours are seen from both ends, each by one pass over a bundle.
    """
    moved = F.col("arrived").isNotNull() & F.coalesce(F.col("arrived") != F.col("held.position"), F.lit(True))
    rows = documents.select("part", "cell", "bundle", "id", F.when(moved, F.col("arrived")).otherwise(F.col("held.position")).alias("position"), F.when(~moved, F.col("held.rank")).alias("kept"), F.col("held.version").alias("version"))
    bundle = Window.partitionBy("part", "cell", "bundle")
    for name, order in (("low", bundle.orderBy("position", "id")), ("high", bundle.orderBy(F.desc("position"), F.desc("id")))):
        rows = rows.withColumn(f"n_{name}", F.row_number().over(order))
        last = F.last(F.when(F.col("kept").isNotNull(), F.struct("kept", F.col(f"n_{name}").alias("n"))), ignorenulls=True)
        rows = rows.withColumn(name, last.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    low, high = F.coalesce("low.kept", F.lit(0)), F.coalesce("high.kept", F.lit(TOP))
    i, j = (F.col(f"n_{x}") - F.coalesce(f"{x}.n", F.lit(0)) for x in ("low", "high"))
    rows = rows.select("part", "cell", "bundle", "id", "position", "kept", "version", "n_low", low.alias("low"), high.alias("high"), i.alias("i"), j.alias("j"))
    rows = rows.withColumn("step", F.when(F.col("kept").isNull(), F.expr("(high - low) div (i + j)")))
    rows = rows.withColumns({"tight": F.min("step").over(bundle) < 1, "n": F.count(F.lit(1)).over(bundle), "version": F.coalesce(F.max("version").over(bundle), F.lit(0).cast("long")) + 1})
    spread_out = F.expr(f"{TOP}L div (n + 1)") * F.col("n_low")
    rank = F.when(F.coalesce("tight", F.lit(False)), spread_out).otherwise(F.col("low") + F.col("step") * F.col("i"))
    return rows.where("kept is null or tight").select("bundle", "id", "position", rank.alias("rank"), "version", "part")


def keep_sorted(documents: DataFrame, target: str, checkpoint: str, parts: int = PARTS) -> StreamingQuery:
    """Append to the table at target what all that has arrived of a stream (bundle, id, position) adds or moves; then stop.

    The rows and their rules are those of `sorted_stream`, and part. The table is partitioned by a hash of the bundle (part), so a batch
    reads the bundles of its own parts only; its number of tasks grows with its documents. A batch that is repeated after a
    failure finds its documents in their places and adds none.
    """
    part = F.pmod(F.xxhash64("bundle"), F.lit(parts)).cast("int")

    def insert(batch: DataFrame, _: int) -> None:
        touched = [r[0] for r in batch.select(part).distinct().collect()]  # at most `parts` numbers
        rows = batch.select("bundle", "id", F.col("position").alias("arrived"), F.lit(None).cast("struct<position:string,rank:bigint,version:bigint>").alias("held"))
        total = batch.count()
        try:
            table = batch.sparkSession.read.schema(f"{OUT}, part int").parquet(target).where(F.col("part").isin(touched))
            held = table.join(batch.select("bundle").distinct(), "bundle", "left_semi")
            rows = rows.unionByName(held.select("bundle", "id", F.lit(None).cast("string").alias("arrived"), F.struct("position", "rank", "version").alias("held")))
        except AnalysisException as e:  # the first batch: there is no table yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        n = shared.tasks(rows, ROWS, total)
        # a task has some cells of a part or a few, so that it writes few files
        cell = F.pmod(F.shiftright(F.xxhash64("bundle"), 20), F.lit(-(-4 * n // parts))).cast("int")
        dealt = rows.withColumns({"part": part, "cell": cell}).repartition(n, "part", "cell")
        whole = dealt.groupBy("part", "cell", "bundle", "id").agg(F.min("arrived").alias("arrived"), F.max_by("held", F.col("held.version")).alias("held"))
        ranked(whole).write.mode("append").partitionBy("part").parquet(target)

    whole = documents.select(F.col("bundle").cast("string"), F.col("id").cast("string"), F.col("position").cast("string")).dropna()
    query = whole.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def current(written: DataFrame, reverse: Column | None = None) -> DataFrame:
    """(bundle, id, position, place): the last version of each document, and its place, from 1, in its bundle.

    Where `reverse` (a condition on the bundle) holds, the last comes first.
    """
    dealt = shared.spread(written, ROWS, "bundle")  # for both what is last and the order
    last = dealt.groupBy("bundle", "id").agg(F.max_by(F.struct("position", "rank"), "version").alias("r")).select("bundle", "id", "r.*")
    order = F.col("rank") if reverse is None else F.when(reverse, -F.col("rank")).otherwise(F.col("rank"))
    return last.withColumn("place", F.row_number().over(Window.partitionBy("bundle").orderBy(order))).drop("rank")
