"""Where intermediate tables go: only folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that are broadcast at most, once counted.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset in local mode (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there: a lost executor then costs a reread, not a recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def join_hot(rows: DataFrame, one: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """`total` rows joined with `one` (a row per key, the number of its rows in `count`): no key's rows meet in one task.

    Of few rows, `one` is broadcast. Of more, keys with over one in BROADCAST_ROWS of all rows are that many at most
    and are broadcast; the rest is shuffled.
    """
    if total <= BROADCAST_ROWS:
        return rows.join(F.broadcast(one.drop(count)), key)
    rows, one = cut(rows), cut(one)
    much = F.col(count) > total // BROADCAST_ROWS + 1000
    hot, cold = one.where(much).drop(count), one.where(~much).drop(count)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def fresh_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
