"""A store's state at any time, from its log of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(log: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """log with valid_from and valid_to: a change holds until its key's next, the last for good (null). Equal times go by `tie`."""
    order = Window.partitionBy(key).orderBy(time, tie)
    return log.withColumns({"valid_from": F.col(time), "valid_to": F.lead(time).over(order)})


def as_of(asked: DataFrame, log: DataFrame, key: str, at: str, time: str, tie: str, grain: str = "month") -> DataFrame:
    """asked with `change`: the last change (a struct of log's columns) of its key at or before its time `at`; null without one.

    Of equal times the larger `tie` is the last. Both sides are sorted once within each key and stretch of time (`grain`, of
    date_trunc); what an earlier stretch leaves comes from one row per key and stretch, so a key that has much of the log is
    many tasks' work. Null keys and times find nothing.
    """
    bucket = lambda t: F.date_trunc(grain, F.col(t))
    rest = F.struct(*log.columns)
    changes = log.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).alias("__key"), bucket(time).alias("__bucket"), F.col(time).alias("__time"), F.col(tie).alias("__tie"), rest.alias("__change"))
    questions = asked.select(F.col(key).alias("__key"), bucket(at).alias("__bucket"), F.col(at).alias("__time"), F.struct(*asked.columns).alias("__asked"))
    both = changes.withColumns({"__asked": F.lit(None).cast(questions.schema["__asked"].dataType), "__side": F.lit(0)}).unionByName(
        questions.withColumns({"__tie": F.lit(None).cast(changes.schema["__tie"].dataType), "__change": F.lit(None).cast(changes.schema["__change"].dataType), "__side": F.lit(1)})
    )
    # at one time changes come before questions
    within = Window.partitionBy("__key", "__bucket").orderBy("__time", "__side", "__tie")
    found = both.withColumn("__found", F.last("__change", ignorenulls=True).over(within)).where("__side = 1")
    last = both.groupBy("__key", "__bucket").agg(F.max_by("__change", F.when(F.col("__side") == 0, F.struct("__time", "__tie"))).alias("__last"))
    before = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("__before", F.last("__last", ignorenulls=True).over(before)).drop("__last").where("__before is not null")
    out = found.join(carried, ["__key", "__bucket"], "left")
    return out.select("__asked.*", F.coalesce("__found", "__before").alias("change"))


def state_at(log: DataFrame, key: str, time: str, tie: str, moment: Column, deleted: Column) -> DataFrame:
    """The last change of each key at or before a moment, without those whose last is a deletion. No key's log is gathered."""
    last = log.where(F.col(time) <= moment).withColumn("__deleted", deleted).groupBy(key).agg(F.max_by(F.struct(*[c for c in log.columns if c != key], "__deleted"), F.struct(time, tie)).alias("__last"))
    return last.select(key, "__last.*").where(~F.coalesce("__deleted", F.lit(False))).drop("__deleted")


def roll_back_to(log: DataFrame, key: str, time: str, tie: str, content: str, moment: Column, deleted: Column) -> DataFrame:
    """What to append to the log so that the state is that of a moment again: (key, content, action), restore or delete.

    Keys whose content is the same then and now get no row; the log itself stays, so that a rollback can be rolled back.
    """
    pick = lambda upto, name: state_at(log, key, time, tie, upto, deleted).select(key, F.col(content).alias(name), F.lit(True).alias(f"in_{name}"))
    now = log.agg(F.max(time).alias("__now"))
    latest = now.first()["__now"]
    if latest is None:
        return log.select(key, content, F.lit("delete").alias("action")).limit(0)
    both = pick(moment, "then").join(pick(F.lit(latest), "now"), key, "full")
    changed = ~F.col("then").eqNullSafe(F.col("now")) | ~F.col("in_then").eqNullSafe(F.col("in_now"))
    return both.where(changed).select(key, F.col("then").alias(content), F.when(F.col("in_then"), "restore").otherwise("delete").alias("action"))
