"""Stores that only grow: insert-if-absent, a change log, resuming and rolling back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import shared
from . import lookups


def insert_if_absent(stored: DataFrame, new: DataFrame, key: list[str], order: Column) -> tuple[DataFrame, DataFrame]:
    """(inserted, refused): rows of new whose key isn't stored, the first of each key; and all other rows of new.

    A second run with the same rows inserts none.
    """
    rest = [c for c in new.columns if c not in key]
    first = new.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("__row")).select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest])
    inserted = first.join(stored.select(*key), key, "left_anti")
    refused = new.join(stored.select(*key).distinct(), key, "left_semi")
    return inserted, refused


def upsert(stored: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """stored with the rows of new in place of those of the same key."""
    return stored.join(new.select(*key), key, "left_anti").unionByName(new)


def changes(rows: DataFrame, entity: str, id_column: str, stamp: Column, content: Column) -> DataFrame:
    """Change-log rows of these: (timestamp, entity, id, content_sha1)."""
    return rows.select(stamp.alias("timestamp"), F.lit(entity).alias("entity"), F.col(id_column).cast("string").alias("id"), F.sha1(content.cast("binary")).alias("content_sha1"))


def remaining(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose trimmed key isn't done yet: what a resumed run has to do."""
    finished = done.select(F.trim(F.col(key).cast("string")).alias("__done")).distinct()
    return work.join(finished, F.trim(F.col(key).cast("string")) == F.col("__done"), "left_anti")


def roll_back(stored: DataFrame, bundles: DataFrame, ids: DataFrame, key: str, items: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stored, bundles, report) without the rows of ids: rows go, memberships in bundles' items go.

    report: each id with ROLLEDBACK or MISSING; an id that isn't stored is no failure.
    """
    left = stored.join(ids.select(key).distinct(), key, "left_anti")
    member = bundles.select("bundle_id", F.posexplode_outer(items).alias("__at", "__item"))
    gone = ids.select(F.col(key).alias("__gone")).distinct()
    kept = member.join(gone, F.col("__item") == F.col("__gone"), "left_anti").groupBy("bundle_id").agg(F.array_sort(F.collect_list("__item")).alias(items))
    cleaned = bundles.select("bundle_id").join(kept, "bundle_id", "left").withColumn(items, F.coalesce(items, F.array().cast(bundles.schema[items].dataType)))
    found = ids.select(key).distinct().join(stored.select(key, F.lit(True).alias("__there")).distinct(), key, "left")
    report = found.select(key, F.when(F.col("__there"), "ROLLEDBACK").otherwise("MISSING").alias("status"))
    return left, cleaned, report


def pid_pairs(documents: DataFrame, known: DataFrame, fresh: Column) -> DataFrame:
    """documents (pid_v2, previous_pid) with pid_v3: that known for the previous pid, else for pid_v2, else a fresh one."""
    first = known.groupBy("v2").agg(F.min("v3").alias("v3"))
    # ids repeat little, so none is counted as hot, for which documents would be parsed once more; those without one are dealt
    n, out = shared.tasks(documents, lookups.ROWS), documents
    for key, mark in (("previous_pid", "a"), ("pid_v2", "b")):
        out = lookups.looked_up(out, F.col(key), first.select(F.col("v2").alias(f"__{mark}"), F.col("v3").alias(f"__v{mark}")), f"__{mark}", n, [])
    return out.withColumn("pid_v3", F.coalesce("__va", "__vb", fresh)).withColumn("is_new", F.coalesce("__va", "__vb").isNull()).drop("__va", "__vb")
