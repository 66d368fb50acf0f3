"""Results that are worked out anew only for keys whose input has changed.

A ledger keeps the digest of each key's input. A run compares digests, computes what is new, changed or asked for, and adds
results and ledger rows of those keys in one commit; what stays is neither read nor written. Results of a key are those
of its last version; a key that is gone from the input has a ledger row without a digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import snapshots


def digests(rows: DataFrame, key: str, content: list[str]) -> DataFrame:
    """(key, digest): one digest for all rows of a key whatever their order, from those of its rows; rows without a key go.

    Rows leave each task as two sums of hashes and a count, so a key with most of the rows is many tasks' work.
    """
    parts = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    half = lambda at: F.sum(F.conv(F.substring(parts, at, 15), 16, 10).cast("decimal(38,0)"))
    sums = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*[half(1 + 15 * i).alias(f"s{i}") for i in range(4)], F.count(F.lit(1)).alias("n"))
    return sums.select(key, F.sha2(F.concat_ws("-", "s0", "s1", "s2", "s3", F.col("n")), 256).alias("digest"))


def current(ledger: DataFrame, key: str) -> DataFrame:
    """(key, digest, version): the last of each key's ledger rows, those of keys that are gone left out."""
    return ledger.groupBy(key).agg(F.max_by(F.struct("digest", "version"), "version").alias("r")).select(key, "r.*").where("digest is not null")


def refresh(spark: SparkSession, root: str, inputs: DataFrame, key: str, content: list[str], compute: Callable[[DataFrame], DataFrame], schema: str, override: Column | None = None) -> tuple[int, int]:
    """Bring the results at root (of `schema`, key included) up to date with inputs; (keys computed, keys gone).

    compute gets the input rows of the keys that are new, have another digest, or for which `override` holds, and
    returns their results. A run that finds nothing to do commits nothing; one that is broken off leaves all as it was.
    """
    kind = inputs.schema[key].dataType.simpleString()
    known = current(snapshots.read(spark, root, "ledger", f"`{key}` {kind}, digest string, version long"), key).select(key, F.col("digest").alias("__known"))
    commit = snapshots.Commit(spark, root)
    version = F.lit(commit.base + 1).cast("long")
    both = digests(inputs, key, content).join(known, key, "full")
    stale = ~F.col("digest").eqNullSafe(F.col("__known"))
    if override is not None:
        stale = stale | (F.coalesce(override, F.lit(False)) & F.col("digest").isNotNull())
    written = commit.write("ledger", both.where(stale).select(key, "digest", version.alias("version")))
    counts = written.agg(F.count("digest").alias("computed"), F.count_if(F.col("digest").isNull()).alias("gone")).first()
    if counts["computed"]:
        rows = compute(inputs.join(written.where("digest is not null").select(key), key, "left_semi"))
        commit.write("results", rows.withColumn("__version", version))
    if counts["computed"] or counts["gone"]:
        commit.publish()
    return counts["computed"], counts["gone"]


def results(spark: SparkSession, root: str, key: str, schema: str) -> DataFrame:
    """The results of all keys as they are now, with the version that has computed them."""
    rows = snapshots.read(spark, root, "results", f"{schema}, __version long")
    kind = rows.schema[key].dataType.simpleString()
    last = current(snapshots.read(spark, root, "ledger", f"`{key}` {kind}, digest string, version long"), key)
    return rows.join(last.select(key, F.col("version").alias("__version")), [key, "__version"]).withColumnRenamed("__version", "version")
