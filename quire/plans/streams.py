"""Streams over the events table, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import shared
from ..streaming import ingest as S
from ..streaming import sorting
from .registry import query

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; its folder is watched, other tables in it are not read."""
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_id, event_type, user_id FROM events")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ingested twice from the same files: the second run adds none."""
    folder = shared.folder(spark, "stream")
    for run in ("first", "second"):
        rows = arriving(spark, sf_dir).select("event_id", "event_type", "user_id")
        S.ingest_once(rows, f"{folder}/table", f"{folder}/{run}", "event_id")
    return spark.read.parquet(f"{folder}/table").drop("key_part")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and type, counted as a stream without duplicates."""
    folder = shared.folder(spark, "stream")
    counted = S.counts_by_window(S.without_duplicates(arriving(spark, sf_dir), "event_id", "ts", "60 days"), "ts", "event_type")
    name = "table"
    def keep(batch: DataFrame, number: int) -> None:
        # each batch has the counts that changed, whole: the last of a window and type is the one that counts
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{folder}/{name}")

    run = counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/counts").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/{name}").groupBy(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type").agg(F.max_by("n", "batch").alias("n"))


ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS bundle, CAST(o_orderkey AS VARCHAR) AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_custkey % 2 = 0 THEN -d ELSE d END, CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END, CAST(o_orderkey AS VARCHAR) DESC)::INT AS place
FROM (SELECT o_orderkey, o_custkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS d FROM orders)""")
def bundle_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as bundles kept in order while they arrive, every other one from the last on."""
    folder = shared.folder(spark, "stream")
    rows = spark.readStream.schema(ORDERS).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    rows = rows.select(F.col("o_custkey").alias("bundle"), F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyyMMdd").alias("position"))
    sorting.keep_sorted(rows, f"{folder}/rows", f"{folder}/state")
    return sorting.current(spark.read.parquet(f"{folder}/rows"), F.col("bundle").cast("long") % 2 == 0).select("bundle", "id", "place")
