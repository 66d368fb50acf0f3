"""The stores as streams: files that arrive are read once, duplicates refused, errors counted by time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def without_duplicates(rows: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """Each key once while its first row is within delay of the latest time: the state stays bounded."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(rows: DataFrame, time: str, kind: str, window: str = "1 day") -> DataFrame:
    """Rows (with a watermark on time) by window and kind; a window is final once the watermark has passed it."""
    counted = rows.groupBy(F.window(time, window), kind).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), kind, "n")


def ingest_once(rows: DataFrame, target: str, checkpoint: str, key: str, parts: int = 64) -> StreamingQuery:
    """Append all that has arrived to the table at target, but for keys that it holds already; then stop.

    The table is partitioned by a hash of the key (key_part), so a batch reads the keys of its own parts only. A batch
    that is repeated after a failure finds its own rows and adds none.
    """

    def insert(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c != key]
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
        first = batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*").withColumn("key_part", part)
        touched = [r[0] for r in batch.select(part).distinct().collect()]  # at most `parts` numbers
        try:
            held = spark.read.parquet(target).where(F.col("key_part").isin(touched)).select(key)
            first = first.join(held, key, "left_anti")
        except AnalysisException as e:  # the first batch: there is no table yet
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        first.repartition("key_part").write.mode("append").partitionBy("key_part").parquet(target)

    query = rows.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
