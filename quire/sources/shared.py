"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder where the session keeps shared data; a temporary one only where it names none, in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = root or tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(rows: DataFrame, kind: str) -> DataFrame:
    """rows written to a shared folder and read from there: what follows doesn't work them out again."""
    path = folder(rows.sparkSession, kind)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def tasks(rows: DataFrame, each: int, total: int | None = None) -> int:
    """How many tasks of so many rows there are in rows, as many as shuffles have at least; of a table read as it is, only footers are read for it. total: their number, if known."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows.count() if total is None else total) // each))


def spread(rows: DataFrame, each: int, *keys: str) -> DataFrame:
    """rows dealt, by keys if given, over tasks of about `each` rows: their number, and not the size of one, grows with the input."""
    return rows.repartition(tasks(rows, each), *keys)
