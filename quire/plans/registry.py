"""Queries of the plans by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, joined: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows.

    joined: array columns that leave both as text, elements between commas, so that rows compare as plain values.
    """

    def add(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c in joined})

        QUERIES[f.__name__] = run if joined else f
        if sql:
            changed = ", ".join(f"array_to_string({c}, ',') AS {c}" for c in joined)
            SQL[f.__name__] = f"SELECT * REPLACE ({changed}) FROM ({sql})" if joined else sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
