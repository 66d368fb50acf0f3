"""Groups, ordinals and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def items_per_group(rows: DataFrame, group: str, item: list[str], last: str, order: Column) -> DataFrame:
    """Per group its sorted items (structs) and the last row's value of one column, by a total order.

    For groups that are one record when written, such as an issue with its documents.
    """
    return rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*item))).alias("items"), F.max_by(last, order).alias(last))


def first_wins(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key, the first by order, found by an aggregate (partial before the shuffle), not by a window."""
    rest = [c for c in rows.columns if c not in keys]
    packed = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return packed.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def occurrences(rows: DataFrame, message: Column, line: str, file: str, length: int = 80) -> DataFrame:
    """(message, file, line) of every row, messages cut to their first `length` characters: the lines behind a summary."""
    return rows.select(F.substring(message, 1, length).alias("message"), F.col(file).alias("file"), F.col(line).alias("line"))


def summary(rows: DataFrame, message: Column, line: str, file: str, length: int = 80) -> DataFrame:
    """Per message and file the number of rows and their first and last line.

    A message may be most of a table, so its lines aren't gathered; occurrences() has them as rows.
    """
    out = occurrences(rows, message, line, file, length).groupBy("message", "file")
    return out.agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first_line"), F.max("line").alias("last_line"))


def most_frequent(counted: DataFrame, key: str, n: str, limit: int) -> DataFrame:
    """The `limit` keys with the largest n, ties to the smaller key, with their rank: a top-k, no sort of the whole."""
    top = counted.groupBy(key).agg(F.sum(n).alias(n)).orderBy(F.desc(n), key).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(n), key)))  # of the limit's rows


def merge(rows: DataFrame, key: str, sums: list[str], lists: list[str]) -> DataFrame:
    """Rows of one key merged: numbers add up, and of lists the joined list's length (merged_items has its items)."""
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums], *[F.sum(F.size(F.coalesce(F.col(c), F.array()))).alias(f"n_{c}") for c in lists])


def merged_items(rows: DataFrame, key: str, items: str) -> DataFrame:
    """(key, item) of all lists of a key: the joined list as rows, of any length."""
    return rows.select(key, F.explode(items).alias("item"))


def repeated(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy(value).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def consecutive(rows: DataFrame, partition: list[str], order: list[str], n: int, value: str) -> DataFrame:
    """Runs of n rows of a partition in order, as arrays of a value; an incomplete last run goes."""
    at = F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1
    placed = rows.withColumn("__at", at).withColumn("run", F.floor(F.col("__at") / n))
    runs = placed.groupBy(*partition, "run").agg(F.array_sort(F.collect_list(F.struct("__at", value))).alias("__items")).where(F.size("__items") == n)
    return runs.select(*partition, "run", F.transform("__items", lambda x: x[value]).alias("items"))


def placed(rows: DataFrame, group: str, order: Column, reverse: Column, tie: Column) -> DataFrame:
    """rows with position, from 1, in their group's order, or in the reverse order where the group says so; ties by `tie`."""
    up, down = F.when(~reverse, order), F.when(reverse, order)
    w = Window.partitionBy(group).orderBy(up.asc_nulls_last(), down.desc_nulls_last(), tie)
    return rows.withColumn("position", F.row_number().over(w))


def page(rows: DataFrame, order: list[Column], number: int, size: int = 20) -> DataFrame:
    """Page `number` (from 1) of rows in a total order: a top-k, no sort of the whole."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def islands(rows: DataFrame, partition: list[str], order: str, kind: str) -> DataFrame:
    """Consecutive rows of the same kind as one: (partition, kind, first, last, n)."""
    w = Window.partitionBy(*partition).orderBy(order)
    new = F.when(F.lag(kind).over(w).eqNullSafe(F.col(kind)), 0).otherwise(1)
    marked = rows.withColumn("__new", new).withColumn("island", F.sum("__new").over(w))
    return marked.groupBy(*partition, "island", kind).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def checked_unique(rows: DataFrame, key: str) -> DataFrame:
    """Keys that several rows have, for an error report in place of an exception."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key, "n", F.lit("duplicate id").alias("error"))
