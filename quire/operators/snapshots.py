"""Tables that change together: data files first, one small manifest last, and readers that follow the manifest.

A store is a folder. A commit writes each table's new rows to a folder of their own, which no reader knows yet, and then the
manifest of the next version, which names all folders of all tables. The manifest is one file that its writer's commit
renames into place, so a reader sees all of a commit or nothing; what a broken run has written stays unseen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "table string, folder string, version long"


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(table, folder, version) of a version, the last if None; no row where there is none. One row per table and commit."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/manifests/*")
    except AnalysisException as e:  # nothing is committed yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    return rows.where(F.col("version") == version)


def last_version(spark: SparkSession, root: str) -> int:
    """The number of the last commit, 0 before the first."""
    return manifest(spark, root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read(spark: SparkSession, root: str, table: str, schema: str, version: int | None = None) -> DataFrame:
    """A table of the store in a version, the last if None; no row of `schema` before its first commit."""
    folders = [r["folder"] for r in manifest(spark, root, version).where(F.col("table") == table).collect()]  # a commit's each
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


class Commit:
    """Writes that become visible together, by publish(); all of them are lost if it is never called."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.base = spark, root, last_version(spark, root)
        self.added: list[tuple[str, str]] = []
        self.replaced: set[str] = set()

    def write(self, table: str, rows: DataFrame, replace: bool = False) -> DataFrame:
        """Write rows for a table, beside those it has or in their place; the rows as read back."""
        folder = f"data/{table}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        self.added.append((table, folder))
        if replace:
            self.replaced.add(table)
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}")

    def publish(self) -> int:
        """Make all writes visible; the new version. A version that another commit has taken meanwhile is an error."""
        kept = [(r["table"], r["folder"]) for r in manifest(self.spark, self.root).collect() if r["table"] not in self.replaced] if self.base else []
        version = self.base + 1
        rows = self.spark.createDataFrame([(t, f, version) for t, f in [*kept, *self.added]], MANIFEST).coalesce(1)
        rows.write.mode("errorifexists").json(f"{self.root}/manifests/{version:012d}")
        return version


def committed(spark: SparkSession, root: str, work: Callable[[Commit], bool]) -> int:
    """Run work on a commit and publish it if it returns true; the last version then."""
    commit = Commit(spark, root)
    return commit.publish() if work(commit) else commit.base
