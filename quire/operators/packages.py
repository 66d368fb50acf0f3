"""Packages of a document's files, and documents in their bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids as I
from . import groups, lookups


def route(assets: DataFrame, package: str, found: str, wanted: str) -> DataFrame:
    """(package, n_assets, missing, complete): where a package goes, with the sorted names of the files it lacks."""
    lacking = F.array_sort(F.collect_set(F.when(F.col(found).isNull(), F.col(wanted))))
    return assets.groupBy(package).agg(F.count(F.lit(1)).alias("n_assets"), lacking.alias("missing")).withColumn("complete", F.size("missing") == 0)


def journals_with_issues(journals: DataFrame, issues: DataFrame) -> DataFrame:
    """(journal_id, issues): the sorted issues (id, order) of each journal (id, issns) that share an ISSN with it.

    Of issues that repeat an id the first by order counts.
    """
    pairs = lookups.overlap_join(journals.withColumnRenamed("id", "journal_id"), issues.withColumnRenamed("id", "issue_id"), "journal_id", "issns", "issue_id", "issns")
    first = groups.first_wins(issues.select("id", "order"), ["id"], F.col("order"))
    return pairs.join(first.withColumnRenamed("id", "issue_id"), "issue_id").groupBy("journal_id").agg(F.array_sort(F.collect_list(F.struct("order", F.col("issue_id").alias("id")))).alias("issues"))


def documents_in_bundles(documents: DataFrame, journals: DataFrame, bundles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, failures) of documents (pid, eissn, pissn, issn, year, volume, number, supplement).

    members: (bundle_id, is_new, items). A document without a known journal fails, and one of an issue that isn't
    stored; articles ahead of print get their journal's ahead bundle, a new one if need be.
    """
    resolved = lookups.resolve_first(documents, ["eissn", "pissn", "issn"], journals.withColumnRenamed("id", "journal_id"), "code", "journal_id")
    parts = [F.col(c) for c in ("year", "volume", "number", "supplement")]
    issue = I.issue_id(F.col("journal_id"), *parts)
    placed = resolved.withColumn("bundle_id", F.coalesce(issue, I.ahead_id(F.col("journal_id")))).withColumn("is_issue", issue.isNotNull())
    known = placed.join(bundles.select("bundle_id", F.lit(True).alias("stored")).distinct(), "bundle_id", "left")
    error = F.when(F.col("journal_id").isNull(), "no journal").when(F.col("is_issue") & F.col("stored").isNull(), "no issue")
    known = known.withColumn("error", error)
    members = known.where("error is null").groupBy("bundle_id").agg(F.first(F.col("stored").isNull()).alias("is_new"), F.array_sort(F.collect_list("pid")).alias("items"))
    return members, known.where("error is not null").select("pid", "error")
