"""References of a document and the texts of its citations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def clean_paragraphs(paragraphs: DataFrame) -> DataFrame:
    """Paragraphs (pid, ref_index, text) with an index, cleaned; of repeated indexes the last by text stays."""
    rows = paragraphs.where("ref_index is not null and pid is not null").withColumn("citation", T.clean_citation(F.col("text")))
    return rows.groupBy("pid", "ref_index").agg(F.max("citation").alias("citation"))


def with_citations(references: DataFrame, paragraphs: DataFrame, *, override: bool = False) -> DataFrame:
    """references (pid, position, mixed[, label]) with the cleaned citation of their position where mixed is missing.

    With override, a citation takes the place of a mixed that is there, too. updated says which references changed;
    those get as label the number that the citation begins with, if it is the position; other labels stay.
    """
    texts = clean_paragraphs(paragraphs)
    joined = references.join(texts, (references["pid"] == texts["pid"]) & (references["position"].cast("string") == texts["ref_index"]), "left").select(references["*"], "citation")
    updated = F.coalesce(F.col("citation") != "", F.lit(False))
    if not override:
        updated &= F.coalesce(F.col("mixed"), F.lit("")) == ""
    number = T.leading_number(F.col("citation"))
    before = F.col("label") if "label" in references.columns else F.lit(None).cast("string")
    label = F.when(F.col("updated") & (number == F.col("position").cast("string")), number).otherwise(before)
    return joined.withColumn("updated", updated).withColumn("label", label).withColumn("mixed", F.when(F.col("updated"), F.col("citation")).otherwise(F.col("mixed"))).drop("citation")
