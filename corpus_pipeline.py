"""A training-data pipeline over `documents`: each stage filters, cleans or packs what its predecessor kept.

All stages but the last return the columns of documents, whatever further ones there are and whatever their names. Null
ids stay; a null or empty text scores as one without a word, has no known language and goes there; repeated rows are rows
of their own until the near duplicates, of which one document stays; very long texts are taken whole. An empty table
passes through all stages and gives no piece.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import language, lines, packing, simhash, toxicity
from quire.llm.storage import fresh_path

TOXIC = 0.7
#: Near duplicates: shingles of so many words, their least Jaccard, and the bits in which word fingerprints of such texts may differ.
WORDS, JACCARD, REACH = 5, 0.8, 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Columns that operators add to a stage's documents, for a while.
ADDED = ("tox_score", "lang_pred", "lang_score", "lang_rejected", "lines_dropped")


def columns_apart(stage: Stage) -> Stage:
    """stage with columns of documents that have names of the operators' own under other names meanwhile."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"kept {i}" for i, c in enumerate(docs.columns) if c in ADDED or c.startswith("__")}
        out = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])

    return run


@columns_apart
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that score under TOXIC; the model learns from the labels of all of `documents` that it may see."""
    return toxicity.toxicity(docs, docs, table(spark, sf_dir, "labels")).where(F.col("tox_score") < TOXIC).drop("tox_score")


@columns_apart
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs whose language is recognised with calibrated confidence; lang stays as it was."""
    return language.identify_languages(docs, docs).where(~F.col("lang_rejected"))


@columns_apart
def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without lines that are boilerplate in their source; n_chars counts what is left."""
    cleaned = lines.drop_boilerplate(docs)
    changed = F.when(F.col("lines_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))


@columns_apart
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: those whose shingles of five words have a Jaccard of 0.8 and more."""
    return simhash.one_of_each(docs, words=WORDS, reach=REACH, jaccard=JACCARD)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("language", known_language), ("line_dedup", without_boilerplate), ("near_duplicates", one_of_each), ("packing", packed)]
#: Two of the stages are trained models and one is a tokenizer: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
