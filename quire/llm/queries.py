"""The queries of the operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, centroids, language, licenses, lines, packing, simhash, tokenfiles, topk, toxicity, vectors, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents"))
    return out.withColumn("notice_licenses", F.array_join("notice_licenses", ","))


def held_out():
    return F.coalesce(language.remainder(F.col("doc_id")) == 1, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.identify_languages(docs.select("doc_id", "text"), docs.where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    # pages have no capture time: one second per page_id
    pages = pages.withColumn("captured", F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod("page_id", F.lit(1_000_000_000))))
    out = warc.archive(pages)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "index_part", "index_pos")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.toxicity(docs.select("doc_id", "text"), docs.where(~held_out()), labels.where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.7).cast("int").alias("predicted"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    first = (op1_license_scan, op2_language_id, op3_packing, op4_topk, op5_embedding_dedup, op6_warc, op7_byte_bpe, op8_toxicity, op9_line_dedup, op10_simhash)
    return {f.__name__: f for f in (*first, op11_filter_audit, op12_token_files, op13_centroids)}


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": licenses.oracle(), "op4_topk": OP4_SQL, "op9_line_dedup": lines.ORACLE, "op11_filter_audit": audit.ORACLE, "op13_centroids": centroids.oracle()}
