"""Stores with several tables: imports that appear as a whole, states at a time and ways back to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import history, imports, ledger, snapshots
from ..sources import shared
from .markup import SOUND, documents_xml
from .registry import query, table
from .texts import NORMAL


@query(f"""
WITH d AS (SELECT doc_id AS k, printf('S0000-0000202000%07d', doc_id) AS v2, CASE WHEN doc_id % 2 = 0 THEN '1111-1111' ELSE '2222-2222' END AS issn,
  CASE WHEN doc_id % 7 = 0 THEN '2018' WHEN doc_id % 11 <> 3 THEN '2020' WHEN doc_id % 2 = 0 THEN '2021' END AS year FROM documents WHERE {SOUND})
SELECT CASE WHEN k % 3 = 2 THEN 'v3-' || k ELSE sha256('document ' || v2)[1:23] END AS id, CASE WHEN k % 2 = 0 THEN 'first' ELSE 'second' END AS imported, CAST(1 + k % 2 AS BIGINT) AS n_changes, v2,
  CASE WHEN k % 10 = 0 THEN 'aop-' || k END AS previous, CASE WHEN k % 4 = 0 AND k % 5 = 0 THEN issn || '-aop' ELSE concat_ws('-', issn, year, CASE WHEN k % 4 > 0 THEN 'v' || k % 4 END, CASE WHEN k % 5 > 0 THEN 'n' || k % 5 END) END AS bundle_id,
  coalesce(CASE WHEN k % 100000 BETWEEN 1 AND 99999 THEN lpad(CAST(k % 100000 AS VARCHAR), 5, '0') END, CASE WHEN k BETWEEN 1 AND 99999 THEN lpad(CAST(k AS VARCHAR), 5, '0') END) AS position, CAST(2 AS BIGINT) AS version FROM d""")
def import_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the packages imported, then all, then all again: what the store's tables have of each document."""
    root = shared.folder(spark, "store")
    k = F.col("doc_id")
    packages = documents_xml(spark, sf_dir).select(F.concat(F.lit("p"), k.cast("string")).alias("package"), "xml", (k % 2).alias("n_renditions"), "doc_id")
    for stamp, rows in (("first", packages.where(k % 2 == 0)), ("second", packages), ("third", packages)):
        imports.import_documents(spark, root, rows.drop("doc_id"), stamp)
    of = {t: snapshots.read(spark, root, t, schema) for t, schema in imports.SCHEMAS.items()}
    changes = of["changes"].groupBy("id").agg(F.count(F.lit(1)).alias("n_changes"))
    out = of["documents"].select("id", "imported").join(changes, "id", "left").join(of["pids"].withColumnRenamed("v3", "id"), "id", "left").join(of["places"], "id", "left")
    return out.withColumn("version", F.lit(snapshots.last_version(spark, root)).cast("long"))


@query(f"""
SELECT 'p' || doc_id AS package, CASE doc_id % 50 WHEN 7 THEN 'could not parse the document: not closed: article' WHEN 8 THEN 'could not parse the document: no root' ELSE 'there is no XML file in the package' END AS error FROM documents WHERE NOT ({SOUND})""")
def import_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages that an import leaves out, and why."""
    packages = documents_xml(spark, sf_dir).select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("package"), "xml", F.lit(0).alias("n_renditions"))
    _, errors = imports.import_documents(spark, shared.folder(spark, "store"), packages, "now")
    return errors.withColumn("error", F.regexp_replace("error", r"\d+: ", ""))


@query("""
WITH p AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT c.event_id, p.event_id AS last_purchase FROM (SELECT * FROM events WHERE event_type <> 'purchase') c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.ts >= p.ts""")
def store_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's last purchase at or before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    bought = F.col("event_type") == "purchase"
    out = history.as_of(events.where(~bought), events.where(bought).select("user_id", "ts", "event_id"), "user_id", "ts", "ts", "event_id", "day")
    return out.select("event_id", F.col("change.event_id").alias("last_purchase"))


@query("""
WITH m AS (SELECT date_trunc('day', min(ts) + (max(ts) - min(ts)) / 2) AS t FROM events),
w AS (SELECT user_id, value, event_type, ts <= t AS early, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n, CASE WHEN ts <= t THEN row_number() OVER (PARTITION BY user_id, ts <= t ORDER BY ts DESC, event_id DESC) END AS k FROM events, m),
a AS (SELECT user_id, value FROM w WHERE k = 1 AND event_type <> 'error'), b AS (SELECT user_id, value FROM w WHERE n = 1 AND event_type <> 'error')
SELECT user_id, a.value, CASE WHEN a.user_id IS NULL THEN 'delete' ELSE 'restore' END AS action FROM a FULL JOIN b USING (user_id)
WHERE a.value IS DISTINCT FROM b.value OR (a.user_id IS NULL) <> (b.user_id IS NULL)""")
def rollback_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What brings every user's value back to that of the middle of the time; an error deletes it."""
    log = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")
    ends = log.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(F.date_trunc("day", F.timestamp_micros(((F.unix_micros("a") + F.unix_micros("b")) / 2).cast("long"))).alias("t")).first()
    return history.roll_back_to(log, "user_id", "ts", "event_id", "value", F.lit(ends["t"]), F.col("event_type") == "error")


@query(f"""
WITH c AS (SELECT conv_id, turn, CASE WHEN conv_id % 10 = 1 THEN text || ' Changed' ELSE text END AS text FROM conversations WHERE conv_id % 10 <> 2)
SELECT conv_id, turn, {NORMAL.format(x="text")} AS normal, CAST(CASE conv_id % 10 WHEN 1 THEN 2 WHEN 3 THEN 3 ELSE 1 END AS BIGINT) AS version FROM c""")
def recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised turns of conversations, kept up to date while some change, some go, and some are asked for again."""
    root, schema = shared.folder(spark, "store"), "conv_id bigint, turn bigint, normal string"
    turns, k = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "text"), F.col("conv_id")
    changed = turns.where(k % 10 != 2).withColumn("text", F.when(k % 10 == 1, F.concat("text", F.lit(" Changed"))).otherwise(F.col("text")))
    compute = lambda rows: rows.select("conv_id", "turn", T.normalize_text(F.col("text")).alias("normal"))
    for rows, override in ((turns, None), (changed, None), (changed, k % 10 == 3), (changed, None)):
        ledger.refresh(spark, root, rows, "conv_id", ["turn", "text"], compute, schema, override)
    return ledger.results(spark, root, "conv_id", schema)
