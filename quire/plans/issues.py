"""Issues, bundles, dates and guarded attributes, on orders as issues and customers as journals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks as C
from ..functions import dates as D
from ..functions import ids as I
from .registry import query, table

ISSUES = """(SELECT o_orderkey, printf('%04d-%04d', o_custkey // 10000, o_custkey % 10000) AS issn, CAST(year(o_orderdate) AS VARCHAR) AS year,
  CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN '00' ELSE printf('%03d', o_orderkey % 40) END AS volume,
  CASE WHEN o_orderkey % 5 = 0 THEN 'ahead' WHEN o_orderkey % 3 = 0 THEN '' ELSE printf('%02d', o_orderkey % 12) END AS number,
  CASE WHEN o_orderkey % 13 = 0 THEN '01' WHEN o_orderkey % 17 = 0 THEN '0' ELSE '' END AS supplement FROM orders)"""


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as issue rows, with empty, zero, padded and `ahead` parts among them."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.format_string("%04d-%04d", F.floor(c / 10000), c % 10000).alias("issn"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(k % 7 == 0, "").when(k % 11 == 0, "00").otherwise(F.format_string("%03d", k % 40)).alias("volume"),
        F.when(k % 5 == 0, "ahead").when(k % 3 == 0, "").otherwise(F.format_string("%02d", k % 12)).alias("number"),
        F.when(k % 13 == 0, "01").when(k % 17 == 0, "0").otherwise("").alias("supplement"),
    )


UNPADDED = "CASE WHEN regexp_full_match({x}, '[0-9]+') THEN nullif(ltrim({x}, '0'), '') ELSE nullif({x}, '') END"
VN = f"SELECT *, CASE WHEN number <> 'ahead' THEN {UNPADDED.format(x='volume')} END AS v, CASE WHEN number <> 'ahead' THEN {UNPADDED.format(x='number')} END AS n FROM {ISSUES}"


@query(f"SELECT o_orderkey, v AS volume, n AS number FROM ({VN})")
def normalize_volume_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues(spark, sf_dir).select("o_orderkey", I.volume_and_number(F.col("volume"), F.col("number")).alias("x")).select("o_orderkey", "x.volume", "x.number")


ID = "concat_ws('-', issn, nullif(year, ''), 'v' || v, 'n' || n, 's' || CASE WHEN supplement = '' THEN NULL WHEN ltrim(supplement, '0') = '' THEN '0' ELSE ltrim(supplement, '0') END)"


@query(f"SELECT o_orderkey, CASE WHEN v IS NOT NULL OR n IS NOT NULL THEN {ID} END AS issue_id FROM ({VN})")
def issue_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues(spark, sf_dir).select("o_orderkey", I.issue_id(*[F.col(c) for c in ("issn", "year", "volume", "number", "supplement")]).alias("issue_id"))


@query(f"SELECT CASE WHEN v IS NOT NULL OR n IS NOT NULL THEN {ID} ELSE issn || '-aop' END AS bundle_id, count(*) AS n_documents FROM ({VN}) GROUP BY 1")
def bundle_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = issues(spark, sf_dir)
    return rows.groupBy(I.bundle_id(*[F.col(c) for c in ("issn", "year", "volume", "number", "supplement")]).alias("bundle_id")).agg(F.count(F.lit(1)).alias("n_documents"))


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Special Issue' WHEN 1 THEN o_orderkey % 10 || ' Suppl 2' WHEN 2 THEN o_orderkey % 20 || ' sup' WHEN 3 THEN 'especial 3' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS label FROM orders),
w AS (SELECT *, list_transform(list_filter(string_split(label, ' '), lambda x: x <> ''), lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN CASE WHEN len(x) < 2 THEN '0' || x ELSE x END WHEN contains(lower(x), 'spe') THEN 'spe' WHEN contains(lower(x), 'sup') THEN 's' ELSE lower(x) END) AS p FROM t),
g AS (SELECT *, replace(replace(array_to_string(p, '-'), 'spe-', 'spe'), 's-', 's') AS g FROM w),
m AS (SELECT *, regexp_extract(lower(label), '(sup\\S*.*)$', 1) AS mark FROM g)
SELECT o_orderkey, label, CASE WHEN ends_with(g, 's') THEN g || '0' ELSE g END AS token,
  nullif(regexp_replace(regexp_replace(lower(label), 'sup.*$', ''), '\\s+', '', 'g'), '') AS number,
  CASE WHEN mark <> '' THEN CASE WHEN NOT contains(trim(mark), ' ') THEN '0' ELSE string_split(trim(mark), ' ')[-1] END END AS supplement FROM m""")
def issue_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    label = F.when(k % 5 == 0, "Special Issue").when(k % 5 == 1, F.concat((k % 10).cast("string"), F.lit(" Suppl 2"))).when(k % 5 == 2, F.concat((k % 20).cast("string"), F.lit(" sup"))).when(k % 5 == 3, "especial 3").otherwise((k % 100).cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"))
    x = F.col("label")
    return rows.select("o_orderkey", "label", I.issue_token(x).alias("token"), I.issue_number(x).alias("number"), I.issue_supplement(x).alias("supplement"))


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m00') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE 'n.d.' END AS said FROM orders),
p AS (SELECT *, CASE WHEN regexp_full_match(said, '\\d{8}') THEN [said[1:4], said[5:6], said[7:8]] ELSE string_split(said, '-') END AS p FROM t)
SELECT o_orderkey, CASE WHEN said <> 'n.d.' THEN p[1] END AS year, CASE WHEN said <> 'n.d.' THEN coalesce(p[2], '') END AS month, CASE WHEN said <> 'n.d.' THEN CASE WHEN coalesce(p[3], '00') = '00' THEN '' ELSE p[3] END END AS day FROM p""")
def partial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    said = F.when(k % 4 == 0, F.date_format(d, "yyyyMM'00'")).when(k % 4 == 1, F.date_format(d, "yyyy-MM-dd")).when(k % 4 == 2, F.date_format(d, "yyyy")).otherwise("n.d.")
    return table(spark, sf_dir, "orders").select("o_orderkey", D.partial_date(said).alias("d")).select("o_orderkey", "d.year", "d.month", "d.day")


@query("""
SELECT o_orderkey, strftime(CASE o_orderkey % 5 WHEN 0 THEN o_orderdate WHEN 1 THEN date_trunc('month', o_orderdate) WHEN 2 THEN date_trunc('year', o_orderdate) WHEN 3 THEN date_trunc('month', o_orderdate) ELSE date_trunc('year', o_orderdate) END, '%Y-%m-%dT00:00:00.000000Z') AS parsed FROM orders""")
def parse_date_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    said = F.when(k % 5 == 0, F.date_format(d, "yyyy-MMM-dd")).when(k % 5 == 1, F.date_format(d, "yyyy-M")).when(k % 5 == 2, F.date_format(d, "yyyy")).when(k % 5 == 3, F.date_format(d, "yyyy-MM-'40'")).otherwise(F.date_format(d, "yyyy-'30'-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", D.parse_date(said).alias("parsed"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 100000 > 0 THEN printf('%05d', o_orderkey % 100000) WHEN o_orderkey % 100 > 0 THEN printf('%05d', o_orderkey % 100) WHEN o_custkey % 1000 > 0 THEN printf('%05d', o_custkey % 1000) END AS ord
FROM orders""")
def order_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    pid = F.when(k % 3 == 0, F.concat(F.lit("S0000-000020200000"), F.format_string("%05d", k % 100000)))
    return table(spark, sf_dir, "orders").select("o_orderkey", I.order_of(pid, (k % 100).cast("string"), (F.col("o_custkey") % 1000).cast("string")).alias("ord"))


@query("""
WITH c AS (SELECT c_custkey, printf('%04d-%04d', c_custkey // 10000, c_custkey % 10000) AS e, CASE WHEN c_custkey % 4 = 0 THEN printf('%04d-%04d', c_custkey // 10000, c_custkey % 10000) WHEN c_custkey % 4 = 1 THEN '12345678' ELSE printf('9%03d-%04d', c_custkey // 10000, c_custkey % 10000) END AS p, c_custkey % 9 = 0 AS odd FROM customer)
SELECT c_custkey, NOT odd AND e <> p AND len(e) = 9 AND len(p) = 9 AND e[5] = '-' AND p[5] = '-' AS valid FROM c""")
def issn_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    e = F.format_string("%04d-%04d", F.floor(k / 10000), k % 10000)
    p = F.when(k % 4 == 0, e).when(k % 4 == 1, "12345678").otherwise(F.format_string("9%03d-%04d", F.floor(k / 10000), k % 10000))
    issns = F.when(k % 9 == 0, F.create_map(F.lit("epub"), e, F.lit("other"), p)).otherwise(F.create_map(F.lit("epub"), e, F.lit("ppub"), p))
    return table(spark, sf_dir, "customer").select("c_custkey", C.valid_issns(issns).alias("valid"))


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN '' ELSE 'xyz' END AS cur, CASE o_orderkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'pt' WHEN 2 THEN 'long' ELSE '' END AS new FROM orders),
d AS (SELECT *, CASE WHEN cur = new THEN 'same' WHEN len(cur) = 2 THEN 'kept' WHEN len(new) <> 2 THEN 'invalid' ELSE 'update' END AS decision FROM t)
SELECT o_orderkey, CASE WHEN decision = 'update' THEN new ELSE cur END AS value, decision FROM d""")
def guarded_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    cur = F.when(k % 3 == 0, "en").when(k % 3 == 1, "").otherwise("xyz")
    new = F.when(k % 4 == 0, "en").when(k % 4 == 1, "pt").when(k % 4 == 2, "long").otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.guarded_update("language", cur, new).alias("u")).select("o_orderkey", "u.value", "u.decision")


@query("""
WITH t AS (SELECT o_orderkey, printf('%04d-%04d', o_custkey // 10000, o_custkey % 10000) AS issn, 'v' || o_custkey % 50 AS acron, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey % 40 AS VARCHAR) ELSE '' END AS v, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 9 AS VARCHAR) ELSE '' END AS n FROM orders)
SELECT o_orderkey, CASE WHEN v = '' AND n = '' THEN concat_ws('-', issn, acron, 'ahead', '2020', 'a-' || o_orderkey) ELSE concat_ws('-', issn, acron, nullif(v, ''), nullif(n, ''), CAST(o_orderkey AS VARCHAR)) END AS name FROM t""")
def package_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    v, n = F.when(k % 6 != 0, (k % 40).cast("string")).otherwise(""), F.when(k % 4 != 0, (k % 9).cast("string")).otherwise("")
    name = I.package_name(F.format_string("%04d-%04d", F.floor(c / 10000), c % 10000), F.concat(F.lit("v"), (c % 50).cast("string")), v, n, k.cast("string"), F.lit("2020"), F.concat(F.lit("10.1/a."), k.cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))


@query("SELECT doc_id, 'files/' || sha1(text) || '.txt' AS key FROM documents")
def content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", I.content_key(F.lit("files"), F.col("text"), F.lit(".txt")).alias("key"))


@query(f"""
WITH RECURSIVE u AS (SELECT doc_id, md5(CAST(doc_id AS VARCHAR)) AS h, md5_number(CAST(doc_id AS VARCHAR)) AS x FROM documents),
n AS (SELECT doc_id, h, CAST(('0x' || h[1:16]) AS UBIGINT)::UHUGEINT * 18446744073709551616::UHUGEINT + CAST(('0x' || h[17:32]) AS UBIGINT)::UHUGEINT AS v, '' AS s, 0 AS i FROM u
  UNION ALL SELECT doc_id, h, v // 48, s || '{I.DIGITS}'[CAST(v % 48 AS INTEGER) + 1], i + 1 FROM n WHERE i < 23)
SELECT doc_id, s AS id, true AS back FROM n WHERE i = 23""")
def base48_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document id of 23 places from 128 bits, and whether it leads back to them."""
    given = F.regexp_replace(F.md5(F.col("doc_id").cast("string")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    rows = table(spark, sf_dir, "documents").select("doc_id", given.alias("u")).withColumn("id", I.base48("u"))
    return rows.select("doc_id", "id", (I.base48_uuid("id") == F.col("u")).alias("back"))
