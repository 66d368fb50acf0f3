"""Funnels, log analysis, availability and package reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports as P
from .registry import query, table

#: What each kind of line (event_id % 12) says; {f}, {x}, {p} and {d} stand for a file, an XML file, an id and a package.
MESSAGES = [
    "[{p}] - Could not find asset '{f}' during packing XML '{x}'.",
    "[{p}] - COULD NOT FIND RENDITION '{f}' during packing XML '{x}'",
    "Could not update xml '{x}'. The exception 'no element found' was raised.",
    "Could not update xml '{x}'.",
    "Could not find the XML file '{x}'.",
    'Missing "publication date" into "{x}"',
    "An error: [Errno 2] No such file or directory: '{d}/manifest.json'",
    "There is no XML file into package '{d}'. Please verify and try later.",
    "Could not parse the '{x}' file, please validate this file before then try to import again.",
    "The bundle '{d}' was not updated. During executions this following exception was raised 'x'.",
    "No ISSN in document '{p}'",
    "Could not import package '{d}'. The following exception was raised: 'unable to open'.",
]
#: What the analysis finds in each: error, group, then the fields by name.
FOUND = [
    ("resource-not-found", "renditions", {"pid": "p", "uri": "f", "xml": "x"}),
    ("resource-not-found", "renditions", {"pid": "p", "uri": "f", "xml": "x"}),
    ("xml-not-update", None, {"uri": "x", "exception": "'no element found'"}),
    ("xml-not-update", None, {"uri": "x"}),
    ("xml-not-found", None, {"uri": "x"}),
    ("missing-metadata", None, {"metadata": "'publication date'", "uri": "x"}),
    ("missing-manifest", None, {"file_path": "d || '/manifest.json'"}),
    ("xml-not-found", None, {"package_path": "d"}),
    ("xml-parser-error", None, {"file_path": "x"}),
    ("bundle-not-found", None, {"bundle": "d"}),
    ("issn-not-found", None, {"pid": "p"}),
    ("package-not-import", None, {"package_path": "d"}),
]


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines of every kind in two formats, with lines of another shape and lines that no rule fits among them."""
    k = F.col("event_id")
    values = {"f": F.concat(F.lit("img/f"), (k % 50).cast("string"), F.lit(".jpg")), "x": F.concat(F.lit("a/x"), (k % 9).cast("string"), F.lit(".xml")), "p": F.concat(F.lit("S0000-0000202000"), F.lpad((F.col("user_id") % 10000000).cast("string"), 7, "0")), "d": F.concat(F.lit("path/pkg"), (k % 9).cast("string"))}
    message = F.lit("done")
    for i, said in enumerate(MESSAGES):
        text = F.lit(said)
        for name, value in values.items():
            text = F.replace(text, F.lit("{" + name + "}"), value)
        message = F.when(k % 13 == i, text).otherwise(message)
    spaced = F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ERROR [module]  "), message)
    line = F.when(k % 2 == 1, F.concat(F.lit("ERROR;[module];"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("; "), message)).otherwise(spaced)
    return table(spark, sf_dir, "events").select(F.when(k % 10 == 0, "traceback").otherwise(line).alias("value"))


#: The formats of log_lines.
FORMATS = ("<level>;<module>;<date>T<time>; <message>", P.FORMAT)


def found_sql(column: str) -> str:
    cases = {"error": [f"'{e}'" for e, _, _ in FOUND], "error_group": [f"'{g}'" if g else "NULL" for _, g, _ in FOUND]}
    of = cases.get(column) or [fields.get(column, "NULL") for _, _, fields in FOUND]
    return f"CASE event_id % 13 {' '.join(f'WHEN {i} THEN {x}' for i, x in enumerate(of))} END"


def message_sql() -> str:
    quoted = [m.replace("'", "''") for m in MESSAGES]
    for name in "fxpd":
        quoted = [m.replace("{" + name + "}", f"' || {name} || '") for m in quoted]
    return f"CASE event_id % 13 {' '.join(f'WHEN {i} THEN {chr(39)}{m}{chr(39)}' for i, m in enumerate(quoted))} ELSE 'done' END"


PARSED = f"""(SELECT stamp, {message_sql()} AS message, {', '.join(f'{found_sql(c)} AS "{c}"' for c in ("error", "error_group", *P.FIELDS))} FROM
  (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, 'img/f' || event_id % 50 || '.jpg' AS f, 'a/x' || event_id % 9 || '.xml' AS x, 'S0000-0000202000' || lpad(CAST(user_id % 10000000 AS VARCHAR), 7, '0') AS p, 'path/pkg' || event_id % 9 AS d FROM events WHERE event_id % 10 <> 0))"""


@query(f"SELECT stamp[1:10] AS date, stamp[12:19] AS time, 'ERROR' AS level, '[module]' AS module, * EXCLUDE (stamp) FROM {PARSED}")
def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_lines(log_lines(spark, sf_dir), formats=FORMATS)


@query(f'SELECT pid, error, error_group, list_sort(coalesce(list_distinct(list(uri) FILTER (WHERE uri IS NOT NULL)), [])) AS uris, count(*) AS n, max(stamp) AS last FROM {PARSED} WHERE error IS NOT NULL AND pid IS NOT NULL GROUP BY 1, 2, 3', joined=("uris",))
def log_errors_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.errors_by_pid(P.parse_lines(log_lines(spark, sf_dir), formats=FORMATS))


@query(f"SELECT stamp[1:10] AS date, stamp[12:19] AS time, 'ERROR' AS level, error, {', '.join(f for f in P.FIELDS if f != 'pid')} FROM {PARSED} WHERE error IS NOT NULL AND pid IS NULL")
def log_errors_without_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.errors_without_pid(P.parse_lines(log_lines(spark, sf_dir), formats=FORMATS))


@query(f"SELECT coalesce(error, 'none') AS error, count(*) AS n, count(DISTINCT pid) AS n_pids FROM {PARSED} GROUP BY 1")
def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.parse_lines(log_lines(spark, sf_dir), formats=FORMATS)
    return rows.groupBy(F.coalesce("error", F.lit("none")).alias("error")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("pid").alias("n_pids"))


@query("""
SELECT 'ERROR [module] No ISSN in document ' || chr(39) || lpad(CAST(event_id AS VARCHAR), 23, 'x') || chr(39) AS line, lpad(CAST(event_id AS VARCHAR), 23, 'x') AS pid FROM events WHERE event_type = 'error'
UNION ALL SELECT 'ERROR [module] other', NULL FROM events WHERE event_type = 'click'""")
def linking_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.concat(F.lit("ERROR [module] No ISSN in document '"), F.lpad(F.col("event_id").cast("string"), 23, "x"), F.lit("' "))
    line = F.when(F.col("event_type") == "error", missing).when(F.col("event_type") == "click", "ERROR [module] other").otherwise("INFO done")
    return P.linking_errors(table(spark, sf_dir, "events").select(line.alias("value")))


@query("""
SELECT DISTINCT 'S' || o_custkey AS pid, 'converted' AS stage FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT DISTINCT 'S' || o_custkey, 'packaged' FROM orders""")
def ids_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids among converted file names (id.lang.xml) and packages (id_zips)."""
    rows = table(spark, sf_dir, "orders")
    names = rows.select(F.concat(F.lit("S"), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".pt.xml").otherwise(".pt.html")).alias("name"))
    folders = rows.select(F.concat(F.lit("S"), F.col("o_custkey").cast("string"), F.lit("_zips")).alias("name"))
    return P.known_ids(names, "name", ending=".xml").withColumn("stage", F.lit("converted")).unionByName(P.known_ids(folders, "name", "_").withColumn("stage", F.lit("packaged")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def not_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query("""
WITH s AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders), c AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), p AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R'), i AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'F')
SELECT year, count(*) AS source, count(c.k) AS converted, count(CASE WHEN c.k IS NOT NULL THEN p.k END) AS packed, count(CASE WHEN c.k IS NOT NULL AND p.k IS NOT NULL THEN i.k END) AS imported FROM s LEFT JOIN c USING (k) LEFT JOIN p USING (k) LEFT JOIN i USING (k) GROUP BY 1""")
def funnel_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "k")
    source = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("year"))
    return P.funnel({"source": source, "converted": items, "packed": items.where("l_returnflag = 'R'"), "imported": items.where("l_linestatus = 'F'")}, "k", "year")


@query("""
SELECT coalesce(o.k, l.k) AS k, CASE WHEN o.k IS NULL THEN 'right' WHEN l.k IS NULL THEN 'left' ELSE 'both' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders) o FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) l ON o.k = l.k""")
def side_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.sides(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), "k")


@query("""
SELECT 'P' || user_id AS pid, CASE event_id % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'pdf' ELSE 'other' END AS kind, count(*) AS n FROM events WHERE event_type = 'error' AND event_id % 3 < 2 GROUP BY 1, 2
UNION ALL SELECT NULL, 'other', count(*) FROM events WHERE event_type = 'error' AND event_id % 3 = 2 HAVING count(*) > 0""")
def packing_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, u = F.col("event_id"), F.col("user_id").cast("string")
    payload = F.when(k % 3 == 0, F.concat(F.lit("{'pid': 'P"), u, F.lit("', 'img': 'a.jpg'}"))).when(k % 3 == 1, F.concat(F.lit("{'pid': 'P"), u, F.lit("', 'pdf': 'a.pdf'}"))).otherwise("no file")
    level = F.when(F.col("event_type") == "error", "ERROR ").otherwise("INFO ")
    lines = table(spark, sf_dir, "events").select(F.concat(level, payload).alias("value"))
    return P.packing_errors(lines).groupBy("pid", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_packages, sum(CASE WHEN l.n IS NULL THEN 1 ELSE 0 END)::BIGINT AS incomplete, CAST(coalesce(sum(l.bytes), 0) AS BIGINT) AS bytes
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS bytes FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey GROUP BY 1""")
def package_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages by year: how many, how many lack assets, and their bytes."""
    files = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("bytes"))
    rows = table(spark, sf_dir, "orders").join(files, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_packages"), F.count_if(F.col("n").isNull()).alias("incomplete"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
