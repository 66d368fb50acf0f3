"""Groups, ordinals, pages, records and the stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..operators import groups as G
from ..operators import store as S
from .registry import query, table


@query("""
SELECT l_orderkey, [x.p || ':' || x.n for x in list_sort(list({'p': l_partkey, 'n': l_linenumber}))] AS items, arg_max(l_linestatus, l_linenumber || l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1""", joined=("items",))
def group_items_per_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = G.items_per_group(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_partkey", "l_linenumber"], "l_linestatus", F.struct("l_linenumber", "l_linestatus"))
    return out.withColumn("items", F.transform("items", lambda x: F.concat_ws(":", x["l_partkey"].cast("string"), x["l_linenumber"].cast("string"))))


@query("SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1, 2")
def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderstatus")
    return G.first_wins(rows, ["o_custkey", "o_orderpriority"], F.col("o_orderkey"))


MESSAGE_SQL = "substr(event_type || ' failed for item ' || CAST(event_id % 7 AS VARCHAR) || repeat(' detail', 15), 1, 30)"


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat("event_type", F.lit(" failed for item "), (F.col("event_id") % 7).cast("string"), F.repeat(F.lit(" detail"), 15))
    return G.summary(table(spark, sf_dir, "events").withColumn("file", F.col("user_id") % 5), message, "event_id", "file", 30)


@query(f"SELECT {MESSAGE_SQL} AS message, user_id % 5 AS file, count(*) AS n, min(event_id) AS first_line, max(event_id) AS last_line FROM events GROUP BY 1, 2")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir)


@query(f"SELECT {MESSAGE_SQL} AS message, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {MESSAGE_SQL}) AS rank FROM events GROUP BY 1 ORDER BY n DESC, message LIMIT 10")
def errors_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.most_frequent(messages(spark, sf_dir), "message", "n", 10)


@query("SELECT user_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors, count(*) AS n_ids FROM events GROUP BY 1")
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "error", 1).otherwise(0).cast("long").alias("errors"), F.array("event_id").alias("ids"))
    return G.merge(rows, "user_id", ["errors"], ["ids"])


@query("""
WITH p AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS k FROM lineitem)
SELECT l_orderkey, k // 3 AS run, list(l_partkey ORDER BY k) AS items FROM p GROUP BY 1, 2 HAVING count(*) = 3""", joined=("items",))
def consecutive_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.consecutive(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"], 3, "l_partkey")


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 20 OFFSET 40")
def paginate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.page(table(spark, sf_dir, "part").select("p_partkey", "p_name"), [F.col("p_name"), F.col("p_partkey")], 3)


@query("""
WITH n AS (SELECT conv_id, turn, role, CASE WHEN role IS NOT DISTINCT FROM lag(role) OVER w THEN 0 ELSE 1 END AS new FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM n)
SELECT conv_id, CAST(island AS BIGINT) AS island, role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM i GROUP BY ALL""")
def appendix_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.islands(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role")


@query("SELECT o_custkey, count(*) AS n, 'duplicate id' AS error FROM orders GROUP BY 1 HAVING count(*) > 1")
def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.checked_unique(table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.missing'), 'none') AS missing FROM events")
def json_path_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", R.path(props, "$.k").alias("k"), R.path(props, "$.missing", "none").alias("missing"))


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'v' || event_id % 90 ELSE '' END || CASE WHEN event_id % 5 = 0 THEN 's1' ELSE '' END || 'n' || event_id % 12 || CASE WHEN event_id % 7 = 0 THEN 's0' ELSE '' END AS folder FROM events""")
def issue_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder names of issues from their JSON records."""
    k = F.col("event_id")
    field = lambda c: F.array(F.create_map(F.lit("_"), c.cast("string")))
    record = F.to_json(F.struct(F.when(k % 2 == 0, field(k % 90)).alias("v31"), F.when(k % 5 == 0, field(F.lit(1))).alias("v131"), field(k % 12).alias("v32"), F.when(k % 7 == 0, field(F.lit(0))).alias("v132")))
    rows = table(spark, sf_dir, "events").select("event_id", R.parsed(record).alias("r"))
    return rows.select("event_id", R.issue_folder(*[R.field(F.col("r"), t) for t in ("v31", "v131", "v32", "v132")]).alias("folder"))


@query("SELECT event_id, 'main ' || event_type || ' sub:' || user_id AS text, 3 AS n FROM events")
def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subfields of a field's content, put together again."""
    content = F.concat(F.lit("main^A"), "event_type", F.lit("^bsub:"), F.col("user_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", R.subfields(content).alias("s"))
    return rows.select("event_id", F.array_join(F.transform("s", lambda x: x["value"]), " ").alias("text"), F.size("s").alias("n"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    new = rows.where("o_orderkey % 3 = 0")
    return S.insert_if_absent(rows.where("o_orderkey % 2 = 0"), new.unionByName(new), ["o_orderkey"], F.col("o_orderstatus"))[0]


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return S.upsert(rows, rows.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_orderkey"])


@query("SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, 'Document' AS entity, CAST(o_orderkey AS VARCHAR) AS id, sha1(o_orderstatus || o_orderpriority) AS content_sha1 FROM orders")
def changes_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return S.changes(table(spark, sf_dir, "orders"), "Document", "o_orderkey", stamp, F.concat("o_orderstatus", "o_orderpriority"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')")
def resume_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.concat(F.col("l_orderkey").cast("string"), F.lit(" ")).alias("o_orderkey"))
    return S.remaining(table(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey")


@query("""
WITH b AS (SELECT o_custkey AS bundle_id, o_orderkey AS k FROM orders)
SELECT bundle_id, coalesce(list_sort(list(k) FILTER (WHERE k % 10 <> 0)), []) AS items FROM b GROUP BY 1""", joined=("items",))
def rollback_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles after documents were rolled back."""
    orders = table(spark, sf_dir, "orders")
    bundles = orders.groupBy(F.col("o_custkey").alias("bundle_id")).agg(F.collect_list("o_orderkey").alias("items"))
    return S.roll_back(orders, bundles, orders.where("o_orderkey % 10 = 0"), "o_orderkey", "items")[1]


@query("""
WITH d AS (SELECT o_orderkey, 'v2-' || o_orderkey AS pid_v2, CASE WHEN o_orderkey % 4 = 0 THEN 'v2-' || (o_orderkey - 1) END AS prev FROM orders), k AS (SELECT 'v2-' || o_orderkey AS v2, min('v3-' || o_orderkey) AS v3 FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
SELECT d.o_orderkey, coalesce(a.v3, b.v3, 'new-' || d.o_orderkey) AS pid_v3, coalesce(a.v3, b.v3) IS NULL AS is_new FROM d LEFT JOIN k a ON prev = a.v2 LEFT JOIN k b ON pid_v2 = b.v2""")
def pid_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    code = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    orders = table(spark, sf_dir, "orders")
    known = orders.where(k % 3 == 0).select(code("v2-", k).alias("v2"), code("v3-", k).alias("v3"))
    docs = orders.select(k, code("v2-", k).alias("pid_v2"), F.when(k % 4 == 0, code("v2-", k - 1)).alias("previous_pid"))
    return S.pid_pairs(docs, known, code("new-", k)).select("o_orderkey", "pid_v3", "is_new")
