"""What links, anchors and files of pages stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inference as N
from .links import RULES
from .registry import query, table

RULES_SQL = f"(VALUES {', '.join(f'({chr(39)}{c}{chr(39)}, {chr(39)}{t}{chr(39)})' for c, t in RULES)}) AS r(clue, tag)"
TYPE_SQL = "CASE {0} WHEN 'table-wrap' THEN 'table' WHEN 'ref' THEN 'bibr' ELSE {0} END"
#: What is put before a number or a part's name.
BEFORE = ["t", "fig", "x_fig", "*", "a", "b12z", "1", "tab_1_", "", "Figure ", "(app", "corresponding ", "text ", "see image ", "é"]
NAMES = f"(SELECT DISTINCT CASE p_partkey % {len(BEFORE)} {' '.join(f'WHEN {i} THEN {chr(39)}{b}{chr(39)}' for i, b in enumerate(BEFORE))} END || CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 40 AS VARCHAR) ELSE left(p_name, 3) END AS name FROM part)"


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "clue string, tag string")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    before = F.get(F.array(*[F.lit(b) for b in BEFORE]), (k % len(BEFORE)).cast("int"))
    return table(spark, sf_dir, "part").select(F.concat(before, F.when(k % 2 == 0, (k % 40).cast("string")).otherwise(F.left("p_name", F.lit(3)))).alias("name"))


@query(f"""
WITH n AS {NAMES}, b AS (SELECT name, arg_max(tag, (len(clue), clue, tag)) AS tag, max(len(clue)) AS n FROM n JOIN {RULES_SQL} ON starts_with(name, clue) GROUP BY 1),
c AS (SELECT name, arg_max(tag, (len(clue), clue, tag)) AS tag FROM n JOIN {RULES_SQL} ON contains(name, clue) AND len(clue) > 1 GROUP BY 1),
k AS (SELECT name, CASE WHEN name = '' THEN NULL WHEN regexp_matches(name, '^\\p{{L}}') THEN CASE WHEN b.n = 1 AND NOT regexp_matches(name[2:], '^\\d+$') THEN 'fn' ELSE coalesce(b.tag, c.tag, 'fn') END
  WHEN regexp_matches(name, '^[^\\p{{L}}\\p{{N}}]') THEN 'symbol' ELSE 'fn' END AS tag FROM n LEFT JOIN b USING (name) LEFT JOIN c USING (name))
SELECT name, tag, CASE tag WHEN 'symbol' THEN 'fn' ELSE {TYPE_SQL.format("tag")} END AS ref_type FROM k""")
def infer_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.from_names(names(spark, sf_dir), "name", rules(spark))


@query(f"""
WITH n AS {NAMES}, t AS (SELECT name AS text, lower(trim(name)) AS t FROM n), s AS (SELECT *, regexp_replace(t, '^[^\\p{{L}}\\p{{N}}]+(.)', '\\1') AS b FROM t),
r AS (SELECT text, arg_max(tag, (len(clue), clue, tag)) AS tag FROM s JOIN {RULES_SQL} ON starts_with(b, clue) AND len(clue) > 1 GROUP BY 1),
k AS (SELECT text, CASE WHEN t = '' THEN NULL WHEN r.tag IS NOT NULL THEN r.tag WHEN NOT regexp_matches(t, '^\\p{{L}}') OR len(t) = 1 THEN 'fn' WHEN t[1:4] = 'text' THEN 'target' WHEN regexp_matches(b, 'corresp|address|endereço') THEN 'corresp' WHEN contains(b, 'image') THEN 'fig' WHEN contains(b, 'annex') THEN 'app' ELSE 'undefined' END AS tag FROM s LEFT JOIN r USING (text))
SELECT text, tag, CASE tag WHEN 'target' THEN 'other' ELSE {TYPE_SQL.format("tag")} END AS ref_type FROM k""")
def infer_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.from_texts(names(spark, sf_dir).withColumnRenamed("name", "text"), "text", rules(spark))


@query(f"""
WITH n AS (SELECT 'a/b/' || name || '.htm' AS path, name FROM {NAMES}),
p AS (SELECT path, name, clue, tag, string_split(name, clue) AS s FROM n JOIN {RULES_SQL} ON contains(name, clue)),
v AS (SELECT path, tag, clue, CASE WHEN name = clue THEN name WHEN NOT regexp_matches(s[1], '\\p{{L}}$') AND NOT regexp_matches(s[2], '^\\p{{L}}') AND s[2] <> '' THEN clue || array_to_string(s[2:], '') END AS id FROM p),
b AS (SELECT path, arg_max({{'tag': tag, 'id': id}}, (len(clue), clue, tag)) AS x FROM v WHERE id IS NOT NULL GROUP BY 1)
SELECT path, x.tag AS tag, {TYPE_SQL.format("x.tag")} AS ref_type, x.id AS id FROM n LEFT JOIN b USING (path)""")
def infer_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.from_files(names(spark, sf_dir).select(F.concat(F.lit("a/b/"), "name", F.lit(".htm")).alias("path")), "path", rules(spark))


@query("""
WITH l AS (SELECT conv_id AS doc, turn AS pos, CASE turn % 4 WHEN 0 THEN '#n' || turn WHEN 1 THEN ' /p/f' || turn || '.htm' WHEN 2 THEN 'http://x/y.htm' ELSE '' END AS href, role AS text FROM conversations)
SELECT doc, CASE WHEN href LIKE '#%' THEN 'text inside' ELSE 'text outside' END AS kind, text AS key, pos FROM l WHERE text <> '' UNION ALL SELECT doc, 'file', 'f' || pos, pos FROM l WHERE pos % 4 = 1""")
def link_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    href = F.when(turn % 4 == 0, F.concat(F.lit("#n"), turn.cast("string"))).when(turn % 4 == 1, F.concat(F.lit(" /p/f"), turn.cast("string"), F.lit(".htm"))).when(turn % 4 == 2, "http://x/y.htm").otherwise("")
    return N.link_groups(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), turn.alias("pos"), href.alias("href"), F.col("role").alias("text")))


@query("""
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '/img/revistas/a/x.gif' WHEN 1 THEN '/img/revistas/a/bc.gif' WHEN 2 THEN 'http://s/img/a.gif' WHEN 3 THEN '#img1' ELSE 'other.htm' END AS path FROM orders""")
def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = F.array(*[F.lit(p) for p in ("img/fbpe/a/x.gif", "/x/img/revistas/a/b c.gif", "http://s/img/a.gif", "#img1", "other.htm")])
    return table(spark, sf_dir, "orders").select("o_orderkey", N.image_path(F.get(paths, (F.col("o_orderkey") % 5).cast("int"))).alias("path"))


@query("""
SELECT l_orderkey AS bundle, l_linenumber AS item, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_orderkey % 2 = 0 THEN -l_partkey ELSE l_partkey END, l_linenumber) AS position FROM lineitem""")
def sorted_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a bundle in the order of their pages, or the other way round where the bundle says so."""
    from ..operators import groups

    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("bundle"), F.col("l_linenumber").alias("item"), "l_partkey")
    return groups.placed(rows, "bundle", F.col("l_partkey"), F.col("bundle") % 2 == 0, F.col("item")).select("bundle", "item", "position")


@query("""
SELECT o_orderkey, printf('S%04d-00002020%05d', o_custkey % 10000, o_orderkey % 100000) AS pid, CASE WHEN c.k IS NOT NULL THEN '9999-' || lpad(CAST(c.k AS VARCHAR), 4, '0') END AS issn
FROM orders LEFT JOIN (SELECT DISTINCT c_custkey % 10000 AS k FROM customer WHERE c_custkey % 2 = 0) c ON o_custkey % 10000 = c.k""")
def issn_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the ISSN that a table of corrections has for the one in their id."""
    from ..operators import lookups

    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.format_string("S%04d-00002020%05d", F.col("o_custkey") % 10000, F.col("o_orderkey") % 100000).alias("pid"))
    key = F.col("c_custkey") % 10000
    fixes = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.format_string("%04d-0000", key).alias("old"), F.concat(F.lit("9999-"), F.lpad(key.cast("string"), 4, "0")).alias("issn")).distinct()
    return lookups.issn_fixes(rows, "pid", fixes, "old")
