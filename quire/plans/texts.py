"""Text comparison over documents, benchmark and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import citations, similarity
from ..operators import diff as D
from .registry import query, table

NORMAL = r"trim(regexp_replace(strip_accents(replace(lower({x}), 'ß', 'ss')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
WORDS = "list_filter(list_distinct(string_split({x}, ' ')), lambda w: w <> '')"


@query(f"SELECT doc_id, {NORMAL.format(x='text')} AS normal FROM documents")
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("normal"))


@query(f"""
WITH w AS (SELECT conv_id, turn, {WORDS.format(x=NORMAL.format(x="text"))} AS w FROM conversations),
p AS (SELECT a.conv_id, a.turn, a.w AS x, b.w AS y FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, coalesce(len(list_intersect(x, y)) / nullif(len(x) + len(y) - len(list_intersect(x, y)), 0), 0.0) AS similarity FROM p""")
def token_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn with the next of its conversation: a window in place of a self-join."""
    rows = table(spark, sf_dir, "conversations").withColumn("x", T.normalize_text(F.col("text")))
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = rows.withColumn("y", F.lead("x").over(w)).withColumn("next", F.lead("turn").over(w))
    return rows.where(F.col("next") == F.col("turn") + 1).select("conv_id", "turn", T.jaccard(F.col("x"), F.col("y")).alias("similarity"))


@query(f"""
WITH t AS (SELECT doc_id, {NORMAL.format(x="text")} AS n FROM documents),
d AS (SELECT doc_id, {WORDS.format(x="n")} AS w FROM t), m AS (SELECT item_id, {NORMAL.format(x="text")} AS n FROM benchmark), b AS (SELECT item_id, {WORDS.format(x="n")} AS w FROM m),
j AS (SELECT doc_id, item_id, len(list_intersect(d.w, b.w)) AS s, len(b.w) AS t FROM d, b WHERE len(b.w) > 0)
SELECT doc_id, item_id, s / t AS containment FROM j WHERE s / t >= 0.7""")
def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have seven tenths of a benchmark item's words."""
    return similarity.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "item_id", 0.7)


@query(f"""
WITH a AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations WHERE role = 'user' GROUP BY 1),
b AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations WHERE role <> 'user' GROUP BY 1),
n AS (SELECT conv_id, {NORMAL.format(x="a.text")} AS x, {NORMAL.format(x="b.text")} AS y FROM a JOIN b USING (conv_id)),
w AS (SELECT *, {WORDS.format(x="x")} AS v, {WORDS.format(x="y")} AS u FROM n),
s AS (SELECT conv_id, x, y, coalesce(len(list_intersect(v, u)) / nullif(len(v) + len(u) - len(list_intersect(v, u)), 0), 0.0) AS similarity FROM w)
SELECT conv_id, similarity, similarity * 100 <= 20 AS below, CASE WHEN similarity * 100 <= 20 THEN x END AS left_text, CASE WHEN similarity * 100 <= 20 THEN y END AS right_text FROM s""")
def similarity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two renderings compared: what the user and what the others of a conversation said."""
    rows = table(spark, sf_dir, "conversations")

    def said(which) -> DataFrame:
        parts = rows.where(which).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("p"))
        return parts.select("conv_id", F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text"))

    return similarity.compare(said(F.col("role") == "user"), said(F.col("role") != "user"), "conv_id", 20.0).drop("percent")


CITATIONS_SQL = """
WITH p AS (SELECT conv_id AS pid, CAST(turn AS VARCHAR) AS ref_index, turn || '. <font size=''2''>' || text || '</font> ' AS text FROM conversations WHERE turn % 3 <> 0),
c AS (SELECT pid, ref_index, trim(regexp_replace(regexp_replace(text, '(?is)<!--.*?-->|<\\s*/?\\s*(?:font|br|span|p|small|o:p)\\b[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS citation FROM p),
r AS (SELECT DISTINCT conv_id AS pid, turn AS position, CASE WHEN turn % 4 = 0 THEN 'kept' END AS mixed FROM conversations),
j AS (SELECT r.pid, position, mixed, citation, coalesce(citation <> '', false) AND {when} AS updated FROM r LEFT JOIN c ON r.pid = c.pid AND CAST(position AS VARCHAR) = ref_index)
SELECT pid, position, CASE WHEN updated THEN citation ELSE mixed END AS mixed, updated, CASE WHEN updated AND regexp_extract(citation, '^\\s*(\\d+)', 1) = CAST(position AS VARCHAR) THEN CAST(position AS VARCHAR) END AS label FROM j"""


def cited(spark: SparkSession, sf_dir: str, override: bool) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    text = F.concat(F.col("turn").cast("string"), F.lit(". <font size='2'>"), "text", F.lit("</font> "))
    paragraphs = rows.where("turn % 3 <> 0").select(F.col("conv_id").alias("pid"), F.col("turn").cast("string").alias("ref_index"), text.alias("text"))
    references = rows.select(F.col("conv_id").alias("pid"), F.col("turn").alias("position"), F.when(F.col("turn") % 4 == 0, "kept").alias("mixed")).distinct()
    return citations.with_citations(references, paragraphs, override=override)


@query(CITATIONS_SQL.format(when="mixed IS NULL"))
def mixed_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References without text get the cleaned paragraph of their position."""
    return cited(spark, sf_dir, False)


@query(CITATIONS_SQL.format(when="true"))
def citations_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All references get the cleaned paragraph of their position, if there is one."""
    return cited(spark, sf_dir, True)


@query("SELECT doc_id, regexp_extract(text, '^\\s*(\\d+)', 1) AS first_number, regexp_matches(regexp_extract(text, '^\\S+', 0), '^[0-9]|^[^\\p{L}\\p{N}]|^\\p{Ll}$') AS is_label FROM documents")
def reference_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.regexp_extract("text", r"^\s*(\d+)", 1).alias("first_number"), T.is_footnote_label(F.regexp_extract("text", r"^\S+", 0)).alias("is_label"))


@query("""
WITH w AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\\s+'), lambda w: regexp_replace(w, '[^\\p{L}\\p{N}]', '', 'g')), lambda w: w <> '') AS w FROM documents)
SELECT doc_id, len(w) AS n_words, sha1(array_to_string(w, ' ')) AS words_sha1 FROM w""")
def alnum_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", T.alnum_words(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").cast("long").alias("n_words"), F.sha1(F.array_join("w", " ").cast("binary")).alias("words_sha1"))


TOKENS = "list_filter(regexp_split_to_array(coalesce({x}, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')"


@query(f"""
WITH t AS (SELECT doc_id, {TOKENS.format(x="text")} AS a, {TOKENS.format(x=NORMAL.format(x="text"))} AS b FROM documents)
SELECT doc_id, CAST(len(a) AS BIGINT) AS before_length, CAST(len(b) AS BIGINT) AS after_length, md5(array_to_string(a, ' ')) AS before_digest, md5(array_to_string(b, ' ')) AS after_digest FROM t WHERE len(a) + len(b) > 0""")
def rendition_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against their normalised text: what the runs kept and lost, and those kept and added, put together again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = D.diff(docs, docs.withColumn("text", T.normalize_text(F.col("text"))), "doc_id")
    side = lambda other: F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") != other, F.struct("run", "text")))), lambda r: r["text"]), " "))  # one document's runs
    whole = D.report(found, "doc_id", before_digest=side(D.ADDED), after_digest=side(D.LOST))
    return whole.select("doc_id", "before_length", "after_length", "before_digest", "after_digest")
