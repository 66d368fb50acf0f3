"""Documents' bodies as rows of nodes: labels of notes and appendices, references taken out, broken documents apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import xmltree as T
from ..operators import trees
from ..sources import shared
from .markup import documents_xml
from .registry import query, table


def bodies_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' whole texts as article bodies with notes, links, appendices and as many references as doc_id says (n_refs, mostly)."""
    k, lit = F.col("doc_id"), F.lit
    only = lambda test, value: F.when(test, value).otherwise("")
    text = F.array_join(F.transform(F.split(F.coalesce("text", lit("")), "\n"), lambda line: F.concat(lit("<p>"), T.escaped(line), lit("</p>"))), "")
    cited = F.when(k % 4 > 0, F.transform(F.sequence(lit(1), (k % 4).cast("int")), lambda i: F.when(i == k % 4, lit("<ul><li><b>last<!-- end-ref --></b></li></ul>")).otherwise(F.concat(lit("<p>ref "), i.cast("string"), lit("<!-- end-ref --></p>")))))
    xml = F.concat(
        lit('<article><body><p>T <a name="tx1" xml_text="1"/><a href="#nt1" xml_text="1"><sup>1</sup></a></p>'), text,
        only(k % 2 == 0, lit('<p><a name="nt1" xml_text="1"/><a href="#tx1" xml_text="1">1</a> note</p>')),
        only(k % 5 == 0, lit('<p><a name="nt2" xml_text="2"/><!-- x --><a href="#tx2" xml_text="2">2</a></p>')),
        only(k % 3 == 0, lit('<p><xref rid="app1"/><xref rid="app1">Appendix\n<b>A</b></xref><xref rid="app1">other</xref></p>')),
        lit("<p>References</p><!-- ref -->"), F.coalesce(F.array_join(cited, ""), lit("")),
        lit('</body><back><app id="app1"><p/></app>'), only(k % 7 == 0, lit('<app id="app2"><label>B</label></app>')), lit("</back></article>"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", xml.alias("xml"), (k % 4 + F.when(k % 13 == 0, 1).otherwise(0)).alias("n_refs"))


@query("SELECT doc_id, CASE doc_id % 50 WHEN 7 THEN 'not closed: article' WHEN 8 THEN 'no root' ELSE 'no document' END AS error FROM documents WHERE doc_id % 50 IN (7, 8, 9)")
def broken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that aren't well formed, and why."""
    _, broken = trees.routed(documents_xml(spark, sf_dir), "xml")
    return broken.select("doc_id", F.regexp_replace("error", r"^\d+: ", "").alias("error"))


@query("""
SELECT doc_id, 'tx1' AS anchor, 'nt1' AS target, '1' AS label FROM documents
UNION ALL SELECT doc_id, 'nt1', 'tx1', '1' FROM documents WHERE doc_id % 2 = 0""")
def fn_label_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors right before links with the same label: notes in the text and at the end."""
    bodies = bodies_xml(spark, sf_dir)
    return trees.note_labels(bodies, "doc_id", "xml", shared.written(trees.nodes(bodies, "doc_id", "xml"), "nodes"))


@query("SELECT doc_id, 'app1' AS id, CASE WHEN doc_id % 3 = 0 THEN 'Appendix A' END AS label FROM documents")
def appendix_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of appendices that have none, by the first link to them."""
    bodies = bodies_xml(spark, sf_dir)
    return trees.appendix_labels(bodies, "doc_id", "xml", shared.written(trees.nodes(bodies, "doc_id", "xml"), "nodes"))


ESCAPED = "replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(f"""
WITH d AS (SELECT doc_id, list_aggregate(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: '<p>' || {ESCAPED.format(x="x")} || '</p>'), 'string_agg', '') AS body,
  doc_id % 4 > 0 AND doc_id % 13 <> 0 AS gone, list_aggregate(list_transform(range(1, doc_id % 4 + 1), lambda i: CASE WHEN i = doc_id % 4 THEN '<ul><li><b>last<!-- end-ref --></b></li></ul>' ELSE '<p>ref ' || i || '<!-- end-ref --></p>' END), 'string_agg', '') AS refs FROM documents),
x AS (SELECT doc_id, gone, '<article><body><p>T <a name="tx1" xml_text="1"/><a href="#nt1" xml_text="1"><sup>1</sup></a></p>' || body
  || CASE WHEN doc_id % 2 = 0 THEN '<p><a name="nt1" xml_text="1"/><a href="#tx1" xml_text="1">1</a> note</p>' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN '<p><a name="nt2" xml_text="2"/><!-- x --><a href="#tx2" xml_text="2">2</a></p>' ELSE '' END
  || CASE WHEN doc_id % 3 = 0 THEN '<p><xref rid="app1"/><xref rid="app1">Appendix' || chr(10) || '<b>A</b></xref><xref rid="app1">other</xref></p>' ELSE '' END
  || CASE WHEN gone THEN '<!-- ref --><ul></ul>' ELSE '<p>References</p><!-- ref -->' || coalesce(refs, '') END
  || '</body><back><app id="app1"><p/></app>' || CASE WHEN doc_id % 7 = 0 THEN '<app id="app2"><label>B</label></app>' ELSE '' END || '</back></article>' AS xml FROM d)
SELECT doc_id, CAST(CASE WHEN gone THEN doc_id % 4 + 1 ELSE 0 END AS INT) AS n_removed, CAST(length(xml) AS INT) AS n_chars, md5(xml) AS digest FROM x""")
def references_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies without their references, where as many are marked as the document has."""
    bodies = bodies_xml(spark, sf_dir)
    out = trees.without_references(bodies, "doc_id", "xml", "n_refs")
    return out.select("doc_id", "n_removed", F.length("xml").alias("n_chars"), F.md5("xml").alias("digest"))
