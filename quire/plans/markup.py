"""Pages as HTML bodies: text, links, blocks and article XML; documents as XML for XPath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions import text as T
from ..functions import ids as I
from ..functions import manifests as MA
from ..functions import xmledit as E
from ..functions import xmlmeta as X
from .registry import query, table

ARTICLE = r"regexp_extract(html, '(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>', 1)"
UNESCAPED = "replace(replace(replace(replace(replace(replace(replace({x}, '&nbsp;', ' '), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
TEXT = "trim(regexp_replace(" + UNESCAPED.format(x=r"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', ' ', 'g')") + r", '\s+', ' ', 'g'))"


@query(f"SELECT page_id, {TEXT.format(x=ARTICLE)} AS text FROM pages")
def html_text_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", M.text_of(M.element(F.col("html"), "article")).alias("text"))


@query("""
SELECT page_id, list_distinct(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1)).list_sort() AS links FROM pages""", joined=("links",))
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_sort(F.array_distinct(M.hrefs(F.col("html")))).alias("links"))


@query("""
WITH h AS (SELECT page_id, regexp_extract(url, '://([^/]*)', 1) AS host, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1)) AS href FROM pages),
p AS (SELECT *, regexp_replace(href, '[?#].*$', '') AS path FROM h),
c AS (SELECT page_id, CASE WHEN starts_with(href, '#') THEN 'internal' WHEN regexp_matches(href, '(?i)^mailto:|@') THEN 'external' WHEN regexp_matches(href, '(?i)^[a-z]+://') AND NOT contains(href, host) THEN 'external'
  WHEN regexp_matches(path, '(?i)\\.pdf$') THEN 'pdf' WHEN regexp_matches(path, '(?i)\\.(jpg|jpeg|gif|png|tif|tiff|svg)$') THEN 'asset' WHEN regexp_matches(path, '(?i)\\.html?$') THEN 'html' WHEN starts_with(href, '/') THEN 'html' ELSE 'unknown' END AS class FROM p)
SELECT page_id, class, count(*) AS n FROM c GROUP BY 1, 2""")
def link_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/]*)", 1).alias("host"), F.explode(M.hrefs(F.col("html"))).alias("href"))
    return rows.groupBy("page_id", M.link_class(F.col("href"), F.col("host")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH b AS (SELECT page_id, regexp_extract_all({ARTICLE}, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1) AS p FROM pages),
e AS (SELECT page_id, unnest(p) AS html, generate_subscripts(p, 1) AS position FROM b)
SELECT page_id, position - 1 AS position, {TEXT.format(x="html")} AS text FROM e""")
def html_to_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of each article in order."""
    blocks = F.regexp_extract_all(M.element(F.col("html"), "article"), F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(blocks).alias("position", "html"))
    return rows.select("page_id", F.col("position").cast("long").alias("position"), M.text_of(F.col("html")).alias("text"))


@query(f"SELECT page_id, regexp_replace(regexp_replace(regexp_extract({ARTICLE}, '(?is)<h1.*?</h1>', 0), '<h([1-6])(?:\\s[^>]*)?>', '<p content-type=\"h\\1\">', 'g'), '</h[1-6]>', '</p>', 'g') AS heading FROM pages")
def headings_to_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    heading = F.regexp_extract(M.element(F.col("html"), "article"), "(?is)<h1.*?</h1>", 0)
    return table(spark, sf_dir, "pages").select("page_id", M.rename(heading).alias("heading"))


@query()
def html_to_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's article as article XML, with the number of elements that the stages have left as HTML."""
    rows = table(spark, sf_dir, "pages").select("page_id", M.to_article_body(M.element(F.col("html"), "article"), F.lit(1)).alias("body"))
    return rows.withColumn("html_left", F.regexp_count("body", F.lit(r"(?i)<(?:b|i|em|strong|u|ul|ol|li|h[1-6]|div|br|font|span)[\s/>]")))


@query()
def conversion_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each article's words the conversion has kept."""
    said = lambda html: T.normalize_text(M.text_of(html))
    # a page's row has all that is compared; each step is worked out once for what refers to it
    rows = table(spark, sf_dir, "pages").select("page_id", M.element(F.col("html"), "article").alias("html"))
    rows = rows.select("page_id", said(F.col("html")).alias("a"), said(M.to_article_body(F.col("html"), F.lit(1))).alias("b"))
    rows = rows.select("page_id", F.length("a").alias("before"), F.length("b").alias("after"), T.words(F.col("a")).alias("a"), T.words(F.col("b")).alias("b"))
    return rows.select("page_id", "before", "after", T.overlap(F.col("a"), F.col("b")).alias("ratio"))


def documents_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as article XML: ids, dates, pages, files and languages from their columns; of fifty, three are broken, empty or null."""
    k = F.col("doc_id")
    lit, text = F.lit, k.cast("string")
    node = lambda name, value, attrs="": F.concat(lit(f"<{name}{attrs}>"), value, lit(f"</{name}>"))
    only = lambda test, value: F.when(test, value).otherwise("")
    use = lambda x: f' pub-id-type="publisher-id" specific-use="{x}"'
    meta = F.concat(
        node("article-id", F.format_string("S0000-0000202000%07d", k), use("pid-v2")),
        only(k % 3 == 1, node("article-id", F.concat(lit("v1-"), text), use("pid-v1"))),
        only(k % 3 == 2, node("article-id", F.concat(lit("v3-"), text), use("pid-v3"))),
        only(k % 10 == 0, node("article-id", F.concat(lit("aop-"), text), use("previous-pid"))),
        only(k % 4 == 1, node("article-id", F.lpad(text, 5, "0"), ' pub-id-type="other"')),
        only(k % 2 == 0, node("article-id", F.concat(lit("https://doi.org/10.1/"), only(k % 4 == 2, lit("a&amp;b&#x2d;")), text), ' pub-id-type="doi"')),
        only(k % 3 == 0, lit('<pub-date pub-type="epub"><day>5</day><month>3</month><year>2019</year></pub-date>')),
        F.when(k % 11 != 3, '<pub-date pub-type="collection"><year>2020</year></pub-date>').when(k % 2 == 0, '<pub-date date-type="collection"><year>2021</year></pub-date>').otherwise('<pub-date pub-type="epub-pub"><year>2022</year></pub-date>'),
        only(k % 7 == 0, lit('<pub-date pub-type="epub-ppub"><month>11</month><year>2018</year></pub-date>')),
        lit("<product><volume>99</volume><fpage>98</fpage></product><!-- <issue>97</issue> -->"),
        node("volume", (k % 4).cast("string")),
        node("issue", (k % 5).cast("string")),
        node("fpage", text),
        only(k % 2 == 1, node("lpage", (k + 9).cast("string"))),
        only(k % 3 == 0, node("elocation-id", F.concat(lit("e"), text))),
        F.concat(lit('<self-uri xml:lang="en" xlink:href="'), text, lit('.pdf"/>')),
        only(k % 2 == 1, F.concat(lit('<self-uri xlink:href="pt_'), text, lit('.pdf" xml:lang="pt"/>'))),
        lit('<counts><page-count count="1"/></counts>'),
    )
    graphic = F.concat(lit('<graphic xlink:href="g'), (k % 5).cast("string"), lit('.jpg"/><graphic xlink:href="http://x/y.jpg"/>'))
    issn = F.concat(only(k % 6 == 0, lit('<issn pub-type="ppub">3333-333X</issn>')), F.when(k % 2 == 0, lit('<issn pub-type="epub">1111-1111</issn>')).otherwise('<issn pub-type="ppub">2222-2222</issn>'))
    xml = F.concat(
        F.when(k % 5 == 0, lit('<!DOCTYPE article PUBLIC "-//X//DTD" "a.dtd">')).otherwise(""),
        lit('<article xmlns:xlink="http://www.w3.org/1999/xlink" xml:lang="'), "lang", lit('"><front><journal-meta>'), node("journal-id", F.concat(lit("acr"), (k % 7).cast("string")), ' journal-id-type="publisher-id"'), issn, lit("</journal-meta><article-meta>"), meta,
        lit("</article-meta></front><body><p>"), graphic, lit('</p></body><sub-article article-type="translation" xml:lang="pt"/></article>'),
    )
    given = F.when(k % 50 == 7, F.substr(xml, lit(1), F.length(xml) - F.length(lit("</article>")))).when(k % 50 == 8, "").when(k % 50 != 9, xml)
    return table(spark, sf_dir, "documents").select("doc_id", given.alias("xml"))


#: Of a document that is broken, empty or null, what SQL says in place of a value.
SOUND = "doc_id % 50 NOT IN (7, 8, 9)"


@query(f"""
WITH d AS (SELECT doc_id, CASE WHEN {SOUND} THEN doc_id END AS k, lang FROM documents)
SELECT doc_id, CASE WHEN k % 3 = 1 THEN 'v1-' || k END AS pid_v1, CASE WHEN k IS NOT NULL THEN printf('S0000-0000202000%07d', k) END AS pid_v2, CASE WHEN k % 3 = 2 THEN 'v3-' || k END AS pid_v3, CASE WHEN k % 10 = 0 THEN 'aop-' || k END AS aop_pid,
  CASE WHEN k IS NOT NULL THEN printf('S0000-0000202000%07d', k) END AS publisher_id, CASE WHEN k % 2 = 0 THEN '10.1/' || CASE WHEN k % 4 = 2 THEN 'a&b-' ELSE '' END || k END AS doi, CASE WHEN k % 4 = 1 THEN left(lpad(CAST(k AS VARCHAR), 5, '0'), 5) END AS other,
  CASE WHEN k % 2 = 0 THEN '1111-1111' WHEN k % 2 = 1 THEN '2222-2222' END AS issn, 'acr' || k % 7 AS acron,
  CASE WHEN k % 4 <> 0 THEN CAST(k % 4 AS VARCHAR) END AS volume, CASE WHEN k % 5 <> 0 THEN CAST(k % 5 AS VARCHAR) END AS issue, CASE WHEN k <> 0 THEN CAST(k AS VARCHAR) END AS fpage, CASE WHEN k % 2 = 1 THEN CAST(k + 9 AS VARCHAR) END AS lpage, CASE WHEN k % 3 = 0 THEN 'e' || k END AS elocation_id,
  CASE WHEN k IS NOT NULL THEN lang || ',pt' END AS languages, CASE WHEN k IS NOT NULL THEN 'g' || k % 5 || '.jpg' END AS assets, CASE WHEN k % 3 = 0 THEN '2019-03-05' WHEN k % 11 = 3 AND k % 2 = 1 THEN '2022--' ELSE '' END AS document_date,
  CASE WHEN k % 7 = 0 THEN '2018-11-' WHEN k % 11 <> 3 THEN '2020--' WHEN k % 2 = 0 THEN '2021--' ELSE '' END AS bundle_date, CASE WHEN k % 11 <> 3 THEN '2020' WHEN k % 2 = 0 THEN '2021' WHEN k % 2 = 1 THEN '2022' END AS bundle_year,
  CASE doc_id % 50 WHEN 7 THEN 'not closed: article' WHEN 8 THEN 'no root' WHEN 9 THEN 'no document' END AS error FROM d""")
def doc_meta_xpath(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents_xml(spark, sf_dir).select("doc_id", X.metadata(F.col("xml")).alias("m"))
    day = lambda d: F.when(F.col(d).getField("year").isNotNull(), F.concat_ws("-", *[F.coalesce(F.col(d).getField(p), F.lit("")) for p in ("year", "month", "day")])).otherwise("")
    plain = ("pid_v1", "pid_v2", "pid_v3", "aop_pid", "publisher_id", "doi", "other", "issn", "acron", "volume", "issue", "fpage", "lpage", "elocation_id", "bundle_year")
    error = F.regexp_replace("m.error", r"^\d+: ", "").alias("error")
    return rows.select("doc_id", *[f"m.{n}" for n in plain], error, F.array_join("m.languages", ",").alias("languages"), F.array_join("m.assets", ",").alias("assets"), day("m.document_date").alias("document_date"), day("m.bundle_date").alias("bundle_date"))


@query(f"""
WITH d AS (SELECT doc_id AS id, CASE WHEN {SOUND} THEN doc_id END AS doc_id FROM documents)
SELECT id AS doc_id, CASE WHEN doc_id % 2 = 0 THEN '1111-1111' END AS epub, CASE WHEN doc_id % 6 = 0 THEN '3333-333X' WHEN doc_id % 2 = 1 THEN '2222-2222' END AS ppub,
  (CASE WHEN doc_id % 2 = 0 THEN 'eissn=1111-1111,' ELSE '' END) || (CASE WHEN doc_id % 6 = 0 THEN 'pissn=3333-333X,issn=3333-333X,' WHEN doc_id % 2 = 1 THEN 'pissn=2222-2222,issn=2222-2222,' ELSE 'issn=1111-1111,' END) || 'acron=acr' || doc_id % 7 AS journal_meta FROM d""")
def issns_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents_xml(spark, sf_dir).select("doc_id", X.issns(F.col("xml")).alias("m"), X.journal_meta(F.col("xml")).alias("j"))
    at = lambda k: F.try_element_at("m", F.lit(k))
    return rows.select("doc_id", at("epub").alias("epub"), at("ppub").alias("ppub"), F.array_join(F.transform("j", lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("journal_meta"))


@query(f"SELECT doc_id, CASE WHEN {SOUND} THEN 'en=' || doc_id || '.pdf' || CASE WHEN doc_id % 2 = 1 THEN ',pt=pt_' || doc_id || '.pdf' ELSE '' END END AS renditions FROM documents")
def rendition_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents_xml(spark, sf_dir).select("doc_id", X.renditions(F.col("xml")).alias("m"))
    return rows.select("doc_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("renditions"))


@query("""
SELECT doc_id, '<article><front><journal-meta><journal-id>a</journal-id><issn pub-type="epub">1111-1111</issn><issn pub-type="ppub">2222-2222</issn></journal-meta><article-meta>'
  || CASE WHEN doc_id % 2 = 0 THEN '<article-id pub-id-type="publisher-id" specific-use="pid-v3">n' || doc_id || '</article-id><article-id pub-id-type="doi">d</article-id>' ELSE '' END
  || '<pub-date' || CASE WHEN doc_id % 3 = 0 THEN ' id="x"' ELSE '' END || ' date-type="pub" publication-format="electronic"><year>2019</year></pub-date><pub-date date-type="collection" publication-format="electronic"><year>2020</year></pub-date>'
  || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '<article-id pub-id-type="publisher-id" specific-use="pid-v3">n' || doc_id || '</article-id>' END || '</article-meta></front></article>' AS xml FROM documents""")
def xml_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata brought up to date: ISSNs and ids added, dates of the newer kind, counts taken out."""
    k, lit = F.col("doc_id"), F.lit
    xml = F.concat(
        lit("<article><front><journal-meta><journal-id>a</journal-id></journal-meta><article-meta>"), F.when(k % 2 == 0, lit('<article-id pub-id-type="doi">d</article-id>')).otherwise(""),
        lit("<pub-date"), F.when(k % 3 == 0, lit(' id="x"')).otherwise(""), lit(' pub-type="epub"><year>2019</year></pub-date><pub-date pub-type="epub-ppub"><year>2020</year></pub-date><counts><page-count count="1"/></counts></article-meta></front></article>'),
    )
    out = E.with_article_id(E.without_counts(E.upgraded_dates(xml)), F.concat(lit("n"), k.cast("string")), "pid-v3")
    return table(spark, sf_dir, "documents").select("doc_id", E.with_issns(out, F.create_map(lit("ppub"), lit("2222-2222"), lit("epub"), lit("1111-1111"))).alias("xml"))


@query(f"""
WITH d AS (SELECT doc_id, CASE WHEN {SOUND} THEN doc_id END AS k FROM documents)
SELECT doc_id, CASE WHEN k % 3 = 2 THEN 'v3-' || k END AS pid_v3, CASE WHEN k % 2 = 0 THEN '1111-1111' END AS eissn, CASE WHEN k % 6 = 0 THEN '3333-333X' WHEN k % 2 = 1 THEN '2222-2222' END AS pissn,
  CASE WHEN k % 6 = 0 THEN '3333-333X' WHEN k % 2 = 1 THEN '2222-2222' WHEN k % 2 = 0 THEN '1111-1111' END AS issn, 'acr' || k % 7 AS acron, CASE WHEN k IS NOT NULL THEN printf('S0000-0000202000%07d', k) END AS pid,
  CASE WHEN k % 7 = 0 THEN '2018' WHEN k % 11 <> 3 THEN '2020' WHEN k % 2 = 0 THEN '2021' END AS year,
  CASE WHEN k % 4 <> 0 THEN CAST(k % 4 AS VARCHAR) END AS volume, CASE WHEN k % 5 <> 0 THEN CAST(k % 5 AS VARCHAR) END AS number, CAST(NULL AS VARCHAR) AS supplement,
  coalesce(CASE WHEN k % 100000 BETWEEN 1 AND 99999 THEN lpad(CAST(k % 100000 AS VARCHAR), 5, '0') END, CASE WHEN k BETWEEN 1 AND 99999 THEN lpad(CAST(k AS VARCHAR), 5, '0') END) AS position FROM d""")
def import_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What imported documents' issues are found by."""
    rows = documents_xml(spark, sf_dir).select("doc_id", X.metadata(F.col("xml")).alias("m"), X.journal_meta(F.col("xml")).alias("j"))
    return rows.select("doc_id", MA.article_result(F.col("m"), F.col("j")).alias("r")).select("doc_id", "r.*").withColumnRenamed("order", "position")


@query(f"""
SELECT doc_id, CASE WHEN {SOUND} THEN concat_ws('-', CASE WHEN doc_id % 2 = 0 THEN '1111-1111' ELSE '2222-2222' END, 'acr' || doc_id % 7, CASE WHEN doc_id % 4 <> 0 THEN CAST(doc_id % 4 AS VARCHAR) END, CASE WHEN doc_id % 5 <> 0 THEN '0' || doc_id % 5 END,
  CASE WHEN doc_id <> 0 THEN CAST(doc_id AS VARCHAR) END, CASE WHEN doc_id % 2 = 1 THEN CAST(doc_id + 9 AS VARCHAR) END, CASE WHEN doc_id % 3 = 0 THEN 'e' || doc_id END, CASE WHEN doc_id % 20 = 0 THEN 'ahead-' || CASE WHEN doc_id % 11 = 3 THEN '2021-' ELSE '2020-' END || doc_id END) ELSE 'file' END AS package FROM documents""")
def package_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package names by documents' metadata, those ahead of print among them."""
    return documents_xml(spark, sf_dir).select("doc_id", I.package_name_of(X.metadata(F.col("xml")), F.lit("file")).alias("package"))
