"""Manifests, packages and bundles."""

from __future__ import annotations

from difflib import get_close_matches

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks as C
from ..functions import fuzzy
from ..functions import manifests as M
from ..functions import markup, text
from ..functions import records as R
from ..operators import lookups as L
from ..operators import packages as P
from ..sources import shared
from .registry import query, table


#: Journal records that a task works out at most, by their number over the input's.
JOURNALS_A_TASK = 10_000


def text_of(column: Column) -> Column:
    return column.cast("string")


@query("""
SELECT o_orderkey, printf('%04d-0000', o_custkey % 10000) || CASE WHEN o_orderkey % 3 = 0 THEN '-aop' ELSE '-' || year(o_orderdate) || '-v' || (o_orderkey % 30 + 1) || '-n' || (o_orderkey % 9 + 1) END AS id, CAST(year(o_orderdate) AS VARCHAR) AS year,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 30 + 1 AS VARCHAR) END AS volume, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS month, CASE WHEN o_orderkey % 4 = 0 THEN 1 END AS range_start, CASE WHEN o_orderkey % 4 = 0 THEN 6 END AS range_end,
  CASE WHEN o_orderkey % 3 = 0 THEN 'ahead' ELSE 'regular' END AS kind FROM orders""")
def issue_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundle manifests from issue records in JSON."""
    k = F.col("o_orderkey")
    field = lambda c, sub="_": F.array(F.create_map(F.lit(sub), c))
    record = F.to_json(
        F.struct(
            field(F.format_string("%04d-0000", F.col("o_custkey") % 10000)).alias("v35"),
            field(F.date_format("o_orderdate", "yyyyMM'00'")).alias("v65"),
            F.when(k % 3 != 0, field(text_of(k % 30 + 1))).alias("v31"),
            F.when(k % 3 != 0, field(text_of(k % 9 + 1))).otherwise(field(F.lit("ahead"))).alias("v32"),
            F.when(k % 4 == 0, field(F.lit("Jan./Jun."), "m")).alias("v43"),
        )
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", R.parsed(record).alias("r"))
    rows = rows.select("o_orderkey", M.issue(F.col("r")).alias("m"), M.issue_kind(F.col("r")).alias("kind"))
    return rows.select("o_orderkey", "m.id", F.col("m.publication_year").alias("year"), "m.volume", "m.publication_months.month", F.col("m.publication_months.range.start").alias("range_start"), F.col("m.publication_months.range.end").alias("range_end"), "kind")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 2")
def regular_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderkey") % 3 == 0, "pressrelease").when(F.col("o_orderkey") % 3 == 1, "ahead").otherwise("regular")
    return table(spark, sf_dir, "orders").where(C.is_regular_issue(kind)).select("o_orderkey")


@query("""
SELECT o_orderkey, 'P' || o_orderkey AS id, 'http://s/' || o_orderkey || '.xml' AS data, coalesce(l.n, 0) AS n_assets, coalesce(l.first_asset, '') AS first_asset, 'application/pdf' AS mimetype
FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_partkey) AS n, min('a' || l_partkey || '.jpg') AS first_asset FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey""")
def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of documents with their assets and one rendition, and what is in them."""
    name = F.concat(F.lit("a"), text_of(F.col("l_partkey")), F.lit(".jpg"))
    assets = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.struct(name.alias("asset_id"), F.concat(F.lit("http://s/"), name).alias("url")))).alias("assets"))
    rows = table(spark, sf_dir, "orders").join(assets, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k = text_of(F.col("o_orderkey"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rendition = F.array(F.struct(F.concat(k, F.lit(".PDF")).alias("filename"), F.concat(F.lit("http://s/"), k).alias("url"), F.lit(1).alias("size_bytes"), F.lit("en").alias("lang")))
    empty = F.array().cast("array<struct<asset_id:string,url:string>>")
    rows = rows.select("o_orderkey", M.document(F.concat(F.lit("P"), k), F.concat(F.lit("http://s/"), k, F.lit(".xml")), stamp, F.coalesce("assets", empty), rendition).alias("m"))
    v = F.get(F.col("m.versions"), F.lit(0))
    return rows.select("o_orderkey", "m.id", v["data"].alias("data"), F.size(v["assets"]).cast("long").alias("n_assets"), F.coalesce(F.array_min(F.map_keys(v["assets"])), F.lit("")).alias("first_asset"), F.get(v["renditions"], F.lit(0))["mimetype"].alias("mimetype"))


@query("""
SELECT l_orderkey, count(*) AS n_assets, list_sort(coalesce(list_distinct(list('f' || l_partkey) FILTER (WHERE l_partkey % 9 = 0)), [])) AS missing, count(*) FILTER (WHERE l_partkey % 9 = 0) = 0 AS complete FROM lineitem GROUP BY 1""", joined=("missing",))
def package_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.concat(F.lit("f"), text_of(F.col("l_partkey")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", wanted.alias("wanted"), F.when(F.col("l_partkey") % 9 != 0, wanted).alias("found"))
    return P.route(rows, "l_orderkey", "found", "wanted")


@query("""
WITH j AS (SELECT c_custkey AS journal_id, unnest(list_distinct(['p' || c_custkey, 'e' || c_custkey])) AS code FROM customer), i AS (SELECT o_orderkey, o_orderkey % 50 AS ord, unnest(list_distinct(['p' || o_custkey, 'e' || o_custkey])) AS code FROM orders),
p AS (SELECT DISTINCT journal_id, o_orderkey, ord FROM j JOIN i USING (code))
SELECT journal_id, list_transform(list_sort(list({'o': ord, 'k': o_orderkey})), lambda x: x.k) AS issues FROM p GROUP BY 1""", joined=("issues",))
def journal_issue_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = lambda c: F.array(F.concat(F.lit("p"), text_of(F.col(c))), F.concat(F.lit("e"), text_of(F.col(c))))
    journals = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), codes("c_custkey").alias("issns"))
    issues = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 50).alias("order"), codes("o_custkey").alias("issns"))
    out = P.journals_with_issues(journals, issues.unionByName(issues))
    return out.select("journal_id", F.transform("issues", lambda x: x["id"]).alias("issues"))


DOCS_SQL = "(SELECT o_orderkey AS pid, CASE WHEN o_custkey % 4 <> 0 THEN 'J' || o_custkey END AS journal, o_orderkey % 3 <> 0 AS is_issue, year(o_orderdate) AS year, o_orderkey % 2 + 1 AS v FROM orders)"


@query(f"""
WITH d AS (SELECT *, journal || CASE WHEN is_issue THEN '-' || year || '-v' || v ELSE '-aop' END AS bundle_id FROM {DOCS_SQL})
SELECT bundle_id, NOT bool_or(is_issue) AND NOT bool_or(pid % 9 = 0 AND is_issue) AS is_new, list_sort(list(pid)) AS items FROM d WHERE journal IS NOT NULL AND (NOT is_issue OR year >= 1994) GROUP BY 1""", joined=("items",))
def documents_in_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles of documents: those of issues from 1994 on are stored, ahead bundles are not."""
    return P.documents_in_bundles(*bundle_inputs(spark, sf_dir))[0]


@query(f"SELECT pid, CASE WHEN journal IS NULL THEN 'no journal' ELSE 'no issue' END AS error FROM {DOCS_SQL} WHERE journal IS NULL OR (is_issue AND year < 1994)")
def bundle_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.documents_in_bundles(*bundle_inputs(spark, sf_dir))[1]


def bundle_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), text_of(F.col("o_custkey"))
    journals = orders.where("o_custkey % 4 <> 0").select(F.concat(F.lit("e"), c).alias("code"), F.concat(F.lit("J"), c).alias("id")).distinct()
    documents = orders.select(k.alias("pid"), F.lit(None).cast("string").alias("pissn"), F.concat(F.lit("e"), c).alias("eissn"), F.lit("x").alias("issn"), text_of(F.year("o_orderdate")).alias("year"), F.when(k % 3 != 0, text_of(k % 2 + 1)).otherwise("").alias("volume"), F.when(k % 3 != 0, "").otherwise("ahead").alias("number"), F.lit("").alias("supplement"))
    stored = orders.where((F.year("o_orderdate") >= 1994) & (k % 3 != 0)).select(F.concat(F.lit("J"), c, F.lit("-"), text_of(F.year("o_orderdate")), F.lit("-v"), text_of(k % 2 + 1)).alias("bundle_id")).distinct()
    return documents, journals, stored


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'base/' || p_partkey || '.xml' WHEN p_partkey % 3 = 0 THEN lower(p_brand) || '/' || p_partkey || '.xml' END AS found FROM part""")
def file_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared path if such a file is there, else the one built from the journal's acronym."""
    parts, k = table(spark, sf_dir, "part"), text_of(F.col("p_partkey"))
    declared, built = F.concat(F.lit("base/"), k, F.lit(".xml")), F.concat(F.lower("p_brand"), F.lit("/"), k, F.lit(".xml"))
    files = parts.where("p_partkey % 2 = 0").select(declared.alias("file")).union(parts.where("p_partkey % 3 = 0").select(built))
    return L.with_fallback(parts, declared, built, files, "file").select("p_partkey", "found")


@query("""
WITH a AS (SELECT conv_id AS doc, 'n' || turn AS name, turn AS pos FROM conversations WHERE turn % 2 = 0), l AS (SELECT conv_id AS doc, 'n' || (turn - 1) AS name, turn AS link_pos FROM conversations WHERE turn % 2 = 1)
SELECT a.doc, a.name, pos, link_pos FROM a LEFT JOIN l ON a.doc = l.doc AND a.name = l.name""")
def anchor_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, t = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "doc"), F.col("turn")
    anchors = rows.where(t % 2 == 0).select("doc", F.concat(F.lit("n"), text_of(t)).alias("name"), t.alias("pos"))
    links = rows.where(t % 2 == 1).select("doc", F.concat(F.lit("#n"), text_of(t - 1)).alias("href"), t.alias("pos"))
    return L.anchors_with_links(anchors, links)


@query("""
WITH r AS (SELECT conv_id, list(role ORDER BY turn) AS refs FROM conversations GROUP BY 1), e AS (SELECT conv_id, unnest(refs) AS item, generate_subscripts(refs, 1) AS p FROM r)
SELECT e.conv_id, CAST(p AS VARCHAR) AS position, item, CASE WHEN c.turn % 2 = 0 THEN 'text ' || c.turn END AS text FROM e LEFT JOIN conversations c ON e.conv_id = c.conv_id AND c.turn = p AND c.turn % 2 = 0""")
def reference_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References with the texts of their positions."""
    rows = table(spark, sf_dir, "conversations")
    refs = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("refs"))
    texts = rows.where("turn % 2 = 0").select("conv_id", text_of(F.col("turn")).alias("position"), F.concat(F.lit("text "), text_of(F.col("turn"))).alias("text"))
    return L.by_ordinal(refs, "refs", texts, ["conv_id"], "position", "text")


@query("""
WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[\\s/>]', 1)) AS tag FROM pages)
SELECT page_id, count(*) AS n, list_sort(list_distinct(list(tag))) AS tags FROM t GROUP BY 1""", joined=("tags",))
def tag_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The elements of each page: how many, and their names."""
    tags = F.regexp_extract_all("html", F.lit(r"<([a-z][a-z0-9]*)[\s/>]"), F.lit(1))
    rows = table(spark, sf_dir, "pages").select("page_id", tags.alias("t")).where("size(t) > 0")
    return rows.select("page_id", F.size("t").cast("long").alias("n"), F.array_sort(F.array_distinct("t")).alias("tags"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'own' ELSE 'new' END AS document, CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'bundle' ELSE 'new bundle' END END AS bundle FROM orders""")
def completed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    dates = M.completed_dates(F.when(k % 2 == 0, "own").otherwise(""), F.when(k % 3 == 0, "bundle"), F.lit("new"), F.lit("new bundle"), k % 5 == 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.alias("d")).select("o_orderkey", "d.document", "d.bundle")


@query()
def text_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How close each heading and its page's first paragraph are, by matching blocks."""
    article = markup.element(F.col("html"), "article")
    a, b = markup.text_of(markup.element(article, "h1")), markup.text_of(markup.element(article, "p"))
    rows = table(spark, sf_dir, "pages").select("page_id", a.alias("a"), b.alias("b"))
    return rows.select("page_id", fuzzy.ratio("a", "b").alias("ratio"))


#: Known titles as they are, cut short, in other cases, in pairs and with words around them; and what is no title.
TITLES = [f(t, u) for t, u in zip(fuzzy.SECTION_TITLES, [*list(fuzzy.SECTION_TITLES)[1:], "Zzz"], strict=True) for f in (lambda t, u: t, lambda t, u: t[:-2], lambda t, u: t.upper(), lambda t, u: t.lower(), lambda t, u: f"{t} and {u}", lambda t, u: f"Study {t}", lambda t, u: f"{t} and other {u}")] + ["", " and ", "Reports", "Case study", "Supplementary", "Study subjects"]


def closest_sql() -> str:
    """The titles' types by the standard library's closest matches, title by title."""
    found = {t: "|".join(fuzzy.SECTION_TITLES[m] for part in t.split(" and ") for m in get_close_matches(part, list(fuzzy.SECTION_TITLES), 1, 0.6)) for t in TITLES}
    return f"CASE o_orderkey % {len(TITLES)} {' '.join(f'WHEN {i} THEN {chr(39)}{found[t]}{chr(39)}' for i, t in enumerate(TITLES))} END"


@query(f"SELECT o_orderkey, {closest_sql()} AS section_type FROM orders")
def fuzzy_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.get(F.array(*[F.lit(t) for t in TITLES]), (F.col("o_orderkey") % len(TITLES)).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fuzzy.section_type(title).alias("section_type"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Fig1.JPG' WHEN 1 THEN 'Fig1.JPG' WHEN 2 THEN 'Table.png' END AS found FROM orders")
def closest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names as they are spelt in a folder."""
    names = F.array(*[F.lit(x) for x in ("fig1.jpg", "Fig1.JPG", "Table.png", "fig10.jpg")])
    k = F.col("o_orderkey") % 4
    word = F.when(k == 0, "Fig1.JPG").when(k == 1, "fig1.JPG").when(k == 2, "tABLE.png").otherwise("fig2.jpg")
    return table(spark, sf_dir, "orders").select("o_orderkey", fuzzy.closest_name(word, names).alias("found"))


@query("""
SELECT l_orderkey AS folder, 'a' || l_partkey || '.jpg' AS asset, 'a' || l_partkey || x AS file FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), (VALUES ('.tif'), ('.png')) AS v(x) WHERE (x = '.tif' AND l_partkey % 2 = 0) OR (x = '.png' AND l_partkey % 3 = 0)
UNION ALL SELECT DISTINCT l_orderkey, 'a' || l_partkey || '.jpg', 'a' || l_partkey || '.jpg' FROM lineitem""")
def asset_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a folder that are an asset in another format, or the asset itself."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("folder"), "l_partkey")
    stem = F.concat(F.lit("a"), text_of(F.col("l_partkey")))
    assets = rows.select("folder", F.concat(stem, F.lit(".jpg")).alias("asset"))
    kinds = F.array(F.lit(".jpg"), F.when(F.col("l_partkey") % 2 == 0, ".tif"), F.when(F.col("l_partkey") % 3 == 0, ".png"))
    files = rows.select("folder", F.explode(F.array_compact(F.transform(kinds, lambda x: F.concat(stem, x)))).alias("file"))
    return L.alternatives(assets, files, "folder")


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'en=/a/v1n2/x.pdf,pt=/a/v1N2/y.pdf' WHEN 1 THEN 'en=/a/v1N2/x.pdf' ELSE '' END AS renditions FROM orders""")
def fixed_renditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendition paths whose issue folder is spelt otherwise than the issue's."""
    k = F.col("o_orderkey") % 3
    paths = F.when(k == 0, F.create_map(F.lit("en"), F.lit("/a/v1n2/x.pdf"), F.lit("pt"), F.lit("/a/v1N2/y.pdf"))).when(k == 1, F.create_map(F.lit("en"), F.lit("/a/v1n2/x.pdf"), F.lit("es"), F.lit("/b/z.pdf"))).otherwise(F.create_map(F.lit("en"), F.lit("/c/z.pdf")))
    fixed = R.fixed_renditions(paths, F.lit("v1N2"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.transform(F.array_sort(F.map_entries(fixed)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("renditions"))


@query("""
SELECT c_custkey, printf('%04d-0000', c_custkey % 10000) AS id, '2000-01-0' || (c_custkey % 9 + 1) || 'T00:00:00.000000Z' AS created, c_name AS title, 'iso ' || c_name AS title_iso, CASE WHEN c_custkey % 2 = 0 THEN 'short' END AS short_title, 'acr' || c_custkey AS acronym,
  CASE WHEN c_custkey % 2 = 0 THEN '1111-1111' END AS print_issn, '2222-2222' AS electronic_issn, 'en:mission,pt:' || c_name AS mission, 'C@1999-01-02T00:00:00.000000Z,S@?:r' AS status, 'A,B' AS subject_areas, 'sponsor ' || c_nationkey AS sponsors, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS email,
  CASE WHEN c_custkey % 5 = 0 THEN 'next' END AS next_journal, 'p1/city/BR,p2/city/BR' AS institutions FROM customer""")
def journal_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journal manifests from title records in JSON, and what is in them."""
    k, name = F.col("c_custkey"), F.col("c_name")
    one = lambda c: F.array(F.create_map(F.lit("_"), c if isinstance(c, Column) else F.lit(c)))
    made = lambda **x: F.create_map(*[v for key, c in x.items() for v in (F.lit("_" if key == "text" else key), c if isinstance(c, Column) else F.lit(c))])
    record = F.to_json(
        F.struct(
            one(F.format_string("%04d-0000", k % 10000)).alias("v400"), one(F.format_string("2000010%d", k % 9 + 1)).alias("v940"), one(name).alias("v100"), one(F.concat(F.lit("iso "), name)).alias("v151"), F.when(k % 2 == 0, one("short")).alias("v150"),
            one(F.concat(F.lit("ACR"), text_of(k))).alias("v68"), F.array(made(text="2222-2222", t="ONLIN"), F.when(k % 2 == 0, made(text="1111-1111", t="PRINT")).otherwise(made(text="0", t="X"))).alias("v435"),
            F.array(made(text="mission", l="en"), made(text=name, l="pt")).alias("v901"), F.array(made(a="19990102", b="C"), made(a="bad", b="S", c="r")).alias("v51"), F.array(made(text="A"), made(text="B"), made(text="")).alias("v441"),
            one(F.concat(F.lit("sponsor "), text_of(F.col("c_nationkey")))).alias("v140"), F.when(k % 3 == 0, one(F.col("c_mktsegment"))).alias("v64"), F.when(k % 5 == 0, one("next")).alias("v710"), F.array(made(text="p1"), made(text="p2")).alias("v480"), one("city").alias("v490"), one("BR").alias("v310"),
        )
    )
    # each record is parsed once, and rows of a small file, which are much work each, are many tasks'
    rows = shared.spread(table(spark, sf_dir, "customer"), JOURNALS_A_TASK).select("c_custkey", R.parsed(record).alias("r"))
    rows = rows.select("c_custkey", R.manifest_of_journal(F.col("r")).alias("m"))
    said = lambda c, *parts: F.array_join(F.transform(c, lambda x: F.concat(*[p if isinstance(p, Column) else p(x) for p in parts])), ",")
    at = lambda n: lambda x: F.coalesce(x[n], F.lit("?"))
    status = F.array_join(F.transform("m.status_history", lambda x: F.concat(x["status"], F.lit("@"), F.coalesce(x["date"], F.lit("?")), F.coalesce(F.concat(F.lit(":"), x["reason"]), F.lit("")))), ",")
    return rows.select(
        "c_custkey", *[f"m.{n}" for n in ("id", "created", "title", "title_iso", "short_title", "acronym", "print_issn", "electronic_issn")], said("m.mission", at("language"), F.lit(":"), at("value")).alias("mission"), status.alias("status"), F.array_join("m.subject_areas", ",").alias("subject_areas"),
        said("m.sponsors", at("name")).alias("sponsors"), F.col("m.contact.email").alias("email"), "m.next_journal", said("m.institution_responsible_for", at("name"), F.lit("/"), at("city"), F.lit("/"), at("country_code")).alias("institutions"),
    )


@query("SELECT doc_id, lower(trim(replace(replace(text, 'the ', ''), 'de ', ''))) AS text FROM documents")
def remove_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.remove_texts(F.col("text"), ["the ", "de "]).alias("text"))
