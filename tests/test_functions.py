"""Golden values of the column functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.functions import checks as C
from quire.functions import dates as D
from quire.functions import ids as I
from quire.functions import markup as M
from quire.functions import records as R
from quire.functions import text as T
from quire.functions import xmlmeta as X


@pytest.fixture
def value(spark):
    """The value of a column expression over no table."""
    return lambda column: spark.range(1).select(column.alias("x")).first()["x"]


def lits(*values):
    return [F.lit(v).cast("string") for v in values]


@pytest.mark.parametrize(
    ("a", "b", "ratio", "percent"),
    [("a b c", "a b c", 1.0, "100.00%"), ("a b c d e f g h i j", "a b c d e f g h", 0.8, "80.00%"), ("a b c d e f g h i j", "a b c d", 0.4, "40.00%"), ("", "", 0.0, "0.00%")],
)
def test_jaccard(value, a, b, ratio, percent):
    found = T.jaccard(F.lit(a), F.lit(b))
    assert value(found) == pytest.approx(ratio)
    assert value(T.percent(found)) == percent


def test_normalize_text(value):
    assert value(T.normalize_text(F.lit("  Açaí—É, straße_1!  "))) == "acai e strasse_1"
    assert value(T.normalize_text(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(("text", "number"), [("2. ref", "2"), ("2   ref", "2"), ("<span>2<span>", "2"), ("ref ref", ""), ("<font size='2'>ref</font>", "")])
def test_leading_number(value, text, number):
    assert value(T.leading_number(F.lit(text))) == number


def test_fix_prefix(value):
    assert value(T.fix_prefix(F.lit('<p w:atributo="abc">'))) == '<p w-atributo="abc">'
    assert value(T.fix_prefix(F.lit('<p w: atributo="abc">'))) == '<p w: atributo="abc">'


def test_names(value):
    assert tuple(value(T.stem_and_extension(F.lit("/a/b/x.en.html")))) == ("x", ".html")
    assert tuple(value(T.name_and_languages(F.lit("x.en.pdf")))) == ("x", "en")
    assert tuple(value(T.name_and_languages(F.lit("x.pdf")))) == ("x", "pt")
    assert value(T.join_texts(F.array(*lits(" a ", "", "b")))) == "a b"
    assert value(T.first_two_words_match(F.lit("Figure 1"), F.lit("Fig. 1 shows"))) is True
    assert value(T.first_two_words_match(F.lit("Table 1"), F.lit("Fig. 1 shows"))) is False


@pytest.mark.parametrize(
    ("said", "iso"),
    [("2019-01-02", "2019-01-02"), ("2019-12", "2019-12-01"), ("2019", "2019-01-01"), ("2020-Jun-03", "2020-06-03"), ("2020-July-03", "2020-07-03"), ("2020-Oct-Dec", "2020-12-01"), ("2020-06-40", "2020-06-01"), ("2020-30-03", "2020-01-01"), ("2021-02-30", "2021-02-01")],
)
def test_parse_date(value, said, iso):
    assert value(D.parse_date(F.lit(said))) == f"{iso}T00:00:00.000000Z"


def test_partial_dates(value):
    assert tuple(value(D.partial_date(F.lit("19970300")))) == ("1997", "03", "")
    assert tuple(value(D.partial_date(F.lit("2020-1-24")))) == ("2020", "01", "24")
    assert value(D.partial_date(F.lit("n.d."))) is None
    both = value(D.document_dates(*lits(None, "20200124", "20210101", "19970300")))
    assert tuple(both["document"]) == ("2020", "01", "24")
    assert tuple(value(D.month_range(F.lit("Jan./Jun.")))) == (1, 6)
    assert tuple(value(D.month_range(F.lit("Feb./Feb.")))) == (2, 2)


@pytest.mark.parametrize(
    ("parts", "found"),
    [(("ISSN", "YEAR", "VOLUME", "03", "SUPPL"), "ISSN-YEAR-vVOLUME-n3-sSUPPL"), (("ISSN", "YEAR", "19", "00", None), "ISSN-YEAR-v19"), (("ISSN", "YEAR", "00", "19", None), "ISSN-YEAR-n19"), (("ISSN", "YEAR", "00", "00", None), None)],
)
def test_issue_id(value, parts, found):
    assert value(I.issue_id(*lits(*parts))) == found
    assert value(I.bundle_id(*lits(*parts))) == (found or "ISSN-aop")


def test_volume_and_number(value):
    assert tuple(value(I.volume_and_number(*lits("01", "009")))) == ("1", "9")
    assert tuple(value(I.volume_and_number(*lits(None, "ahead")))) == (None, None)


def test_document_ids(spark):
    rows = spark.createDataFrame([("585b0b68-aa1d-41ab-8f19-aaa37c516337",), (None,)], "u string").withColumn("id", I.base48("u")).withColumn("back", I.base48_uuid("id")).collect()
    assert [tuple(r) for r in rows] == [("585b0b68-aa1d-41ab-8f19-aaa37c516337", "FX6F3cbyYmmwvtGmMB7WCgr", "585b0b68-aa1d-41ab-8f19-aaa37c516337"), (None, None, None)]


def test_ids_and_orders(value):
    assert value(I.pid_of_path(F.lit("/x/1234-5678/2020/0001/00002.mst"))) == "S1234-56782020000100002"
    assert value(I.pid_of_path(F.lit("/x/readme.mst"))) is None
    assert value(I.order_of(*lits("S1234-5678202000010000x", "7", "12"))) == "00007"
    assert value(I.issue_token(F.lit("2 Suppl 1"))) == "02-s01"
    assert value(I.issue_supplement(F.lit("2 Suppl 1"))) == "1"
    assert value(I.issue_number(F.lit("suppl 1"))) is None
    assert value(I.asset_name(*lits("pkg", "fig", "fig01.jpg"))) == "pkg-g01.jpg"


def test_guarded_update(value):
    update = lambda cur, new: tuple(value(C.guarded_update("language", *lits(cur, new))))
    assert update("en", "pt") == ("en", "kept")
    assert update("xyz", "pt") == ("pt", "update")
    assert update("xyz", "long") == ("xyz", "invalid")
    assert update("en", "en") == ("en", "same")
    assert tuple(value(C.guarded_update("title", *lits("a", "b")))) == ("b", "update")


def test_predicates(value):
    assert value(C.is_asset_href(F.lit("/img/revistas/x/a.jpg"))) is True
    assert value(C.is_asset_href(F.lit("http://x.y/a.jpg"))) is False
    assert value(C.is_asset_href(F.lit(None).cast("string"))) is False
    assert value(C.is_online_only(*lits("", "1", "", "e1"))) is True
    assert value(C.is_online_only(*lits("", "1", "", ""))) is False
    assert value(C.is_ahead_of_print(*lits("0", "ahead"))) is True
    assert value(C.is_regular_issue(F.lit("pressrelease"))) is False


def test_records(value):
    record = F.lit('{"v31":[{"_":"31"}],"v43":[{"n":["n. 3"]}],"v35":[{"_":"0001-3714"}],"v435":[{"_":"1234-5678","t":"x"},{"_":"0001-3714"}],"mfn":1}')
    assert value(R.field(R.parsed(record), "v31")) == "31"
    assert value(R.field(R.parsed(record), "v43", "n")) == "n. 3"
    assert value(R.path(record, "$.nothing", "default")) == "default"
    assert value(R.path(F.lit("{not json"), "$.x", "default")) == "default"
    assert value(R.issns_of_issue(R.parsed(record))) == ["0001-3714", "1234-5678"]
    assert [tuple(x) for x in value(R.subfields(F.lit("zero^One^2two^^")))] == [("_", "zero"), ("o", "ne"), ("2", "two^")]
    assert value(R.issue_folder(*lits("31", None, "2", "1"))) == "v31n2s1"
    title = F.lit('{"v100":[{"_":"sample"}],"v940":[{"_":"20190128"}],"v50":[{"_":"C"}],"v400":[{"_":"0001-3714"}]}')
    manifest = value(R.manifest_of_journal(R.parsed(title)))
    assert (manifest["id"], manifest["created"], manifest["title"]) == ("0001-3714", "2019-01-28T00:00:00.000000Z", "sample")


def test_article_body(value):
    html = '<div ID="x"><!-- c --><font>Hi</font> <b>bold</b><br>more <a href="mailto:a@b.c">me</a> <a href="#f1">1</a><a href="http://x.y">w</a></div><p><img src="a.jpg"></p><p></p><h2>T</h2><ul><li>one</li></ul>'
    body = value(M.to_article_body(F.lit(html), F.lit(1)))
    assert "<bold>bold</bold>" in body
    assert '<p content-type="break">more' in body
    assert '<email xlink:href="a@b.c">me</email>' in body
    assert '<xref rid="f1">1</xref>' in body
    assert '<ext-link ext-link-type="uri" xlink:href="http://x.y">w</ext-link>' in body
    assert '<p><graphic xlink:href="a.jpg"/></p>' in body
    assert '<p content-type="h2">T</p>' in body
    assert '<list list-type="bullet"><list-item><p>one</p></list-item></list>' in body
    assert "<p></p>" not in body
    assert "font" not in body
    assert "<!--" not in body


def test_ids_are_fixed(value):
    assert value(M.fix_ids(F.lit('<p id="A-1"/><xref rid="1b">x</xref>'), F.lit(2))) == '<p id="a1-body2"/><xref rid="replaced_by_1b-body2">x</xref>'


def test_text_of(value):
    assert value(M.text_of(F.lit("<p>a&amp;lt;<script>x</script>b<!-- <p> --></p>\n c"))) == "a&lt; b c"
    assert value(M.text_of(F.lit(""))) == ""


def test_metadata(value):
    xml = '<?xml version="1.0"?><!DOCTYPE article><article xmlns:xlink="l" xml:lang="en"><front><journal-meta><issn pub-type="ppub">1111-1111</issn></journal-meta><article-meta><article-id pub-id-type="doi">https://doi.org/10.1/x</article-id><pub-date pub-type="epub"><year>2019</year><month>3</month></pub-date><volume>0</volume></article-meta></front><body><graphic xlink:href="a.jpg"/><graphic xlink:href="http://x/b.jpg"/></body></article>'
    found = value(X.metadata(F.lit(xml)))
    assert (found["issn"], found["doi"], found["volume"], found["assets"], found["languages"]) == ("1111-1111", "10.1/x", None, ["a.jpg"], ["en"])
    assert tuple(found["document_date"]) == ("2019", "03", "")


def test_manifests(value):
    from quire.functions import fuzzy
    from quire.functions import manifests as M

    record = R.parsed(F.lit('{"v35":[{"_":"0001-3714"}],"v65":[{"_":"19980900"}],"v31":[{"_":"29"}],"v32":[{"_":"3"}]}'))
    found = value(M.issue(record))
    assert (found["id"], found["publication_year"], found["publication_months"]["month"], found["publication_months"]["range"]) == ("0001-3714-1998-v29-n3", "1998", 9, None)
    assert value(M.issue(R.parsed(F.lit("{}")))) is None
    assert value(M.issue_kind(R.parsed(F.lit('{"v41":[{"_":"pr"}]}')))) == "pressrelease"
    assert value(M.media_type(F.lit("a.PDF"))) == "application/pdf"
    assert value(M.media_type(F.lit("a"))) == "application/octet-stream"
    assert value(fuzzy.section_type(F.lit("Materials and Methods"))) == "materials|methods"


def test_ratio(spark):
    from quire.functions import fuzzy

    rows = spark.createDataFrame([("abcd", "bcde"), ("", ""), (None, "a"), ("a", "b")], "a string, b string").select(fuzzy.ratio("a", "b").alias("r")).collect()
    assert [r["r"] for r in rows] == [0.75, 1.0, None, 0.0]


def test_xml_edits(value):
    from quire.functions import xmledit as E

    meta = lambda inner: f'<article xml:lang="en"><front><journal-meta><journal-id>a</journal-id><journal-title-group><t/></journal-title-group></journal-meta><article-meta>{inner}</article-meta></front></article>'
    assert value(E.with_date(F.lit(meta("")), "epub", F.lit("2020"), F.lit("05"), F.lit(""))) == meta('<pub-date pub-type="epub"><month>05</month><year>2020</year></pub-date>')
    old = meta('<pub-date pub-type="epub"><year>1</year></pub-date><volume>1</volume>')
    assert value(E.with_date(F.lit(old), "epub", F.lit("2020"), F.lit(None).cast("string"), F.lit(""))) == meta('<pub-date pub-type="epub"><year>2020</year></pub-date><volume>1</volume>')
    assert value(E.with_language(F.lit("<article><p/></article>"), F.lit("pt"))) == '<article xml:lang="pt"><p/></article>'
    assert value(E.with_language(F.lit(meta("")), F.lit("pt"))) == meta("")
    assert value(E.with_article_id(F.lit(meta("<volume/>")), F.lit("00012"), kind="other")) == meta('<volume/><article-id pub-id-type="other">00012</article-id>')
    issns = F.create_map(F.lit("ppub"), F.lit("2"), F.lit("epub"), F.lit("1"))
    assert '</journal-title-group><issn pub-type="epub">1</issn><issn pub-type="ppub">2</issn></journal-meta>' in value(E.with_issns(F.lit(meta("")), issns))
    there = meta("").replace("</journal-meta>", "<issn>9</issn></journal-meta>")
    assert value(E.with_issns(F.lit(there), issns)) == there
    assert value(E.upgraded_dates(F.lit(meta('<pub-date date-type="pub"><year>1</year></pub-date>')))) == meta('<pub-date date-type="pub" publication-format="electronic"><year>1</year></pub-date>')
    assert value(E.without_counts(F.lit(meta("<counts><x/></counts><counts/>")))) == meta("<counts/>")
    assert value(E.with_names(F.lit('<g xlink:href="a.jpg"/><g xlink:href="b.jpg"/>'), F.create_map(F.lit("a.jpg"), F.lit("p-ga.jpg")))) == '<g xlink:href="p-ga.jpg"/><g xlink:href="b.jpg"/>'


def test_nesting_of_any_depth(value):
    from quire.functions import markup as M

    deep = "<b>" * 40 + "</b>" * 40
    assert value(M.drop_empty(F.lit(f"x{deep}y"))) == "xy"
    assert value(M.unnest_paragraphs(F.lit("<p>" * 9 + "t" + "</p>" * 9))) == "<p>t</p>"


def test_log_lines_of_each_kind(spark):
    from quire.operators import reports as P

    lines = [
        "2020-08-26 13:46:05 ERROR [module.packing] [S0066-782X2020000500001] - Could not find rendition 'bases/pdf/abc/v114n4s1/pt_0066.pdf' during packing XML '0066-782X-abc.xml'",
        "2020-08-26 14:49:55 ERROR [module.packing] Could not find the XML file 'cadbto/nahead/2526.xml'.",
        "2020-09-11 08:35:56 ERROR [module.inserting] The bundle '0036-3634-2009-v45-n4' was not updated. During executions this following exception was raised 'x'.\n",
        "2020-09-11 08:35:56 ERROR [module.inserting] No ISSN in document 'JwqGdMDrdcV3Z7MFHgtKvVk'\n",
        "2020-08-26 14:49:55 ERROR [module] Could not update xml 'a.xml'. The exception 'boom' was raised.",
        "2020-08-26 14:49:55 ERROR [module] something else",
        "short line",
    ]
    got = {r["message"][:20]: r for r in P.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert len(got) == 6
    first = got["[S0066-782X202000050"]
    assert (first["pid"], first["uri"], first["xml"], first["error"], first["error_group"], first["module"]) == ("S0066-782X2020000500001", "bases/pdf/abc/v114n4s1/pt_0066.pdf", "0066-782X-abc.xml", "resource-not-found", "renditions", "[module.packing]")
    assert got["The bundle '0036-363"]["bundle"] == "0036-3634-2009-v45-n4" and got["No ISSN in document "]["pid"] == "JwqGdMDrdcV3Z7MFHgtKvVk"
    assert got["Could not update xml"]["exception"] == "boom" and got["something else"]["error"] is None
    assert P.errors_without_pid(P.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))).count() == 3


def test_fixed_renditions(value):
    paths = F.create_map(F.lit("pt"), F.lit("/img/v31n2S1/a.pdf"))
    assert value(R.fixed_renditions(paths, F.lit("v31n2S1"))) == {"pt": "/img/v31n2S1/a.pdf"}
    lower = F.create_map(F.lit("pt"), F.lit("/img/v31n2s1/a.pdf"), F.lit("en"), F.lit("/other/b.pdf"))
    assert value(R.fixed_renditions(lower, F.lit("v31n2S1"))) == {"pt": "/img/v31n2S1/a.pdf"}


def test_bundle_and_dated(value):
    from quire.functions import manifests as MF

    made = value(MF.bundle(F.lit("0000-0000-2020-v1-n2"), F.lit("t")))
    assert (made["id"], made["created"], made["items"], made["metadata"]) == ("0000-0000-2020-v1-n2", "t", [], {})
    assert value(MF.bundle(F.lit(""), F.lit("t"))) is None
    assert [tuple(x) for x in value(MF.dated(F.lit("t"), F.lit("v")))] == [("t", "v")]


def test_ids_and_files_whole(spark, tmp_path):
    from quire.sources import catalogue

    (tmp_path / "ids.txt").write_text("S1\n\nS2\nS1\n")
    (tmp_path / "a.bin").write_bytes(b"\x00\xff")
    assert sorted(r["pid"] for r in catalogue.read_ids(spark, str(tmp_path / "ids.txt")).collect()) == ["S1", "S2"]
    assert [(r["name"], r["length"], bytes(r["content"])) for r in catalogue.read_binary(spark, str(tmp_path), "*.bin").collect()] == [("a.bin", 2, b"\x00\xff")]


def test_package_name_by_metadata(value):
    names = ("issn", "acron", "volume", "issue", "fpage", "lpage", "elocation_id", "doi", "other", "bundle_year")
    made = lambda **known: F.struct(*[F.lit(known.get(n)).cast("string").alias(n) for n in names])
    name = lambda **known: value(I.package_name_of(made(**known), F.lit("file")))
    assert name(issn="1-2", acron="abc", volume="3", issue="4 suppl 1", fpage="5", lpage="9") == "1-2-abc-3-04-s01-5-9"
    assert name(issn="1-2", acron="abc", doi="10.1/x.y", bundle_year="2020") == "1-2-abc-ahead-2020-x.y"
    assert name(issn="1-2", acron="abc", other="00012", bundle_year="2020") == "1-2-abc-ahead-2020-00012"
    assert name(issn="1-2", acron="abc", volume="3", other="00012") == "1-2-abc-3-00012"
    assert name() == "file"


def test_log_formats_from_templates(spark):
    from quire.operators import reports as P

    lines = ["ERROR|2020-08-26|[m.x]|No ISSN in document 'abc'", "2020-08-26 13:46:05 WARN [m.y] Disk  'a.b' is (full) now", "short"]
    got = P.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), messages=[("full", "disks", "Disk '{uri}' is (full)"), ("issn", None, "No ISSN in document '{pid}'")], formats=("<level>|<date>|<module>|<message>", P.FORMAT)).collect()
    assert sorted((r["date"], r["time"] or "", r["level"], r["module"], r["error"], r["error_group"] or "", r["uri"] or "", r["pid"] or "") for r in got) == [
        ("2020-08-26", "", "ERROR", "[m.x]", "issn", "", "", "abc"),
        ("2020-08-26", "13:46:05", "WARN", "[m.y]", "full", "disks", "a.b", ""),
    ]
