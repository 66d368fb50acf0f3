"""Documents as tokens and rows of nodes, against an XML parser; setters that keep documents well formed."""

from __future__ import annotations

import random
import re
from xml.etree import ElementTree
from xml.parsers import expat

import pytest
from pyspark.sql import functions as F

from quire.functions import xmledit as E
from quire.functions import xmlmeta as X
from quire.functions import xmltree as T
from quire.operators import trees


def parsed(xml):
    """[(start, end, depth, parent's start, position, name)] by expat, places in characters from 1; None where it breaks."""
    data, out, stack = xml.encode(), [], []
    p = expat.ParserCreate()
    place = lambda: len(data[: p.CurrentByteIndex].decode()) + 1
    count = {0: 0}

    def open_(name):
        parent = stack[-1][0] if stack else 0
        count[parent] = count.get(parent, 0) + 1
        return [place(), None, len(stack) + 1, parent, count[parent], name]

    def start(name, _):
        out.append(open_(name))
        stack.append(out[-1])
        tag = re.match(rb"""<(?:[^<>"']|"[^"]*"|'[^']*')*>""", data[p.CurrentByteIndex :]).group().decode()
        out[-1][1] = out[-1][0] + len(tag) if tag.endswith("/>") else None

    def end(_):
        node = stack.pop()
        node[1] = node[1] or place() + len(data[p.CurrentByteIndex :].split(b">")[0].decode()) + 1

    def comment(text):
        node = open_("#comment")
        node[1] = node[0] + len(text) + 7
        out.append(node)

    p.StartElementHandler, p.EndElementHandler, p.CommentHandler = start, end, comment
    try:
        p.Parse(data, True)
    except expat.ExpatError:
        return None
    return [tuple(n) for n in out]


PIECES = ["<a>", "</a>", "<b x='1'>", "</b>", "<c/>", '<d y="a&amp;b" z=\'"\'/>', "text", "é 日 👍", "&amp;", "&#233;", "&#x1F44D;", "&nbsp;", "&#0;", "&", "<", ">", "]]>", "<!-- n -->", "<!-- a--b -->", "<!---->", "<![CDATA[<x>&]]>", "<?pi d?>", "<?xml?>", '<e p="1" p="2"/>', "<f q=1/>", '<g r="<"/>', "< h/>", "<i/ >", "</ a>", "<j\n k = 'v'\t/>", '<l m="1"n="2"/>', "\n", "<o", "<p.q-r:s/>", "<1/>", "\x01", '"', "'"]


def random_documents(n, seed=4):
    rng = random.Random(seed)
    for _ in range(n):
        open_, out = ["r"], "<r>"
        for _ in range(rng.randrange(9)):
            if rng.random() < 0.75:  # keeps to the rules
                pick = rng.choice(["open", "close", "c", "t", "m"])
                if pick == "open":
                    open_.append(rng.choice("ab"))
                    out += f"<{open_[-1]}>"
                elif pick == "close" and len(open_) > 1:
                    out += f"</{open_.pop()}>"
                else:
                    out += {"c": rng.choice(PIECES[4:6]), "m": rng.choice(PIECES[17:20:2])}.get(pick, rng.choice(PIECES[6:11]))
            elif rng.random() < 0.4:
                out += rng.choice(PIECES)
        out += "".join(f"</{x}>" for x in reversed(open_)) if rng.random() < 0.9 else ""
        yield rng.choice(["", "", "", '<?xml version="1.0"?>', "<!-- before -->", "x"]) + out + rng.choice(["", "", "", "\n<!-- after -->", "<r/>", "y"])


def test_faults_are_where_a_parser_finds_them(spark):
    docs = [*random_documents(3000), *PIECES, "", "<a>" * 3000 + "</a>" * 3000, "<a" + "".join(f" x{i}='{i}'" for i in range(6000)) + "/>", "<a><!--" + "x" * 200_000 + "--></a>", "<a b='" + "y" * 200_000 + "'/>"]
    got = spark.createDataFrame(list(enumerate(docs)), "i int, x string").select("i", T.fault(F.col("x")).alias("f")).collect()
    wrong = [(docs[r["i"]][:200], r["f"]) for r in got if (r["f"] is None) != (parsed(docs[r["i"]]) is not None)]
    assert wrong == []
    assert sum(r["f"] is None for r in got) > 500 and sum(r["f"] is not None for r in got) > 500


def test_nodes_are_a_parsers(spark):
    docs = [d for d in random_documents(800, seed=9) if not d.startswith("<?xml")]
    table = spark.createDataFrame(list(enumerate(docs)), "i int, x string").withColumn("n", F.lit("clash")).repartition(3)
    got = {}
    for r in trees.nodes(table, "i", "x").collect():
        got.setdefault(r["i"], []).append((r["start"], r["end"], r["depth"], r["parent"], r["position"], r["name"]))
    for i, d in enumerate(docs):
        want = parsed(d)
        mine = sorted(got.get(i, []))
        assert mine == sorted(want or []), d


def test_broken_documents_go_apart(spark):
    docs = spark.createDataFrame([(1, "<a><b/></a>"), (2, "<a>"), (3, None), (4, "")], "i int, x string")
    good, bad = trees.routed(docs, "x")
    assert [r["i"] for r in good.collect()] == [1]
    assert {r["i"]: r["error"] for r in bad.collect()} == {2: "4: not closed: a", 3: "no document", 4: "no root"}
    assert trees.nodes(docs, "i", "x").count() == 2 and trees.nodes(docs.limit(0), "i", "x").count() == 0


@pytest.fixture
def value(spark):
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]


META = '<article xml:lang="en"><front><article-meta>{}</article-meta></front><sub-article><front-stub><article-meta><volume>9</volume></article-meta></front-stub></sub-article></article>'


def test_metadata_of_broken_documents_and_odd_values(spark):
    odd = META.format('<article-id pub-id-type="other" title=">">a␟b</article-id><article-id specific-use=\'pid-v2\'><![CDATA[x<y]]></article-id><related-article><volume>1</volume></related-article><volume><b>7</b>&#8364;</volume><issue/><pub-date pub-type="collection"><year>1999</year></pub-date>')
    docs = spark.createDataFrame([(1, odd), (2, odd[:-3]), (3, ""), (4, None), (5, odd.replace("<issue/>", "&nbsp;")), (6, "<x/>")], "i int, x string")
    x = F.col("x")
    got = {r["i"]: r for r in docs.select("i", X.metadata(x).alias("m"), X.issns(x).alias("issns"), X.renditions(x).alias("r"), X.journal_meta(x).alias("j"), X.assets(x).alias("a"), X.languages(x).alias("l")).collect()}
    m = got[1]["m"]
    assert (m["other"], m["pid_v2"], m["volume"], m["issue"], m["bundle_year"], m["error"], got[1]["l"]) == ("a␟b", "x<y", "7€", None, "1999", None, ["en"])
    assert tuple(m["document_date"]) == (None, None, None) and tuple(m["bundle_date"]) == ("1999", "", "")
    assert [got[i]["m"]["error"] for i in (2, 3, 4)] == [f"{len(odd) - 9}: malformed tag", "no root", "no document"] and "reference" in got[5]["m"]["error"]
    for i in (2, 3, 4, 5):
        assert all(v is None for n, v in got[i]["m"].asDict().items() if n != "error")
        assert got[i]["issns"] is got[i]["r"] is got[i]["j"] is got[i]["a"] is got[i]["l"] is None
    assert got[6]["m"]["error"] is None and got[6]["m"]["assets"] == [] and got[6]["issns"] is None and got[6]["r"] == {}


def test_repeated_languages_and_types_keep_the_last(value):
    xml = '<article><front><journal-meta><issn pub-type="epub">1</issn><issn pub-type="epub">2</issn><issn>3</issn></journal-meta><article-meta><self-uri xml:lang="en" xlink:href="a"/><self-uri xlink:href="b" xml:lang="en"/></article-meta></front></article>'
    assert value(X.issns(F.lit(xml))) == {"epub": "2"} and value(X.renditions(F.lit(xml))) == {"en": "b"}


ODD = "a&b<c>\"d'$1\\e"


def test_setters_escape_and_keep_to_the_first_metadata(value):
    lit = lambda c: F.lit(c).cast("string")
    ids = META.format('<volume>1</volume><article-id specific-use="pid-v3" pub-id-type="publisher-id">old</article-id>')
    made = {
        "added": E.with_article_id(F.lit(META.format("")), lit(ODD), "pid-v3"),
        "kept": E.with_article_id(F.lit(ids), lit(ODD), "pid-v3"),
        "replaced": E.with_article_id(F.lit(ids), lit(ODD), "pid-v3", override=True),
        "dated": E.with_date(F.lit(META.format("")), "epub", lit("2020"), lit(ODD), lit("")),
        "issns": E.with_issns(F.lit("<article><journal-meta><journal-id/><journal-id>a</journal-id></journal-meta></article>"), F.create_map(lit("epub"), lit(ODD))),
        "language": E.with_language(F.lit("<article/>"), lit(ODD)),
        "names": E.with_names(F.lit('<g xlink:href="x&amp;y.jpg"/>'), F.create_map(lit("x&y.jpg"), lit(ODD))),
    }
    made = {n: value(c) for n, c in made.items()}
    read = {n: ElementTree.fromstring(x.replace("xlink:", "")) for n, x in made.items()}
    first = lambda n, path: read[n].find(f"front/article-meta/{path}")
    assert first("added", "article-id").text == first("replaced", "article-id").text == ODD and first("kept", "article-id").text == "old"
    assert made["replaced"].count("<article-id") == 1 and made["kept"] == ids
    assert first("dated", "pub-date/month").text == ODD and made["dated"].count("<pub-date") == 1
    assert read["issns"].find(".//issn").text == ODD and read["language"].attrib.popitem()[1] == ODD and read["names"].get("href") == ODD
    assert all(value(T.fault(F.lit(x))) is None for x in made.values())


def test_dates_by_version(value):
    day = [F.lit(x) for x in ("2020", "05", "")]
    for version, document, bundle in (("v-1.9", 'publication-format="electronic" date-type="pub"', 'publication-format="electronic" date-type="collection"'), ("v-1.8", 'pub-type="epub"', 'pub-type="collection"'), ("", 'pub-type="epub"', 'pub-type="epub-ppub"')):
        xml = META.format("").replace("<article ", f'<article specific-use="{version}" ', 1)
        node = lambda attributes: f"<pub-date {attributes}><month>05</month><year>2020</year></pub-date>"
        dated = value(E.with_document_date(F.lit(xml), *day))
        assert dated == xml.replace("</article-meta>", node(document) + "</article-meta>", 1)
        both = value(E.with_bundle_date(F.lit(dated), *day))
        assert both == xml.replace("</article-meta>", node(document) + node(bundle) + "</article-meta>", 1)
        assert value(E.with_bundle_date(F.lit(both), F.lit("2021"), F.lit(None).cast("string"), F.lit(""))) == dated.replace("</article-meta>", f"<pub-date {bundle}><year>2021</year></pub-date></article-meta>", 1)
        assert value(E.without_bundle_date(F.lit(both))) == dated and value(E.without_bundle_date(F.lit(dated))) == dated


def test_references_go_only_if_all_are_found(spark):
    body = lambda refs, head="<p>REFS</p>": f"<body><p>t</p>{head}<!-- ref -->{refs}</body>"
    refs = "<p>a<!-- end-ref --></p><p><i>b<!-- end-ref --></i></p><ul><li>c</li><!-- end-ref --></ul>"
    docs = spark.createDataFrame([(1, body(refs), 3), (2, body(refs), 2), (3, body(refs, "<p>Other</p>"), 3), (4, body(""), 0), (5, "<body><p>a<!-- end-ref -->", 1), (6, None, 1), (7, body("<p>x<p>y<!-- end-ref --></p><!-- end-ref --></p>"), 2)], "i int, x string, n int")
    got = {r["i"]: (r["x"], r["n_removed"]) for r in trees.without_references(docs, "i", "x", "n").collect()}
    assert got[1] == ("<body><p>t</p><!-- ref --><ul><!-- end-ref --></ul></body>", 4)
    assert got[2] == (body(refs), 0)
    assert got[3] == ("<body><p>t</p><p>Other</p><!-- ref --><ul><!-- end-ref --></ul></body>", 3)
    assert got[4] == (body(""), 0) and got[5] == ("<body><p>a<!-- end-ref -->", 0) and got[6] == (None, 0)
    assert got[7] == ("<body><p>t</p><!-- ref --></body>", 2)
