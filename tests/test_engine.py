"""Operators, sources, streams, and every query against its SQL."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quire import catalog
from quire.operators import groups as G
from quire.operators import lookups as L
from quire.operators import similarity
from quire.operators import store as S
from quire.sources import catalogue
from quire.streaming import ingest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_resolve_first_takes_what_is_found(spark):
    lookup = spark.createDataFrame([("b", "J1")], "code string, journal string")
    docs = spark.createDataFrame([(1, "a", " b "), (2, None, None), (3, "b", "x")], "id int, k1 string, k2 string")
    assert sorted((r["id"], r["journal"] or "", r["matched_by"] or "") for r in L.resolve_first(docs, ["k1", "k2"], lookup, "code", "journal").collect()) == [(1, "J1", "k2"), (2, "", ""), (3, "J1", "k1")]


def test_last_wins_and_first_wins(spark):
    given = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), ("", 4, "q")], "k string, n int, v string")
    assert rows(L.last_wins(given, "k", F.col("n")), "k", "v") == [("a", "y")]
    assert rows(G.first_wins(given.where("k = 'a'"), ["k"], F.col("n")), "k", "v") == [("a", "x")]


def test_contained_assets_prefer_the_same_name(spark):
    assets = spark.createDataFrame([("d", "f1.jpg"), ("d", "f2.jpg"), ("d", "f3.jpg")], "folder string, asset string")
    files = spark.createDataFrame([("d", "f1.jpg"), ("d", "xf1.tif"), ("d", "xf2.tif"), ("d", "f2.png"), ("e", "f3.jpg")], "folder string, file string")
    assert [(r["asset"], r["file"]) for r in L.contained_assets(assets, files, "folder").orderBy("asset").collect()] == [("f1.jpg", "f1.jpg"), ("f2.jpg", "xf2.tif"), ("f3.jpg", None)]


def test_stems_in_names_by_brute_force(spark):
    rng = random.Random(3)
    name = lambda n: "".join(rng.choice("abé.") for _ in range(rng.randrange(n)))
    names = [(rng.choice("xy"), name(12)) for _ in range(300)] + [("x", None)]
    stems = [(rng.choice("xyz"), name(7)) for _ in range(120)] + [("x", ""), ("z", ""), ("y", None)]
    made = lambda rows, c: spark.createDataFrame(rows, f"g string, {c} string")
    for q in (1, 3, 4):
        got = rows(L.containing(made(stems, "s"), made(names, "f"), "g", "s", "f", q))
        assert got == sorted({(g, s, f) for g, s in stems for h, f in names if g == h and s is not None and f is not None and s in f})


def test_a_folder_of_many_files(spark):
    folder = F.concat(F.lit("d"), (F.col("id") % 1).cast("string")).alias("folder")
    files = spark.range(100_000).select(folder, F.format_string("img%06d.tif", "id").alias("file"))
    assets = spark.range(0, 100_000, 20).select(folder, F.format_string("%06d.jpg", "id").alias("asset"))
    out = L.contained_assets(assets, files, "folder")
    assert out.count() == 5000 and out.where(F.concat(F.lit("img"), F.replace("asset", F.lit(".jpg"), F.lit(".tif"))) != F.col("file")).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    # no join on the folder alone, and none without a key
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_fallback_path(spark):
    given = spark.createDataFrame([(1, "a", "b"), (2, "x", "b"), (3, "x", "y")], "id int, first string, second string")
    files = spark.createDataFrame([("a",), ("b",)], "file string")
    assert [r["found"] for r in L.with_fallback(given, F.col("first"), F.col("second"), files, "file").orderBy("id").collect()] == ["a", "b", None]


def test_anchors_with_links(spark):
    anchors = spark.createDataFrame([("d", "x", 5), ("d", "y", 6)], "doc string, name string, pos int")
    links = spark.createDataFrame([("d", "#x", 1), ("d", "#x", 2), ("e", "#x", 3), ("d", "http://x", 4)], "doc string, href string, pos int")
    assert sorted((r["name"], r["link_pos"] or 0) for r in L.anchors_with_links(anchors, links).collect()) == [("x", 1), ("x", 2), ("y", 0)]


def test_by_ordinal(spark):
    refs = spark.createDataFrame([("p", ["a", "b", "c"])], "pid string, refs array<string>")
    texts = spark.createDataFrame([("p", "2", "second"), ("q", "1", "other")], "pid string, pos string, text string")
    assert [(r["pos"], r["item"], r["text"]) for r in L.by_ordinal(refs, "refs", texts, ["pid"], "pos", "text").orderBy("pos").collect()] == [("1", "a", None), ("2", "b", "second"), ("3", "c", None)]


def test_consecutive_drops_an_incomplete_run(spark):
    given = spark.createDataFrame([(i,) for i in range(10)], "n int").withColumn("p", F.lit(1))
    assert [r["items"] for r in G.consecutive(given, ["p"], ["n"], 3, "n").orderBy("run").collect()] == [[0, 1, 2], [3, 4, 5], [6, 7, 8]]


def test_store(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "e"), (3, "d")], "id int, v string")
    inserted, refused = S.insert_if_absent(stored, new, ["id"], F.col("v"))
    assert rows(inserted) == [(3, "d")]
    assert rows(refused) == [(2, "c")]
    assert rows(S.insert_if_absent(stored.union(inserted), new, ["id"], F.col("v"))[0]) == []
    bundles = spark.createDataFrame([("x", [1, 2]), ("y", [])], "bundle_id string, items array<int>")
    left, cleaned, report = S.roll_back(stored, bundles, spark.createDataFrame([(2,), (9,)], "id int"), "id", "items")
    assert rows(left) == [(1, "a")]
    assert [(r["bundle_id"], r["items"]) for r in cleaned.orderBy("bundle_id").collect()] == [("x", [1]), ("y", [])]
    assert rows(report) == [(2, "ROLLEDBACK"), (9, "MISSING")]


def test_shared_words_find_what_brute_force_finds(spark, monkeypatch):
    texts = ["a b c d", "a b c x", "q r", "", "a b", "x y z a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    items = spark.createDataFrame(list(enumerate(texts)), "item int, text string")
    want = sorted((i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if (A := set(a.split())) and (B := set(b.split())) and len(A & B) / len(B) >= 0.5)
    assert rows(similarity.contained_items(docs, items, "doc", "item", 0.5), "doc", "item") == want
    monkeypatch.setattr(similarity, "BROADCAST_WORDS", 0)
    far = similarity.contained_items(docs, items, "doc", "item", 0.5)
    assert rows(far, "doc", "item") == want
    # what meets the probed words is words, not documents' arrays
    assert re.search(r"Generate explode\(dw#\d+\), \[doc#\d+\], false, \[w#\d+\]", far._jdf.queryExecution().executedPlan().toString())


def test_iso2709(spark, tmp_path):
    def record(*fields):
        body, directory = b"", b""
        for tag, value in fields:
            data = value.encode("cp1252") + b"\x1e"
            directory += b"%03d%04d%05d" % (tag, len(data), len(body))
            body += data
        base = 24 + len(directory) + 1
        whole = b"%05d0000000%05d0004500" % (base + len(body) + 1, base) + directory + b"\x1e" + body
        return whole + b"\x1d"

    (tmp_path / "x.iso").write_bytes(b"\r\n".join([record((35, "0001-3714"), (12, "café “x”^aone")), record((12, "b"), (12, "c"))]))
    found = catalogue.read_iso2709(spark, str(tmp_path / "x.iso"))
    assert [[tuple(f) for f in r["fields"]] for r in found.collect()] == [[("35", "0001-3714"), ("12", "café “x”^aone")], [("12", "b"), ("12", "c")]]
    assert found.select(catalogue.as_record(F.col("fields")).alias("r")).collect()[1]["r"] == {"v12": ["b", "c"]}


def test_json_lines_documents_and_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"mfn": 3, "v1": []}\nnot json\n\n')
    good, bad = catalogue.read_json_lines(spark, str(tmp_path / "a.json"))
    assert rows(good, "mfn") == [(3,)]
    assert rows(bad) == [("not json",)]
    (tmp_path / "S1.en.xml").write_text("<a>\n</a>")
    assert rows(catalogue.read_documents(spark, str(tmp_path)), "pid", "content") == [("S1", "<a>\n</a>")]
    assert rows(catalogue.list_files(spark, str(tmp_path), "*.xml"), "name", "length") == [("S1.en.xml", 8)]
    (tmp_path / "t.csv").write_text("p,,a\\b.xml,2019,,,acr,v1,en\n")
    assert catalogue.read_articles(spark, str(tmp_path / "t.csv")).first()["acron"] == "acr"
    for i, order in enumerate(("1", "2")):
        (tmp_path / f"imported.{i}.json").write_text('{"pid": "x", "order": "%s"}\n' % order)
    assert rows(catalogue.read_import_results(spark, str(tmp_path / "imported.*.json")), "pid", "order") == [("x", "2")]


def test_write_by_year(spark, tmp_path):
    given = spark.createDataFrame([("2019-01", 1), ("2020", 2), (None, 3)], "d string, n int")
    catalogue.write_by_year(given, "d", str(tmp_path / "out"))
    assert rows(spark.read.json(str(tmp_path / "out")).where("year = 2019"), "n") == [(1,)]


def test_stream_ingest_is_idempotent(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "table")
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string").write.parquet(source)
    for run in ("one", "two"):
        ingest.ingest_once(ingest.read_stream(spark, source, "id int, v string"), target, str(tmp_path / run), "id")
    assert rows(spark.read.parquet(target).drop("key_part")) == [(1, "a"), (2, "c")]


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = catalog.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    assert sorted(tuple(plain(v) for v in r) for r in got.select(*columns).collect()) == sorted(tuple(plain(v) for v in r) for r in want)


@needs_data
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@needs_data
def test_conversion_keeps_the_words(spark):
    worst = catalog.queries()["conversion_diff"](spark, SF).agg(F.min("ratio")).first()[0]
    assert worst > 0.95
    assert catalog.queries()["html_to_article"](spark, SF).where("html_left > 0").count() == 0


@needs_data
def test_text_ratio_by_matching_blocks(spark):
    from difflib import SequenceMatcher

    from quire.functions import markup as M

    article = M.element(F.col("html"), "article")
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", M.text_of(M.element(article, "h1")).alias("a"), M.text_of(M.element(article, "p")).alias("b")).collect()
    want = {r["page_id"]: None if r["a"] is None or r["b"] is None else SequenceMatcher(None, r["a"], r["b"], autojunk=False).ratio() for r in pages}
    got = {r["page_id"]: r["ratio"] for r in catalog.queries()["text_ratio"](spark, SF).collect()}
    assert got == pytest.approx(want)
    assert len(got) > 0


def test_placed_and_most_frequent(spark):
    items = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 3, None), ("b", 1, 5), ("b", 2, 3)], "g string, i int, o int")
    assert rows(G.placed(items, "g", F.col("o"), F.col("g") == "b", F.col("i")), "g", "i", "position") == [("a", 1, 2), ("a", 2, 1), ("a", 3, 3), ("b", 1, 1), ("b", 2, 2)]
    counted = spark.createDataFrame([("x", 2), ("y", 1), ("x", 1), ("z", 3)], "k string, n long")
    assert rows(G.most_frequent(counted, "k", "n", 2), "k", "n", "rank") == [("x", 3, 1), ("z", 3, 2)]
