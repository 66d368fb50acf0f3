"""Work and memory that grow no faster than the input: what plans have once, what isn't shuffled, and hot keys."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from random import Random

from pyspark.sql import functions as F

from quire import catalog
from quire.functions import ids as I
from quire.functions import xmlmeta as X
from quire.operators import diff as D
from quire.operators import lookups as L
from quire.operators import store, trees

SF = "/root/testdata/sf0.001"


def plan(rows) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        rows.explain()
    return out.getvalue()


def test_journal_records_are_parsed_once(spark):
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    try:
        assert plan(catalog.queries()["journal_manifest"](spark, SF)).count("sponsor ") == 1
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)


def test_overlap_pairs_are_not_shuffled(spark):
    """Pairs leave the explosion of two blocks: above it is no exchange and no aggregate."""
    left = spark.range(30).selectExpr("id as l", "array(1, cast(null as int)) as k")
    right = spark.range(2500).selectExpr("id as r", "case when id < 2400 then array(1, 1, 2) when id < 2450 then array(3) end as k")
    out = L.overlap_join(left, right, "l", "k", "r", "k")
    assert out.count() == out.distinct().count() == 30 * 2400
    before = plan(out).split("Generate explode")[0]
    assert "Exchange" not in before and "Aggregate" not in before


def shuffled(spark) -> int:
    """Bytes that the session's stages have written for shuffles so far."""
    jvm, store = spark._jvm, spark.sparkContext._jsc.sc().statusStore()
    none = jvm.java.util.ArrayList
    stages = store.stageList(none(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), none())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_overlap_ids_are_not_shuffled_for_each_class_they_meet(spark):
    """Each of 60 classes meets each of 60; ids go by once for each of their two keys."""
    rows = lambda name, base: spark.range(6000).selectExpr(f"xxhash64(id, {base}) as {name}", f"array(-1L, {base} + id % 60) as k")
    before = shuffled(spark)
    out = L.overlap_join(rows("l", 0), rows("r", 100), "l", "k", "r", "k")
    assert out.count() == 6000 * 6000
    assert shuffled(spark) - before < 2_000_000


def test_overlap_of_hot_keys_by_brute_force(spark, monkeypatch):
    rng = Random(7)
    made = lambda n, ids: [(rng.choice([None, *range(ids)]), rng.choice([None, [rng.choice([None, *range(6)]) for _ in range(rng.randrange(4))]])) for _ in range(n)]
    left, right = made(300, 150), made(200, 120)
    keys = lambda rows: {i: {k for j, ks in rows if j == i for k in ks or [] if k is not None} for i, _ in rows}
    want = sorted(repr((i, j)) for i, a in keys(left).items() for j, b in keys(right).items() if a & b)
    frames = spark.createDataFrame(left, "l int, k array<int>"), spark.createDataFrame(right, "r int, k array<int>")
    for side, block, squares in ((4000, 125, 1000), (10, 3, 10_000), (10, 3, 4), (1, 1, 10_000)):
        monkeypatch.setattr(L, "SIDE", side)
        monkeypatch.setattr(L, "BLOCK", block)
        monkeypatch.setattr(L, "SQUARES", squares)
        assert sorted(repr(tuple(r)) for r in L.overlap_join(*frames, "l", "k", "r", "k").collect()) == want


def test_pairs_of_a_hot_key_are_many_tasks_work(spark, monkeypatch):
    monkeypatch.setattr(L, "SIDE", 100)
    monkeypatch.setattr(L, "BLOCK", 25)
    rows = lambda name: spark.range(1000).selectExpr(f"id as {name}", "array(1) as k")
    out = L.overlap_join(rows("l"), rows("r"), "l", "k", "r", "k")
    assert out.count() == 1_000_000
    assert largest(out) < 100_000
    # two blocks are in the join's loop at a time: compiled into it, the explosions would hold the pairs of all blocks that one meets
    monkeypatch.setattr(L, "SIDE", 4000)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        lines = plan(L.overlap_join(rows("l"), rows("r"), "l", "k", "r", "k")).splitlines()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    join = next(x for x in lines if "Join " in x)
    assert "Generate explode(__b_ids" in next(x for x in lines if "Generate" in x) and "*(" in next(x for x in lines if "Generate" in x)
    assert "*(" not in join


def by_table(a, b):
    """A longest common subsequence by the plain table of lengths."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for x in range(len(a) - 1, -1, -1):
        for y in range(len(b) - 1, -1, -1):
            best[x][y] = best[x + 1][y + 1] + 1 if a[x] == b[y] else max(best[x + 1][y], best[x][y + 1])
    kept, x, y = [], 0, 0
    while x < len(a) and y < len(b):
        if a[x] == b[y]:
            kept.append((x, y))
            x, y = x + 1, y + 1
        elif best[x + 1][y] >= best[x][y + 1]:
            x += 1
        else:
            y += 1
    return kept


def test_exact_gaps_by_rows_of_bits():
    random = Random(3)
    for _ in range(300):
        a, b = ([random.choice("abcdef") for _ in range(random.randrange(0, 40))] for _ in "ab")
        pad = ["-"] * random.randrange(3)
        at = len(pad)
        assert [(x - at, y) for x, y in D.exact([*pad, *a, "x"], [*b, "y"], at, at + len(a), 0, len(b))] == by_table(a, b)


def test_runs_of_many_documents_leave_together(spark):
    """A small document isn't a batch of its own, and a document's runs are shuffled once for its report and what else is asked."""
    docs = spark.range(2000).selectExpr("id", "concat('A b ', id) as text").coalesce(1)
    pairs = docs.selectExpr("id as key", "text as a", "lower(text) as b").toPandas()
    compare = D.compared("key")
    assert len(list(compare(iter([pairs])))) == 1
    found = D.diff(docs.withColumnRenamed("id", "key"), docs.selectExpr("id as key", "lower(text) as text"), "key")
    assert D.report(found, "key").where("before_length = 3 and after_length = 3 and differs").count() == 2000


def test_package_names_work_metadata_out_once(spark):
    names = ("issn", "acron", "volume", "issue", "fpage", "lpage", "elocation_id", "doi", "other", "bundle_year")
    meta = F.struct(*[F.concat(F.lit(n), F.lit("-mark-" + n)).alias(n) for n in names])
    assert str(I.package_name_of(meta, F.lit("file"))).count("-mark-doi") == 1


def test_journal_of_an_import_looks_for_no_fault(spark):
    given = spark.createDataFrame([('<a><journal-meta><issn pub-type="epub">1</issn></journal-meta></a>', None), ("<a>", "4: not closed: a")], "xml string, error string")
    column = X.journal_meta(F.col("xml"), F.col("error"))
    assert "is due" not in str(column)
    assert [a == b for a, b in given.select(column, X.journal_meta(F.col("xml"))).collect()] == [True, True]


def largest(rows) -> int:
    return rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_rows_without_a_key_or_with_a_hot_one_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS", 500)
    shown = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.range(4000).selectExpr("id", "case when id % 4 = 0 then 'none' when id % 4 = 1 then 'hot' end as a", "concat(' ', id) as b")
        out = L.resolve_first(rows, ["b", "a"], spark.createDataFrame([("hot", "H"), ("5", "F")], "code string, v string"), "code", "v")
        found = {(r["v"], r["matched_by"]): r["count"] for r in out.groupBy("v", "matched_by").count().collect()}
        assert found == {("H", "a"): 999, ("F", "b"): 1, (None, None): 3000}
        assert largest(out) < 900
        asked = rows.selectExpr("id", "a as previous_pid", "trim(b) as pid_v2")
        pids = store.pid_pairs(asked, spark.createDataFrame([("hot", "H"), ("7", "S"), ("7", "Z"), ("5", "F")], "v2 string, v3 string"), F.lit("new"))
        assert {(r["pid_v3"], r["is_new"]): r["count"] for r in pids.groupBy("pid_v3", "is_new").count().collect()} == {("H", False): 1000, ("S", False): 1, ("new", True): 2999}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", shown)


def test_tasks_grow_with_files_and_documents(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS", 50)
    monkeypatch.setattr(trees, "DOCUMENTS", 10)
    files = spark.range(1000).selectExpr("id % 10 as folder", "concat('f', id, '.tif') as file")
    out = L.alternatives(files.selectExpr("folder", "replace(file, 'tif', 'jpg') as asset"), files, "folder")
    assert (out.count(), out.rdd.getNumPartitions()) == (1000, 40)
    docs = spark.range(200).selectExpr("id", "'<a><b/><c/></a>' as xml")
    assert plan(trees.nodes(docs, "id", "xml")).count("REPARTITION_BY_NUM") == 1
    assert trees.nodes(docs, "id", "xml").count() == 600


def test_pages_are_compared_in_one_scan(spark):
    out = catalog.queries()["conversion_diff"](spark, SF)
    shown = plan(out)
    assert "Join" not in shown and "Exchange" not in shown
    assert shown.count("<article(?=") == 1
    assert out.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_elements_are_renamed_whatever_their_case(spark):
    from quire.functions import markup as M

    page = "<H2 id='x'>a</H2><UL><LI>b</LI></UL><hr/><Em>c</eM><i>d</i><img><link><dl><dd>e</dd></dl><BLOCKQUOTE>f</BLOCKQUOTE>"
    want = '<p content-type="h2">a</p><list list-type="bullet"><list-item><p>b</p></list-item></list><p content-type="hr"/><italic>c</italic><italic>d</italic><img><link><def-list><def-item>e</def-item></def-list><disp-quote>f</disp-quote>'
    assert spark.createDataFrame([(page,), ("plain",), (None,)], "h string").select(M.rename(F.col("h"))).collect() == [(want,), ("plain",), (None,)]


def test_assets_meet_their_folders_files_in_one_row(spark, monkeypatch):
    """Small folders without a join, large ones by joins; both give what the joins give for all."""
    rng = Random(11)
    folders = [None, *range(20)]
    names = ["a.jpg", "b.jpg", ".jpg", "x-a.TIF", "a-1.png", "bb.gif", "ab", None]
    assets = spark.createDataFrame([(rng.choice(folders), rng.choice(names)) for _ in range(150)], "folder int, asset string")
    files = spark.createDataFrame([(rng.choice(folders), rng.choice(names)) for _ in range(120)] + [(3, f"f{i}a.tif") for i in range(150)], "folder int, file string")
    rows = lambda out: sorted(map(repr, out.collect()))
    want = rows(L.assets_of_large(assets, files, "folder"))
    assert rows(L.contained_assets(assets, files, "folder")) == want
    few = files.where("folder <> 3")
    assert "Join" not in plan(L.contained_assets(assets, few, "folder"))
    monkeypatch.setattr(L, "FEW_FILES", 5)
    assert rows(L.contained_assets(assets, files, "folder")) == want


def test_references_are_looked_for_where_there_are_some(spark, monkeypatch):
    rows = [
        (1, "<a><p>References<!-- end-ref --></p><!-- ref --><p>x<!-- end-ref --></p></a>", 2),
        (2, "<a><sec>Refs<p>x<!-- end-ref --></p></sec><!-- ref --><p>y<!-- end-ref --></p></a>", 2),
        (3, "<a><p>Other</p><!-- ref --><p>y<!-- end-ref --></p></a>", 1),
        (4, "<a><p>References</p><!-- ref --></a>", 0),
        (5, "<a><p>References</p><!-- ref --><p>y<!-- end-ref --></p></a>", 2),
        (6, "<a><p>x<!-- end-ref --></a>", 1),
        (7, None, 1),
    ]
    docs = spark.createDataFrame(rows, "i int, x string, n int")
    seen, plain = [], trees.nodes
    monkeypatch.setattr(trees, "nodes", lambda some, *a: seen.append(sorted(r[0] for r in some.collect())) or plain(some, *a))
    out = trees.without_references(docs, "i", "x", "n")
    assert seen == [[1, 2, 3, 5, 6]]
    assert plan(out).split("Initial Plan")[0].count("ExistingRDD") == 1  # texts are read once beside the nodes
    want = {1: ("<a><!-- ref --></a>", 2), 2: ("<a><!-- ref --></a>", 2), 3: ("<a><p>Other</p><!-- ref --></a>", 1)}
    assert {r["i"]: (r["x"], r["n_removed"]) for r in out.collect()} == {i: want.get(i, (x, 0)) for i, x, _ in rows}
