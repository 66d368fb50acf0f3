"""Searches, range joins, SimHash groups, archives, components and the pipeline against brute force."""

from __future__ import annotations

import base64
import hashlib
import importlib
import gzip
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import simhash, topk, vectors, warc
from quire.llm.components import components

VEC = "vec_id long, embedding array<float>, label int"


def groups_of(ids, pairs):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in ids}


@pytest.fixture
def clustered(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([c + rng.normal(scale=s, size=(25, 16)) for c, s in zip(centres, np.linspace(0.05, 0.5, 12), strict=True)]).astype(np.float32)
    x[7] = x[3]
    x[9] = 2 * x[3]
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(len(x))]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [None] + [1.0] * 15, 1), (1004, [float("nan")] + [1.0] * 15, 1), (1005, [float("inf")] + [1.0] * 15, 1), (1006, [1.0, 0.0], 1), (1007, [1.0, 0.001], 1), (1008, [-0.0, 3.0], 1), (1009, [0.0, 3.0], 1)]
    return spark.createDataFrame(rows + odd, VEC).withColumn("x", F.lit("clash")).repartition(3), rows + odd


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [16384, 16])
def test_range_join_matches_brute_force(clustered, block):
    table, rows = clustered
    got = {r["vec_id"]: r for r in vectors.near_duplicates(table, cosine=0.9, block=block).collect()}
    assert len(got) == len(rows)
    good = [(i, np.array(v)) for i, v, _ in rows if usable(v) and any(v)]
    pairs = [(i, j) for i, a in good for j, b in good if i != j and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9]
    links = groups_of([i for i, *_ in rows], pairs)
    for i, *_ in rows:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (sum(a == i for a, _ in pairs), links[i], links[i] == i)


def test_pivots_cut_the_work_of_clustered_vectors():
    rng = np.random.default_rng(0)
    x = [c + rng.normal(scale=0.01, size=32) for c in rng.normal(size=(40, 32)) for _ in range(50)]
    pivots = vectors.choose_pivots(x, 50_000_000, float(np.sqrt(0.2)))
    assert len(pivots[0]) > 1
    unit = vectors.unit(np.stack(x))
    _, row, _ = vectors.members(unit, pivots[0], float(np.sqrt(0.2)))
    assert len(row) < 0.5 * len(x) * len(pivots[0])


def test_range_join_of_nothing(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], VEC)).count() == 0


def test_top_k_matches_brute_force(spark, clustered):
    table, rows = clustered
    dup = [(0, rows[0][1], 0)]  # a row of its own, as query and as candidate
    got = topk.top_k(table.drop("x").unionByName(spark.createDataFrame(dup, VEC)), k=5, chunk=64, block=2).collect()
    good = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float))) for i, v, _ in [*rows, *dup] if usable(v)]
    want = []
    for n_q, (q, a) in enumerate(good):
        if q % 50 == 0:
            best = sorted((-int(a @ b), i) for n_b, (i, b) in enumerate(good) if n_b != n_q and len(a) == len(b))[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(spark.createDataFrame([], VEC)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500, i) for i in range(501, 540)] + [(i, i + 1) for i in range(600, 640)] + [(700, 700)]
    want = groups_of(sorted({x for p in pairs for x in p}), pairs)
    assert {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bucket", [8192, 8])
def test_close_fingerprints_match_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = {b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(4))) for b in base for _ in range(6)} | {0, 1, 3}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in near)
    want = groups_of(fps, [(a, b) for a in fps for b in fps if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2])
    edges = simhash.close_pairs(spark.createDataFrame([(x,) for x in fps], "fp long"))
    got = groups_of(fps, [(r["a"], r["b"]) for r in edges.collect()])
    assert got == want


def test_thresholds_keep_the_pigeonhole():
    for seed in range(5):
        sample = np.random.default_rng(seed).integers(-(2**63), 2**63 - 1, 500)
        sample[:100] = sample[0]
        for reach in (1, 2, 3):
            parts = simhash.plan(sample, 10**6, reach)
            assert sum(t + 1 for _, t in parts) == reach + 1
            used = [b for own, _ in parts for b in own]
            assert len(used) == len(set(used))
    assert simhash.allocate([[0, 5, 9], [0, 1, 2], [0, 5, 5]], 0) == (6, [-1, 0, 1])


def test_simhash_groups(spark):
    docs = "doc_id long, text string"
    text = "alpha beta gamma delta epsilon zeta eta theta " * 40
    rows = [(5, text), (3, text.upper()), (9, text + "end"), (1, "quite another text of few words"), (7, None), (6, ""), (8, " \n"), (None, text), (5, text)]
    out = simhash.near_duplicates(spark.createDataFrame(rows, docs).withColumn("fp", F.lit(1)))
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in out.collect())
    assert (3, 3) in got and got.count((5, 3)) == 2 and (1, 1) in got and (7, 6) in got and (8, 6) in got and (0, 3) in got and len(got) == len(rows)
    kept = simhash.one_of_each(spark.createDataFrame(rows, docs))
    assert {r["doc_id"] for r in kept.collect()} >= {3, 1, 6} and kept.count() == len({c for _, c in got})
    unnamed = [(None, "one two three four five six"), (None, "one two three four five six"), (None, "other words all along this line"), (None, text), (3, text)]
    left = simhash.one_of_each(spark.createDataFrame(unnamed, docs).withColumn("component", F.lit("clash")))
    assert sorted((r["doc_id"] or 0, r["text"][:5]) for r in left.collect()) == [(0, "one t"), (0, "other"), (3, "alpha")]
    assert simhash.near_duplicates(spark.createDataFrame([], docs)).count() == 0
    assert simhash.one_of_each(spark.createDataFrame([], docs)).count() == 0


PAGE = "page_id long, url string, html string, captured timestamp"


def test_archives(spark, tmp_path, monkeypatch):
    rng = random.Random(11)
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    html = [None, "", tricky, tricky, "<p>é</p>", "x" * 200_000] + [f"<p>{rng.randrange(25)}</p>" for _ in range(60)]
    rows = [(i, rng.choice([f"http://www.b{i % 4}.example.org:80/P?q={i % 3}#f", "https://a.example.com", None, "odd\r\nurl"]), h) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("captured", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") % 5)).repartition(3)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, archives=[(None, 7)])
    bounds = warc.splitters(pages, 4)
    out = warc.read_index(spark, path, bounds).orderBy("index_part", "index_pos").collect()
    last = {}
    for i, _, h in rows:
        last[h or ""] = i
    want = {i: (len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if last[h or ""] == i else "revisit", None if last[h or ""] == i else last[h or ""]) for i, _, h in rows}
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out} == want
    types = lambda: sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.with_types(pages, 0).collect())
    few = types()
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)  # many shared payloads: by bitmap
    assert types() == few
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in out]
    assert keys == sorted(keys) and len({r["index_part"] for r in out}) > 1
    assert "org,example,b1)/p?q=1" in {k for k, *_ in keys}
    assert warc.archive(pages.limit(0)).count() == 0
    for r in out:  # each record stands where the index says
        name = next(p for p in pathlib.Path(path).rglob("*.gz") if r["archive"].endswith(p.name))
        whole = gzip.decompress(name.read_bytes())[r["record_offset"] : r["record_offset"] + r["record_length"]]
        assert whole.startswith(b"WARC/1.1\r\n") and f"X-Page: {r['page_id']}\r\n".encode() in whole


def test_archives_of_odd_pages(spark, tmp_path):
    rows = [(None, "http://a.b/", "same", 0), (5, "http://a.b/", "same", 1), (5, "http://a.b/", "same", 1), (4, None, "same", 90), (6, "http://a.b/c", "y" * 70_000, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, t long")
    pages = pages.withColumn("captured", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("t"))).withColumn("payload", F.lit("clash")).withColumn("archive", F.lit(1))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = warc.archive(pages, str(tmp_path / "odd")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = sorted(((r["page_id"] is not None, r["page_id"] or 0, r["record_type"], r["refers_to"], r["captured"]) for r in out))
    assert got == [(False, 0, "revisit", 5, "2023-11-14T22:13:20Z"), (True, 4, "revisit", 5, "2023-11-14T22:14:50Z"), (True, 5, "response", None, "2023-11-14T22:13:21Z"), (True, 5, "response", None, "2023-11-14T22:13:21Z"), (True, 6, "response", None, "2023-11-14T22:13:23Z")]


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(12)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(((str(rng.randrange(9)), "", rng.randrange(50)) for _ in range(rng.randrange(12))), key=warc.order) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted((c for r in runs for c in r), key=warc.order)


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    rng = random.Random(13)
    words = {"en": "the of and that with this from were house river".split(), "de": "der die und nicht ist auch eine haus fluss tal".split()}
    rows, marks = [], []
    for i in range(240):
        lang = ("en", "de")[i % 2]
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "er", "en", "s"]) for _ in range(60))
        if i % 6 == 0:
            text += " idiot"
        marks.append((i, 1, int(i % 6 == 0)))
        rows.append((i, text + "\nshared footer line", lang, "s", len(text)))
    rows += [(1000 + i, rows[1][1], "de", "s", 1) for i in range(5)] + [(2000, None, None, None, None), (2001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        assert docs.columns == columns, name
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    clean = {i for i in range(240) if i % 6}
    assert len(clean - seen[0]) <= 2 and len(seen[0] & {i for i in range(240) if i % 6 == 0}) <= 2
    assert len(clean & seen[0] - seen[1]) <= 2 and 2000 not in seen[1] and 2001 not in seen[1]
    assert seen[2] == seen[1]
    assert docs.where(F.contains("text", F.lit("shared footer"))).count() == 0
    assert not seen[3] & set(range(1000, 1005)) and 1 in seen[3]
    packed = pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == seen[3]
