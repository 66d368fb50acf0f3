"""Filter audit, token files and centroid clustering against brute force, and on odd rows."""

from __future__ import annotations

import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import audit, centroids, tokenfiles
from quire.llm.packing import vocabulary_path

LABELS = "doc_id long, quality int, toxic int"
TEXTS = "doc_id long, text string, lang string"


# filter audit


def brute_audit(docs, labels):
    """Each order run over the rows, filter after filter."""
    fails = []
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    for i, text, lang in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails.append({
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        })
    out, shapley = {}, {}
    for part in {lang or "" for _, _, lang in docs}:
        rows = [(f, i) for f, (i, _, lang) in zip(fails, docs, strict=True) if (lang or "") == part]
        for order in permutations("ABCDE"):
            left = rows
            for k, f in enumerate(order):
                kept, gone = [r for r in left if not r[0][f]], [r for r in left if r[0][f]]
                redundant = sum(r[0][f] for r in rows) - len(gone)
                unique = sum(r[0][f] and sum(r[0].values()) == 1 for r in rows)
                marked = [sum(i in s for _, i in gone if i is not None) for s in (good, toxic)]
                out[part, "".join(order), k + 1] = [len(kept), len(gone), redundant, unique, *marked]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                left = kept
    return {(p, o, k): (*v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


def test_audit_against_every_order_run_alone(spark):
    rng = np.random.default_rng(11)
    plain = [" ".join(f"w{x}" for x in rng.integers(0, m, n)) for n, m in ((99, 9000), (100, 90000), (130, 100), (400, 9000), (5, 3))]
    texts = [*plain, *(t.upper() for t in plain), *(t + " 5%" for t in plain), "", None, " \t\n\x0b\f\r ", "A B " * 120, "É" * 10 + "A", "É" * 9 + "A", "\n".join(plain), "x" * 200_000]
    docs = [(int(i) if i % 9 else None, texts[int(rng.integers(len(texts)))], [None, "", "en", "de"][int(rng.integers(4))]) for i in rng.integers(0, 60, 150)]
    docs += docs[:20]
    labels = [(i, int(rng.integers(2)), int(rng.integers(2))) for i in range(40)] + [(3, 0, 1), (4, None, None), (None, 1, 1)]
    table = spark.createDataFrame(docs, TEXTS).withColumns({"n": F.lit(7), "A": F.lit("clash"), "id": F.lit(1), "part": F.lit("x")}).repartition(5)
    out = audit.audit(table, spark.createDataFrame(labels, LABELS).withColumn("lang", F.lit("zz")))
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in out.collect()}
    assert len(got) == out.count() == 3 * 600 and got == brute_audit(docs, labels)


def test_audit_of_no_rows_and_of_filters_of_ones_own(spark):
    none, unlabelled = spark.createDataFrame([], TEXTS), spark.createDataFrame([], LABELS)
    assert audit.audit(none, unlabelled).count() == 0
    docs = spark.createDataFrame([(1, "a b", "en"), (2, "a b", "en"), (3, "x", "en")], TEXTS)
    out = audit.audit(docs, unlabelled, {"S": lambda text, words: F.size(words) < 2})
    assert {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["unique_fails"]) for r in out.collect()} == {("SE", 1): (2, 1, 1), ("SE", 2): (1, 1, 1), ("ES", 1): (2, 1, 1), ("ES", 2): (1, 1, 1)}


# token files


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(tokenfiles.VOCABULARY))


ODD = ["", "a", " ", "  ", "\n", "a\nb", "a\n\nb", "a \n b", "a\n b", " a", "a  b", "a   b\n\n\nc", "don't they're 'll 's", "x 's y\n's", "a b  c\n　d  e", "\x1cq \x1c r\n\x1f s", "日本語 のテキスト\n中文   x", "12 34\n56, 7.8 -9", "<|endoftext|>", "a  <|endoftext|> b\n<|endoftext|>\n", "\x00 \x00\n\x85 \x85", "é à\nü ﻿x", "👍🏽 👍🏽\n👍", "word " * 3000, "x" * 5000, "\t\ta\tb \tc\r\nd\r\n\r\ne", "a\n'b", "1\n\x7f \x7f"]


def test_pieces_have_the_ids_of_whole_texts(tokenizer):
    encoder = tokenfiles.PieceEncoder.of(vocabulary_path(tokenfiles.VOCABULARY))
    for texts in (ODD, [None, *ODD, None], []):
        ids, bounds = encoder.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_full_memory_forgets_rare_pieces(tokenizer, monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHE_PIECES", 40)
    encoder = tokenfiles.PieceEncoder(vocabulary_path(tokenfiles.VOCABULARY))
    for i in range(60):
        texts = [f"often the same, rare{i} word{i * 7}é 12-{i}", f"the same again {i}"]
        ids, bounds = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert " same" in encoder.number and " rare3" not in encoder.number and len(encoder.number) < 60


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sé1.\n\t   \x85\x1c日👍<|>") | st.characters(exclude_categories=["Cs"])), max_size=4))
def test_pieces_of_any_text(tokenizer, texts):
    ids, bounds = tokenfiles.PieceEncoder.of(vocabulary_path(tokenfiles.VOCABULARY)).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def token_rows(tokenizer, docs):
    """(doc_id, start, n_tokens, ids_crc32), one document after another."""
    out, start = [], 0
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_against_a_fresh_tokenizer(spark, tokenizer, tmp_path):
    docs = [(3 * i % 101, t) for i, t in enumerate(ODD)] + [(200 + i, f"document {i} " * (i % 50)) for i in range(300)] + [(900, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "part": F.lit(1)}).repartition(7)
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = tokenfiles.round_trip(table, path=path)
        want = token_rows(tokenizer, sorted(docs))
        assert sorted(map(tuple, got.collect())) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{path}/parts").count() > 1
    assert sorted(map(tuple, tokenfiles.metadata(spark, path).select("doc_id", "start", "n_tokens").collect())) == [r[:3] for r in want]
    # selective reads
    few = tokenfiles.documents(spark, path, 250, 260)
    assert sorted(r["doc_id"] for r in few.collect()) == list(range(250, 261))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(doc_id,250\)", few._jdf.queryExecution().toString())
    assert "ids:array" not in tokenfiles.metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    stream = [x for i, t in sorted(docs) for x in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]]
    for a, b in ((0, len(stream)), (5, 6), (1000, 1700), (len(stream) - 3, len(stream) + 9), (len(stream), len(stream) + 1), (7, 7)):
        pieces = sorted(tokenfiles.span(spark, path, a, b).collect(), key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == stream[a:b]


def test_layout_of_token_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} of {i * i}") for i in range(5000)], "doc_id long, text string").coalesce(1)
    path = str(tmp_path / "t")
    tokenfiles.write(docs, path, row_group=8192, page_rows=50)
    file = pq.ParquetFile(sorted((tmp_path / "t" / "ids").glob("part-*.parquet"))[0])
    assert file.metadata.num_row_groups > 1
    columns = {(c := file.metadata.row_group(0).column(i)).path_in_schema: c for i in range(file.metadata.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["offset"].encodings
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert all(c.has_column_index and c.has_offset_index for n, c in columns.items() if n != "ids.list.element")


def test_token_files_of_repeats_null_ids_and_no_rows(spark, tokenizer):
    docs = [(5, "same"), (5, "same"), (5, "other"), (None, "first"), (None, None), (6, "y" * 300_000)]
    got = [tuple(r) for r in tokenfiles.round_trip(spark.createDataFrame(docs, "doc_id long, text string")).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, None, 5, 5, 5, 6]
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    size = {t: (n, c) for _, _, n, c, t in ((*r, t) for r, (_, t) in zip(token_rows(tokenizer, docs), docs, strict=True))}
    assert sorted(r[2:] for r in got) == sorted(size[t] for _, t in docs)
    assert tokenfiles.round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# centroid clustering


def brute_clusters(vectors, k, rounds):
    """[(vec_id, cluster, distance)] and the centroids: every vector against every centroid, in Python's whole numbers."""
    import hashlib

    kept = sorted(vectors, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [list(v) for _, v in kept[:k]]
    place = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [place(v)[1] for _, v in vectors]
        for j in range(len(cs)):
            mine = [v for (_, v), o in zip(vectors, own, strict=True) if o == j]
            if mine:
                cs[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, place(v)[1], place(v)[0]) for i, v in vectors), key=repr), cs


@pytest.mark.parametrize("kind", ["plain", "ties", "large", "few"])
def test_clusters_against_brute_force(spark, kind):
    rng = np.random.default_rng(13)
    n, spread = (5, 9) if kind == "few" else (300, 2 if kind == "ties" else 300)
    v = rng.integers(-spread, spread + 1, (n, 4)).astype(object)
    if kind == "plain":  # shells of several norms
        v = v * np.array([[1], [3], [9]] * 100)
    if kind == "large":
        v[::7] *= 1 << 35
    vectors = [(i if i % 50 else None, [int(x) for x in row]) for i, row in enumerate(v.tolist())]
    vectors += vectors[:9]
    table = spark.createDataFrame([(i, [x / 1024 for x in row]) for i, row in vectors], "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "cluster": F.lit("clash")}).repartition(3)
    odd = spark.createDataFrame([(1, None), (2, [1.0, None, 2.0, 3.0]), (3, [1.0, float("nan"), 2.0, 3.0]), (4, [float("inf"), 1.0, 2.0, 3.0]), (5, [1.0]), (6, [])], "vec_id long, embedding array<double>")
    out = centroids.cluster(table.unionByName(odd, allowMissingColumns=True), k=8, rounds=10, dims=4).collect()
    want, cs = brute_clusters(vectors, 8, 10)
    top = lambda x: min(x, centroids.LONGEST)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in out), key=repr) == sorted(((i, j, top(d)) for i, j, d in want), key=repr)
    import hashlib

    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cs[r["cluster"]])).encode()).hexdigest() for r in out)
    assert {r["inertia"] for r in out} == {top(sum(top(d) for _, _, d in want))}
    assert all(r["cluster_inertia"] == top(sum(top(d) for _, j, d in want if j == r["cluster"])) for r in out)


def test_clusters_of_no_vectors(spark):
    assert centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>")).count() == 0
    assert centroids.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_annulus_passes_over_far_norms_and_keeps_boundary_ties():
    rng = np.random.default_rng(5)
    near = centroids.Annulus([[100 * j, 0] for j in range(1, 51)], 2)
    x = np.stack([rng.integers(0, 5000, 1000), np.zeros(1000, np.int64)], axis=1)
    number, best, compared = near.nearest(x)
    every = np.abs(x[:, :1] - 100 * np.arange(1, 51))
    assert (number == every.argmin(axis=1)).all() and (best == every.min(axis=1) ** 2).all() and compared < 3 * len(x)
    # (5, 0) is as near to (8, 0) as to (2, 0); both norms lie on the annulus's edge
    for order in ([[8, 0], [2, 0]], [[2, 0], [8, 0]]):
        assert centroids.Annulus(order, 2).nearest(np.array([[5, 0]]))[0].tolist() == [0]
