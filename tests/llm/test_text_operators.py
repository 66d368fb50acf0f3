"""Licences, lines, packing, byte-level BPE and the two classifiers on small tables and odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import bpe, language, licenses, lines, packing, simhash, subwords, toxicity, warc
from quire.llm.queries import held_out

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "Released under the MIT License.\nother", "en", "a", 3),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\t\n", "en", None, 4),
    (5, "same words here\nlast", "en", "a", 1),
    (5, "same words here\nlast", "en", "a", 1),
    (None, "no id, same words here", "de", "b", 9),
    (7, "Ünïcödé 日本語 👍🏽 " * 50, "de", "b", 9),
    (8, "x" * 30_000, "de", "b", 9),
    (9, "w%d " * 3 % (1, 2, 3) + "word " * 9_000, "de", "b", 9),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumn("extra", F.lit("x")).withColumn("digest", F.lit("clash")).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


# licences


def test_license_texts_and_notices(spark, odd, none):
    out = {r["doc_id"]: r for r in licenses.scan(odd).collect()}
    assert licenses.scan(odd).count() == len(ODD)
    assert out[1]["text_license"] is None and out[1]["notice_licenses"] == ["MIT"] and out[1]["n_notices"] == 1
    assert out[2]["text_digest"] is None and out[2]["notice_licenses"] == []
    assert licenses.scan(none).count() == 0
    disguised = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + licenses.MIT.upper().replace(",", " ,").replace("\n\n", "\n\n\n").replace("SUBLICENSE", "SUBLICENCE")
    got = licenses.scan(spark.createDataFrame([(1, disguised), (2, disguised + " more")], "doc_id long, text string"))
    assert [r["text_license"] for r in got.orderBy("doc_id").collect()] == ["MIT", None]
    mid = spark.createDataFrame([(1, "intro\n\n" + licenses.ISC.replace("\n\n", "\n") + "\n\noutro")], "doc_id long, text string")
    assert licenses.scan(mid).first()["notice_licenses"] == ["ISC"]


def test_license_plan_has_no_python(odd):
    assert not any(x in licenses.scan(odd)._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))


# lines


def brute_lines(rows, ratio, least):
    pages, total = {}, {}
    bare = lambda x: x.strip(" \t\r\f\x0b")
    for _, text, _, host, _ in rows:
        total[host] = total.get(host, 0) + 1
        for line in {bare(x) for x in (text or "").split("\n")} - {""}:
            pages[host, line] = pages.get((host, line), 0) + 1
    out = []
    for doc, text, _, host, _ in rows:
        kept = None if text is None else [x for x in text.split("\n") if not (bare(x) and pages[host, bare(x)] >= least and pages[host, bare(x)] > ratio * total[host])]
        out.append((doc, None if kept is None else "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_lines_match_brute_force(spark, odd, none, monkeypatch, broadcast):
    monkeypatch.setattr(lines, "BROADCAST_LINES", broadcast)
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice(["a", "b", " b ", "c%d" % rng.randrange(9), ""]) for _ in range(rng.randrange(6))), "en", rng.choice(["h1", "h2", None]), 1) for i in range(60)] + ODD
    got = lines.drop_boilerplate(spark.createDataFrame(rows, DOCS), ratio=0.3, least_pages=2).collect()
    assert sorted([(r["doc_id"], r["text"]) for r in got], key=str) == brute_lines(rows, 0.3, 2)
    out = lines.drop_boilerplate(odd)
    assert out.count() == len(ODD) and {"extra", "digest", "lines_dropped"} <= set(out.columns)
    assert lines.drop_boilerplate(none).count() == 0
    assert not any(x in out._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))


# packing


def test_packing_covers_every_token_once(odd, none):
    from tokenizers import Tokenizer

    special = [(20, "hello <|endoftext|> x", "en", "a", 1), (21, "mid<|startoftext|>dle, it's<|endoftext|>'s <| endoftext|> <|ENDOFTEXT|>", "en", "a", 1)]
    out = packing.pack(odd.select(DOCS_COLUMNS).unionByName(odd.sparkSession.createDataFrame(special, DOCS)), window=256, group=4, with_ids=True).collect()
    plain = Tokenizer.from_file(packing.vocabulary_path())
    want = sorted([*plain.encode(t or "", add_special_tokens=False).ids, 2] for _, t, *_ in ODD + special)
    docs = {}
    for r in out:
        ids = np.array(r["ids"], "<u4")
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.tobytes())
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], list(r["ids"])))
    joined = []
    for (_, tokens), pieces in docs.items():
        stream = [x for _, ids in sorted(pieces) for x in ids]
        copies = len(stream) // tokens
        joined += [stream[:tokens]] if copies == 1 else [list(p) for p in pieces_of_copies(pieces, copies)]
    assert sorted(joined) == want
    windows = {}
    for r in out:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(none).count() == 0


def pieces_of_copies(pieces, copies):
    """Copies of one short document have one piece each."""
    assert len(pieces) == copies
    return [ids for _, ids in pieces]


def test_differencing_is_near_equal_and_rises():
    sizes = np.random.default_rng(0).integers(1, 200, 600)
    found = packing.windows(sizes, 4096)
    loads = np.bincount(found, weights=sizes)
    assert loads.max() <= 4096 and len(loads) <= -(-sizes.sum() // 4096) + 1
    assert loads.max() - loads.min() <= 200
    assert packing.windows(np.array([60, 60, 60]), 100).tolist() == [0, 1, 2]
    assert np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4]).tolist() in ([16.0, 14.0], [14.0, 16.0])


# byte-level BPE


def test_bpe_equals_tiktoken(odd, none):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=bpe.word_pattern(), mergeable_ranks=bpe.read_ranks(bpe.vocabulary_path()), special_tokens={})
    rng = np.random.default_rng(2)
    texts = [(100 + i, "".join(rng.choice(list("ab\n 's'é1!x\t"), 80)), "en", "s", 1) for i in range(50)] + [(200, "a\x00b  c \n", "en", "s", 1), (201, "don't <|endoftext|> I'LL\r\n\r\n  é   x", "en", "s", 1)]
    docs = odd.select(DOCS_COLUMNS).unionByName(odd.sparkSession.createDataFrame(texts, DOCS))
    got = bpe.encode_documents(docs.withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit("clash"))).collect()
    want = []
    for doc, text, *_ in ODD + texts:
        ids = np.array(known.encode_ordinary(text or ""), "<u4")
        want.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.encode_documents(none).count() == 0


DOCS_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_bpe_forgets_and_keeps_words(odd, monkeypatch):
    """Words beyond those held are folded anew, parts of long words are rows of their own: the same ids."""
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=bpe.word_pattern(), mergeable_ranks=bpe.read_ranks(bpe.vocabulary_path()), special_tokens={})
    for name, value in {"HELD": 40, "HELD_CHUNKS": 20, "HEAD_WORDS": 30, "LONG_WORD": 12, "PART": 2}.items():
        monkeypatch.setattr(bpe, name, value)
    monkeypatch.setattr(bpe, "byte_slices", lambda column, at_most: subwords.byte_slices(column, 300))
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("aeioubcdfgh") for _ in range(rng.randrange(1, 18))) for _ in range(30)) for _ in range(60)]
    docs = odd.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_documents(docs).collect()}
    assert got == {i: (hashlib.sha256(np.array(known.encode_ordinary(t), "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(texts)}


def test_heap_merges_like_the_fold():
    import tiktoken

    ranks = bpe.read_ranks(bpe.vocabulary_path())
    known = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for n in (1, 2, 5, 50, 3000):
        word = "".join(rng.choice("abcdefgh the") for _ in range(n))
        assert bpe.merge_by_heap(word.encode(), ranks) == known.encode_ordinary(word)


# classifiers


WORDS = {"en": "the of and that with this from were".split(), "de": "der die und nicht ist auch eine über".split()}


def labelled(n):
    rng = random.Random(5)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(20)), lang, "s", 1) for i, lang in enumerate(rng.choice(["en", "de"]) for _ in range(n))]


def test_language(spark, odd, none):
    train = spark.createDataFrame(labelled(300), DOCS)
    out = language.identify_languages(odd, train)
    assert out.count() == len(ODD) and {"extra", "digest"} <= set(out.columns)
    for r in out.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["lang_score"] <= 1 and (letters or r["lang_rejected"])
    test = spark.createDataFrame([(1, "und der die auch"), (2, "this and that")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify_languages(test, train).orderBy("doc_id").collect()] == ["de", "en"]
    assert {r["lang_pred"] for r in language.identify_languages(odd, none).collect()} == {"und"}
    assert language.identify_languages(none, train).count() == 0


def test_held_out_rows_follow_crc32(spark):
    ids = [1, 2, 3, 17, 123456, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out().alias("h")).collect()
    assert [r["h"] for r in rows] == [i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in ids]


def test_toxicity(spark, odd, none):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(900):
        words = [rng.choice("oner tion alth reme stan dulo pira keto".split()) + rng.choice("ab cd ef gh ij".split()) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(["idiotic", "moronish", "scumbag"])
        rows.append((i, " ".join(words), "en", "s", 1))
        marks.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, toxic int")
    out = {r["doc_id"]: r["tox_score"] for r in toxicity.toxicity(docs, docs.where("doc_id < 600"), labels).collect()}
    late = [(out[i] >= 0.7) == bool(t) for i, t in marks if i >= 600]
    assert sum(late) / len(late) > 0.97
    scored = toxicity.toxicity(odd, docs, labels)
    assert scored.count() == len(ODD) and all(0 <= r["tox_score"] <= 1 for r in scored.collect())
    assert toxicity.toxicity(odd, none, labels.limit(0)).count() == len(ODD)
    assert toxicity.toxicity(none, docs, labels).count() == 0


def test_ngrams_are_shared_by_misspellings():
    words = pa.array(["idiot", "idiott", "zzz", ""])
    of, bucket = subwords.ngrams(words, 18)
    grams = [set(bucket[of == i].tolist()) for i in range(4)]
    assert len(grams[0] & grams[1]) >= 5 and not grams[0] & grams[2] and not grams[3]


# SimHash: the fingerprint


def test_fingerprints_follow_the_definition(odd):
    from xxhash import xxh64_intdigest

    def want(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        h = [xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = sorted(((r["doc_id"], r["f"]) for r in simhash.fingerprints(odd).select("doc_id", simhash.as_hex("fp").alias("f")).collect()), key=str)
    assert got == sorted(((d, f"{want(t):016x}") for d, t, *_ in ODD), key=str)


# WARC: digests


def test_base32_sha1(spark):
    import base64

    rows = spark.createDataFrame([("",), ("é<p>",), ("x" * 9999,)], "p string").select("p", warc.sha1_base32(F.col("p")).alias("d")).collect()
    assert all(r["d"] == base64.b32encode(hashlib.sha1(r["p"].encode()).digest()).decode() for r in rows)


def test_byte_bpe_chunks_give_the_words_of_whole_texts():
    import random

    import pyarrow as pa
    import regex

    pattern = bpe.spark_pattern(bpe.word_pattern())
    find, rng, letters = regex.compile(pattern).findall, random.Random(2), "ab c \n\n  \t\r\x85\xa0 é.,'s1Āß×あʰ"
    for _ in range(2000):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(9))) for _ in range(2)]
        offsets, index, listed = bpe.chunks_of(pa.array(texts))
        words = [[c] if one else find(c) for c, one in zip(listed, bpe.matches(listed, pattern), strict=True)]
        assert [[w for c in index[a:b] for w in words[c]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [find(t) for t in texts]
    # where all white space is single, no chunk needs the regular expression of its cuts, and letters none at all
    assert list(bpe.matches([" aé", "b", " a1", " ×", "a b", "\na", ""], pattern)) == [True, True, False, False, False, False, False]


def test_byte_bpe_driver_holds_frequent_words_as_arrays(spark):
    docs = spark.createDataFrame([(1, "ab ab é"), (2, None)], "doc_id int, text string")
    found = bpe.frequent_words(docs, bpe.vocabulary_path(), bpe.spark_pattern(bpe.word_pattern()))
    assert sorted(found["word"].to_pylist()) == [" ab", " é", "ab"]
    head = bpe.Numbered(found["word"].combine_chunks())
    assert "numbers" not in head.__getstate__() and {w.encode(): None for w in head.numbers} == {b: None for b in found["bytes"].to_pylist()}


def test_byte_bpe_words_with_edges_need_no_regular_expression():
    import regex

    pattern = bpe.spark_pattern(bpe.word_pattern())
    find, rng = regex.compile(pattern).findall, random.Random(4)
    listed = ["".join(rng.choice(["ab", "é", " ", "\n", ".", ",", "'s", "1", "\t", "ʰ"]) for _ in range(rng.randrange(5))) for _ in range(3000)] + ["\nab,", " é.", "ab\n", "ab.\n"]
    found = list(bpe.edged(listed, pattern))
    assert sum(found) > 200 and found[-4:] == [True, True, False, False]
    assert [bpe.cut_edges(c) for c, edge in zip(listed, found, strict=True) if edge] == [find(c) for c, edge in zip(listed, found, strict=True) if edge]
    assert not any(bpe.edged(listed, r"\S+"))


def test_byte_bpe_fold_builds_no_slices(spark):
    """A step of the fold was put together from slices, which took a third of its time; its ids are those of the heap."""
    ranks, rng = bpe.read_ranks(bpe.vocabulary_path()), random.Random(6)
    words = ["".join(rng.choice(["a", "b", "th", "é", "ÿ", "\x00", "\x7f", "あ", "🙂", " "]) for _ in range(rng.randrange(1, 12))).encode() for _ in range(300)] + [b"aaaaaaaa", bytes(range(256))]
    docs = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    coded = docs.select("word", bpe.encode_word(F.col("word"), bpe.vocabulary_path()).alias("ids"))
    assert [r["ids"] for r in coded.collect()] == [bpe.merge_by_heap(w, ranks) for w in words]
    assert "slice(" not in str(bpe.encode_word(F.col("word"), bpe.vocabulary_path()))
