"""The pipeline's near duplicates: five-word Jaccard of 0.8 and more, against brute force on planted near copies."""

from __future__ import annotations

import random

import corpus_pipeline
from quire.llm import simhash


def shingles(text, words=5):
    found = text.lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def planted(seed=4):
    """Texts of 300 words, each with copies whose words are exchanged at several rates, and texts that stand alone."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for _ in range(40):
        base = [word() for _ in range(300)]
        texts.append(base)
        for n in (1, 3, 5, 6, 12):  # words exchanged: Jaccards from about 0.97 to 0.65
            copy = list(base)
            for at in rng.sample(range(300), n):
                copy[at] = word()
            texts.append(copy)
    return [" ".join(t) for t in texts]


def brute(texts, least=0.8):
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in pairs:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return {i for i in range(len(sets)) if root(i) == i}


def test_pipeline_finds_near_copies_of_five_words(spark, monkeypatch):
    texts = planted()
    want = brute(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, "").select("doc_id").collect()}
    gone = set(range(len(texts))) - want
    assert want <= got  # no text goes without a partner of Jaccard 0.8
    assert len(gone - got) >= 0.98 * len(gone)
    monkeypatch.setattr(simhash, "SHINGLES", 600)  # groups of several blocks
    monkeypatch.setattr(simhash, "BUCKET", 16)  # and buckets
    assert got == {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, "").select("doc_id").collect()}


ODD = "doc_id long, text string, lang string, source string, n_chars int, tox_score string, lang_pred int, lines_dropped string, __key string, component string, fp string"


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], ODD).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_odd_rows_and_names(spark, tmp_path):
    words = "the house by the river is old and the garden behind it is green".split()
    text = " ".join(words * 20)
    rows = [(i, f"{text} number {i} " + " ".join(words[i % 7 :] * (i + 1)), "en", "a", 5, "mine", i, "own", "k", "c", "f") for i in range(40)]
    rows += [(None, text + " no id", "en", None, 5, "mine", 1, "own", "k", "c", "f"), (900, None, None, None, None, None, None, None, None, None, None), (901, "", "en", "a", 0, "mine", 1, "own", "k", "c", "f"), rows[3], rows[3]]
    spark.createDataFrame(rows, ODD).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        found = out.collect()
        assert all((r["tox_score"], r["lines_dropped"], r["__key"], r["component"], r["fp"]) == ("mine", "own", "k", "c", "f") for r in found if r["doc_id"] != 900)
    assert sum(r["doc_id"] == 3 for r in found) <= 1 and any(r["doc_id"] is None for r in found)
    toxic = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert toxic.columns == docs.columns and {r["doc_id"] for r in toxic.where("text is null or text = ''").collect()} <= {900, 901}
