"""Scores of the two classifiers against a plain recomputation, text by text and word by word."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from quire.llm import language, subwords, toxicity

TEXTS = ["One two three, two. ONE!", "", "   ", "single", "an idiot and an idi0t said stupid things", "der Hund und die Katze", "x " * 50 + "moron " + "y " * 50, "été à la plage", "..."]


def words_of(text):
    return [w.strip(subwords.EDGE_PUNCTUATION) for w in text.lower().split()]


def gram_rows(word, table):
    _, bucket = subwords.ngrams(pa.array([word], pa.string()), int(table.shape[0]).bit_length() - 1)
    return table[bucket]


def test_toxicity_scores_recomputed():
    rng = np.random.default_rng(1)
    table = rng.normal(0, 1, (1 << 10, 1)).astype(np.float32)
    model = toxicity.ToxicityModel(table, 2.0, -0.5)
    got = model.scores(pa.array(TEXTS))
    for text, score in zip(TEXTS, got, strict=True):
        words = words_of(text)
        best = None
        for i in range(max(1, len(words) - toxicity.WINDOW + 1)) if words else []:
            grams = [x for w in words[i : i + toxicity.WINDOW] for x in gram_rows(w, table)[:, 0].tolist()]
            value = sum(grams) / len(grams) if grams else toxicity.EMPTY
            best = value if best is None else max(best, value)
        z = max(-30, min(30, 2.0 * (toxicity.EMPTY if best is None else best) - 0.5))
        assert math.isclose(score, 1 / (1 + math.exp(-z)), rel_tol=1e-3, abs_tol=1e-9)


def test_language_probabilities_recomputed():
    rng = np.random.default_rng(2)
    table = rng.normal(0, 1, (1 << 10, 3)).astype(np.float32)
    model = language.LanguageModel(["a", "b", "c"], table, np.array([0.1, 0.0, -0.2]), 0.7, 0.4)
    got = model.probabilities(pa.array(TEXTS))
    for text, p in zip(TEXTS, got, strict=True):
        grams = [x for w in words_of(text) for x in gram_rows(w, table).tolist()]
        mean = np.sum(grams, axis=0) / len(grams) if grams else np.zeros(3)
        z = (mean + model.bias) / 0.7
        want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(p, want, atol=1e-4)


def test_fit_learns_misspellings_from_random_starts():
    rng = np.random.default_rng(3)
    plain = ["table", "river", "window", "garden", "letter", "orange", "silver", "mother", "winter", "summer"]
    bad = ["idiot", "moron", "stupid"]
    rows = []
    for i in range(400):
        words = rng.choice(plain, 30).tolist()
        if i % 4 == 0:
            words[int(rng.integers(30))] = str(rng.choice(bad))
        rows.append((" ".join(words), int(i % 4 == 0)))
    model = toxicity.fit_toxicity(rows, bits=14, epochs=60)
    clean, toxic, misspelt = model.scores(pa.array([" ".join(plain), "garden river stupid window", "garden river stupidd window"]))
    assert clean < 0.3 and toxic > 0.7 and misspelt > clean
