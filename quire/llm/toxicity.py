"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A bag is a run of WINDOW words: the average of the embeddings of all their character n-grams, so a misspelling shares
most of its vectors with the word it disguises. Embeddings and softmax start at random and are fitted together; a
document's evidence is that of its most toxic bag (one insult in a long text isn't averaged away), which the fit
approaches by weighting bags ever more sharply. That evidence is calibrated on labelled documents outside the fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subwords as sw

#: Words of a bag. Evidence of a text without a word.
WINDOW = 2
EMPTY = -30.0
#: How many times as sharply bags are weighted at the end of the fit; the slope by which n-grams hardly move.
SHARPNESS, FLOOR = 30.0, 1e-6
#: Share that embeddings lose in an epoch.
DECAY = 0.05
#: Texts of more characters aren't fitted on, so that the sample has a bound in bytes too.
FIT_CHARS = 20_000


@dataclass
class ToxicityModel:
    table: np.ndarray  # per hash bucket: its embedding times the difference of the softmax weights
    slope: float
    shift: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        words = sw.split_words(texts)
        sums, n = sw.word_sums(words.distinct, self.table)
        start, end, row = bags(words.offsets)
        top = np.full(len(texts), EMPTY)
        if len(start):
            grams = between(n, words.index, start, end)
            average = np.where(grams > 0, between(sums[:, 0], words.index, start, end) / np.maximum(grams, 1), EMPTY)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            top[row[first]] = np.maximum.reduceat(average, first)
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.shift, -30, 30)))


def bags(offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every run of `size` words of a row, of all its words if it has fewer; in the order of rows."""
    many = np.diff(offsets)
    count = np.where(many > 0, np.maximum(many - size + 1, 1), 0)
    row = np.repeat(np.arange(len(many)), count)
    start = offsets[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return start.astype(np.int32), np.minimum(start + size, offsets[1:][row]).astype(np.int32), row.astype(np.int32)


def between(values: np.ndarray, index: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of values[index] from start to end."""
    total = np.zeros(len(index) + 1)
    np.cumsum(values[index], out=total[1:])
    out = total[end]
    out -= total[start]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> list[tuple[str, int]]:
    """Up to per_class (text, toxic) rows of each class, chosen by a hash of doc_id; clean ones up to 3 x per_class.

    Texts of over FIT_CHARS characters aren't among them. Of rows that repeat a doc_id, the greatest text and label count.

    Only label rows are sampled before the join, so the broadcast side has 4 x per_class rows at most.
    """
    one = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    wanted = None
    for toxic, bound in ((0, 3 * per_class), (1, per_class)):
        share = min(1.0, 1.1 * bound / max(counts.get(toxic, 0), 1))
        part = one.where((F.col("toxic") == toxic) & (draw < int(share * 1_000_000) + 1)).limit(bound)
        wanted = part if wanted is None else wanted.unionByName(part)
    rows = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= FIT_CHARS).select("doc_id", "text").join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    return [(r["text"] or "", r["toxic"]) for r in rows.orderBy("doc_id").collect()]


def gathered(to: np.ndarray, size: int, values: np.ndarray, at: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """Sum of values[at] by to, a slice at a time, so that no copy as long as to is made."""
    out = np.zeros(size)
    for i in range(0, len(to), step):
        out += np.bincount(to[i : i + step], weights=values[at[i : i + step]], minlength=size)
    return out


def fit_toxicity(rows: list[tuple[str, int]], *, bits: int = 18, dim: int = 8, epochs: int = 60, rate: float = 1.0, seed: int = 11) -> ToxicityModel:
    """Fit on (text, 0 or 1) rows; a quarter of them calibrates. With one class only, every score is that of no evidence."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    y = np.array([rows[i][1] for i in order], float)
    if len(set(y.tolist())) < 2:
        return ToxicityModel(np.zeros((1 << bits, 1), np.float32), 1.0, -5.0)
    words = sw.split_words(pa.array([rows[i][0] for i in order], pa.string()))
    of, bucket = sw.ngrams(words.distinct, bits)
    size = len(words.distinct)
    grams = np.bincount(of, minlength=size)
    index = words.index.astype(np.int32)
    start, end, row = bags(words.offsets)
    held = len(y) // 4
    fitted = int(np.searchsorted(row, held))  # the first rows calibrate
    s_in, e_in, r_in = start[fitted:], end[fitted:], row[fitted:] - held
    del words
    many = np.maximum(between(grams, index, start, end), 1)
    starts = np.flatnonzero(np.diff(r_in, prepend=-1))
    docs_in = r_in[starts]
    bags_of = np.diff(np.append(starts, len(r_in)))
    t = y[held:][docs_in]
    weight = np.where(t == 1, 0.5 / max((t == 1).sum(), 1), 0.5 / max((t == 0).sum(), 1))
    embedding = rng.normal(0, 0.02, (1 << bits, dim)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    bias, second, inertia = 0.0, np.full(1 << bits, 1e-12), np.zeros(1 << bits)
    for epoch in range(epochs):
        done = epoch / max(epochs - 1, 1)
        u = softmax[:, 1] - softmax[:, 0]
        value = embedding @ u
        of_word = gathered(of, size, value, bucket)
        logit = between(of_word, index, s_in, e_in) / many[fitted:]
        # bags count by a softmax of their evidence, from nearly alike to the largest alone
        share = logit - np.repeat(np.maximum.reduceat(logit, starts), bags_of)
        share *= SHARPNESS**done
        np.exp(share, out=share)
        share /= np.repeat(np.add.reduceat(share, starts), bags_of)
        whole = np.add.reduceat(share * logit, starts)
        wrong = (1 / (1 + np.exp(-np.clip(whole + bias, -30, 30))) - t) * weight
        share *= np.repeat(wrong, bags_of)
        share /= many[fitted:]
        change = np.bincount(s_in, weights=share, minlength=len(index) + 1)
        change -= np.bincount(e_in, weights=share, minlength=len(index) + 1)
        np.cumsum(change, out=change)
        per_word = np.bincount(index, weights=change[:-1], minlength=size)
        del logit, share, change
        slope = gathered(bucket, 1 << bits, per_word, of)
        into = embedding.T @ slope
        inertia = 0.8 * inertia + 0.2 * slope
        second = np.maximum(0.95 * second, slope * slope)
        embedding *= 1 - DECAY
        embedding -= (rate * inertia / (np.sqrt(second) + FLOOR))[:, None].astype(np.float32) * u[None]
        softmax[:, 1] -= rate * into
        softmax[:, 0] += rate * into
        bias -= rate * wrong.sum()
    table = (embedding @ (softmax[:, 1] - softmax[:, 0]))[:, None]
    logit = np.where(between(grams, index, start, end) > 0, between(gathered(of, size, table[:, 0], bucket), index, start, end) / many, EMPTY)
    fit = np.arange(len(y)) >= held
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    top = np.full(len(y), EMPTY)
    top[row[starts]] = np.maximum.reduceat(logit, starts)
    out = ~fit & (top > EMPTY)
    x, t = top[out], y[out]
    if len(set(t.tolist())) < 2:
        x, t = top[top > EMPTY], y[top > EMPTY]
    middle, spread = float(np.median(x)), float(x.std() or 1)
    x = (x - middle) / spread
    a, b = 1.0, -1.0
    for _ in range(50):  # Newton steps of a slightly regularised logistic calibration
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - t) * x).sum() + 0.01 * a, (p - t).sum()])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - float(np.clip(move[0], -2, 2)), b - float(np.clip(move[1], -2, 2))
    return ToxicityModel(table, max(a, 0.0) / spread, b - max(a, 0.0) * middle / spread)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """docs with tox_score (0 to 1) for every row and whole text; null and empty texts score as texts without a word.

    Very long texts are taken whole, a slice of rows at a time. Other columns pass through (one named tox_score is
    replaced), repeated rows and null ids stay, an empty table gives none, and equal evidence gives equal scores.
    """
    keep = [c for c in docs.columns if c != "tox_score"]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", tox_score double"
    at = keep.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in sw.byte_slices(whole.column(at)):
                batch = whole.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column(at)))], [*keep, "tox_score"])

    return kept.mapInArrow(score, schema)


def toxicity(docs: DataFrame, labelled: DataFrame, labels: DataFrame, *, per_class: int = 800) -> DataFrame:
    """Learn from labelled documents (labels: doc_id, toxic), at most 4 x per_class of them, and score docs."""
    model = fit_toxicity(labelled_sample(labelled, labels, per_class))
    sw.give_back()
    return score_toxicity(docs, model)
