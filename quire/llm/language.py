"""Language identification: averaged hashed subword embeddings with a linear softmax, fitted by SGD in numpy.

The fit sees a bounded sample of labelled rows (`per_language` each, chosen by a hash); prediction covers every
row and every whole text. Confidences are calibrated by a temperature, and a document is rejected below a
confidence that nearly all calibration documents of known language exceed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import subwords as sw

UNKNOWN = "und"
#: Texts of more characters aren't fitted on, so that the sample has a bound in bytes too.
FIT_CHARS = 20_000


@dataclass
class LanguageModel:
    names: list[str]
    table: np.ndarray  # per hash bucket: its embedding times the softmax weights
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """Calibrated class probabilities per text; a text without n-grams gets those of the bias."""
        words = sw.split_words(texts)
        sums, n = sw.word_sums(words.distinct, self.table)
        total = np.maximum(sw.row_sums(n.astype(float), words), 1)
        logits = np.stack([sw.row_sums(sums[:, c], words) for c in range(len(self.names))], axis=1) / total[:, None]
        return softmax((logits + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def remainder(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3, by which rows are held out; null for a null doc_id."""
    return F.crc32(doc_id.cast("string")) % 3


def labelled_sample(docs: DataFrame, per_language: int) -> list[tuple[str, str]]:
    """Up to per_language (text, lang) rows of each language, chosen by a hash of doc_id and length.

    Texts of over FIT_CHARS characters aren't among them. One scan counts, one draws, whatever the number of languages.
    """
    rows = docs.where(F.col("lang").isNotNull() & (F.length("text") <= FIT_CHARS) & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    draw = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1_000_000))
    bounds = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, 1.3 * per_language / n) * 1_000_000) + 1)])
    drawn = rows.withColumn("draw", draw).where(F.col("draw") < F.element_at(bounds, F.col("lang"))).collect()
    of: dict[str, list[tuple[str, str]]] = {}
    for r in sorted(drawn, key=lambda r: (r["draw"], str(r["doc_id"]), r["text"])):
        of.setdefault(r["lang"], []).append((r["text"], r["lang"]))
    return [row for lang in sorted(of) for row in of[lang][:per_language]]


def fit_language(rows: list[tuple[str, str]], *, bits: int = 16, dim: int = 16, epochs: int = 6, rate: float = 0.5, lost: float = 0.001, seed: int = 7) -> LanguageModel | None:
    """Fit on (text, lang) rows; a fifth of them calibrates. None without rows."""
    names = sorted({lang for _, lang in rows})
    if not names:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    inputs, classes = [], []
    for i in order:
        words = sw.split_words(pa.array([rows[i][0]], pa.string()))
        of, bucket = sw.ngrams(words.distinct, bits)
        counts = np.bincount(words.index, minlength=len(words.distinct)).astype(float)
        found, inverse = np.unique(bucket, return_inverse=True)
        weight = np.bincount(inverse, weights=counts[of], minlength=len(found))
        inputs.append((found.astype(np.int32), (weight / max(weight.sum(), 1)).astype(np.float32)))
        classes.append(names.index(rows[i][1]))
    held = len(rows) // 5
    embedding = rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32)
    weights = rng.normal(0, 0.1, (dim, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    share = np.bincount(classes, minlength=len(names)) / len(classes)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(np.arange(held, len(rows))):
            found, weight = inputs[i]
            mean = weight @ embedding[found]
            p = softmax((mean @ weights + bias)[None])[0]
            p[classes[i]] -= 1
            p *= 1 / (share[classes[i]] * len(names))
            back = weights @ p
            weights -= step * np.outer(mean, p)
            bias -= step * 0.1 * p
            # every word's bucket moves by its share of the mean; buckets are many, so the step is larger
            embedding[found] -= (step * 50 * weight)[:, None] * back[None]
    held_rows = range(held) if held else range(len(rows))
    logits = np.array([inputs[i][1] @ embedding[inputs[i][0]] @ weights + bias for i in held_rows])
    true = np.array([classes[i] for i in held_rows])
    heats = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(true)), true] + 1e-12).mean() for t in heats]
    heat = float(heats[int(np.argmin(loss))])
    best = softmax(logits / heat).max(axis=1)
    return LanguageModel(names, (embedding @ weights).astype(np.float32), bias, heat, float(min(0.5, np.quantile(best, lost))))


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """docs with lang_pred, lang_score and lang_rejected for every row.

    lang_pred is `und`, lang_score 0 and lang_rejected true where the text is null or has no letter, or where
    nothing could be learned. Of classes of equal probability the first by name is taken. Very long texts are read whole,
    a slice of rows at a time. Other columns pass through (those of the three names are replaced); repeated rows and null
    ids stay; an empty table gives none.
    """
    text, flag = "text", "__has_letter"
    keep = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_rejected")]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    schema += ", lang_pred string, lang_score double, lang_rejected boolean"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = whole.column(whole.schema.get_field_index(text))
            for a, b in sw.byte_slices(column):
                batch = whole.slice(a, b - a)
                known = np.asarray(batch.column(batch.schema.get_field_index(flag)))
                names, score = np.full(b - a, UNKNOWN, object), np.zeros(b - a)
                rejected = np.ones(b - a, bool)
                if model is not None and known.any():
                    p = model.probabilities(column.slice(a, b - a))
                    best = p.argmax(axis=1)
                    names = np.where(known, np.array(model.names, object)[best], UNKNOWN)
                    score = np.where(known, p[np.arange(b - a), best], 0.0)
                    rejected = ~known | (score < model.reject_below)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], [*keep, "lang_pred", "lang_score", "lang_rejected"])

    return kept.withColumn(flag, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))).mapInArrow(predict, schema)


def identify_languages(docs: DataFrame, labelled: DataFrame, *, per_language: int = 500) -> DataFrame:
    """Learn from labelled (doc_id, text, lang), at most per_language rows of each language, and identify docs."""
    model = fit_language(labelled_sample(labelled, per_language))
    sw.give_back()
    return identify(docs, model)
