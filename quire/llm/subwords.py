"""Words of Arrow text batches and their hashed byte n-grams, for the two embedding classifiers.

A batch is split into words once, its distinct words are hashed once, and documents are sums over
word indices: the cost in Python is per batch, never per row or word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZES = (3, 4, 5)
SLICE_BYTES = 8 << 20
EDGE_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?[\\]^_`{|}~«»“”‘’…¡¿"


def give_back() -> None:
    """Return freed memory to the system after a fit; the driver keeps running for long."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a glibc system
        pass


class Words(NamedTuple):
    """offsets[i]:offsets[i + 1] are the positions of row i in index; index points into distinct."""

    offsets: np.ndarray
    index: np.ndarray
    distinct: pa.Array


def byte_slices(column: pa.Array, at_most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about at_most bytes; a longer row stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > at_most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def split_words(texts: pa.Array) -> Words:
    """Lower-cased words between ASCII white space, without punctuation at their ends; one empty word for a text without any."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.utf8_lower(pc.fill_null(texts, ""))))
    offsets = np.asarray(lists.offsets).astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    trimmed = pc.utf8_trim(coded.dictionary, characters=EDGE_PUNCTUATION).dictionary_encode()
    again = np.asarray(trimmed.indices).astype(np.int64)
    index = again[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.int64)
    return Words(offsets - offsets[0], index, trimmed.dictionary)


def ngrams(words: pa.Array, bits: int, sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every byte n-gram of "<word>" and of the whole; empty words have no n-gram."""
    if not len(words):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    marked = pc.binary_join_element_wise("<", words, ">", "")
    off = np.frombuffer(marked.buffers()[1], np.int32, len(marked) + 1, marked.offset * 4).astype(np.int64)
    data = np.frombuffer(marked.buffers()[2], np.uint8)[off[0] : off[-1]].astype(np.uint32)
    off = off - off[0]
    lengths = np.diff(off)
    of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    full = lengths > 2
    mask = np.uint32((1 << bits) - 1)
    room = sum(int(np.maximum(lengths[full] - n + 1, 0).sum()) for n in sizes) + int(full.sum())
    found_words, found, at = np.empty(room, np.int32), np.empty(room, np.int32), 0

    def mixed(h: np.ndarray, salt: int) -> np.ndarray:
        h = (h + np.uint32(salt * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        return ((h ^ (h >> np.uint32(16))) & mask).astype(np.int32)

    for n in sizes:
        if len(data) < n:
            continue
        h = data[: len(data) - n + 1].copy()
        for k in range(1, n):
            h *= np.uint32(0x01000193)
            h += data[k : len(data) - n + 1 + k]
        inside = (of[: len(h)] == of[n - 1 :]) & full[of[: len(h)]]
        here = slice(at, at + int(inside.sum()))
        found_words[here], found[here], at = of[: len(h)][inside], mixed(h[inside], n), here.stop
    power = np.uint32(0x01000193) ** (np.arange(len(data), dtype=np.uint32) - off[of].astype(np.uint32))
    whole = np.add.reduceat(data * power, off[:-1], dtype=np.uint32)
    found_words[at:], found[at:] = np.flatnonzero(full), mixed(whole[full], 77)
    return found_words, found


def word_sums(words: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the sum of table rows (one per hash bucket) over its n-grams, and their number."""
    of, bucket = ngrams(words, int(table.shape[0]).bit_length() - 1)
    sums = np.stack([np.bincount(of, weights=table[bucket, c], minlength=len(words)) for c in range(table.shape[1])], axis=1)
    return sums, np.bincount(of, minlength=len(words))


def row_sums(values: np.ndarray, words: Words) -> np.ndarray:
    """Sum over each row's words of values[word]."""
    total = np.concatenate([[0.0], np.cumsum(values[words.index])])
    return total[words.offsets[1:]] - total[words.offsets[:-1]]
