"""Packing token streams into fixed windows by Karmarkar-Karp multiway differencing.

Each document is encoded once, where it lies. Runs of `window` tokens leave as full windows at once; what is left
of each document (shorter than a window) is dealt into groups of bounded size. In a group the differencing method
merges partial partitions with opposing imbalances until one partition into k windows is left; k starts at
ceil(tokens / window) and rises until no window exceeds its capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subwords as sw
from .storage import cut

WINDOW = 4096
GROUP = 2048
#: A remainder of over LONG tokens gives up its last FILLER to 5 x FILLER tokens as a piece of their own: with small
#: pieces to place last, the windows come out nearly equal and hardly any is added.
LONG, FILLER = 1000, 16
CACHE_WORDS = 300_000


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids of whole texts, each distinct word form encoded once by the tokenizers library.

    The vocabulary drops white space and never merges across it, so a text's ids are those of its words. Words are
    split at ASCII white space only; any other white space is left to the tokenizer. A word of Latin letters that
    ends in ASCII punctuation other than an apostrophe is two pre-tokens, so its letters, in lower case, go to the library's BPE model by
    themselves and serve every such word; any other word goes through the whole tokenizer. The cache starts anew
    once it holds over CACHE_WORDS forms.
    """

    held: dict[str, WordEncoder] = {}
    PLAIN = "^(?P<core>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<tail>[!-&(-/:-@\\[-`{-~]*)$"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # byte b as the printable character that the byte-level vocabulary uses for it
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {}
        for c in map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]):
            for byte, as_char in zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True):
                self.shown[byte] = as_char
        self.reset()

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One per Python worker: tasks that follow on a worker find its words."""
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def reset(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 14, np.int64)

    def _store(self, words: list[str], coded: list[list[int]]) -> None:
        n, m = len(self.number), int(self.bounds[len(self.number)])
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        ends = m + np.cumsum(lengths)
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), int(ends[-1]) - len(self.ids)), np.uint32)])
        if n + len(words) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(max(len(self.bounds), len(words) + 1), np.int64)])
        self.ids[m : ends[-1]] = np.fromiter(chain.from_iterable(coded), np.uint32, int(lengths.sum()))
        self.bounds[n + 1 : n + 1 + len(words)] = ends
        self.number.update(zip(words, range(n, n + len(words)), strict=True))

    def _numbers(self, forms: pa.Array, cores: bool) -> np.ndarray:
        """Number of each form; a core is kept under its letters, any other under itself with a mark before it."""
        words = forms.to_numpy(zero_copy_only=False).tolist()
        if not cores:
            words = ["\0" + w for w in words]
        new = [w for w in words if w not in self.number]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            if cores:
                shown, tokenize = self.shown, self.model.tokenize
                self._store(part, [[t.id for t in tokenize(w if w.isascii() else "".join(map(shown.__getitem__, w.encode())))] for w in part])
            else:
                self._store(part, [x.ids for x in self.tokenizer.encode_batch([w[1:] for w in part], add_special_tokens=False)])
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of each text in them)."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = np.asarray(lists.offsets).astype(np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        if not len(coded):
            return np.zeros(0, np.uint32), offsets
        if len(self.number) > CACHE_WORDS:
            self.reset()
        units = np.zeros((len(coded.dictionary), 2), np.int64)
        units[:, 1] = self._numbers(pa.array([""]), False)[0]
        split = pc.extract_regex(coded.dictionary, self.PLAIN)
        plain = np.asarray(split.is_valid())
        for at, part, cores in ((0, pc.utf8_lower(split.field("core").filter(pa.array(plain))), True), (1, split.field("tail").filter(pa.array(plain)), False)):
            distinct = part.dictionary_encode()
            if len(distinct):
                units[plain, at] = self._numbers(distinct.dictionary, cores)[np.asarray(distinct.indices)]
        if not plain.all():
            units[~plain, 0] = self._numbers(coded.dictionary.filter(pa.array(~plain)), False)
        of = units[np.asarray(coded.indices)].ravel()
        starts = self.bounds[of]
        lengths = self.bounds[of + 1] - starts
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, ends[2 * offsets]


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 to k - 1) of each item, by Karmarkar-Karp's largest differencing method for k ways.

    A partial partition is a descending vector of k loads less its smallest, with a label per load. The two with
    the largest spread are merged, largest load onto smallest, until one is left.
    """
    n = len(sizes)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    heap = []
    for i in range(n):
        loads, labels = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        loads[0], labels[0] = sizes[i], i
        heap.append((-int(sizes[i]), i, loads, labels))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, mark, a, la = heapq.heappop(heap)
        _, _, b, lb = heapq.heappop(heap)
        b, lb = b[::-1], lb[::-1]
        both = (la >= 0) & (lb >= 0)
        for x, y in zip(la[both].tolist(), lb[both].tolist(), strict=True):
            parent[root(y)] = root(x)
        loads, labels = a + b, np.where(la >= 0, la, lb)
        order = np.argsort(-loads, kind="stable")
        loads, labels = loads[order], labels[order]
        loads = loads - loads[-1]
        heapq.heappush(heap, (-int(loads[0]), mark, loads, labels))
    _, numbers = np.unique([root(i) for i in range(n)], return_inverse=True)
    return numbers


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Near-equal windows of at most capacity; their number rises from the least possible until all fit."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        if k >= len(sizes):
            return np.arange(len(sizes))
        found = differencing(sizes, k)
        if np.bincount(found, weights=sizes).max() <= capacity:
            return found
        k += max(1, k // 500)


def encode_pieces(docs: DataFrame, path: str, end_id: int, window: int, with_ids: bool) -> DataFrame:
    """One row per piece (doc_id, start, length, ids_crc32, doc_tokens[, ids]): full windows, then what is left (with its filler apart)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        for whole in batches:
            for a, b in sw.byte_slices(whole.column(1), 4 << 20):
                ids, offsets = encoder.encode(whole.column(1).slice(a, b - a))
                row, start, length, crc, total, out = [], [], [], [], [], []
                end = np.array([end_id], np.uint32)
                for i in range(b - a):
                    own = np.concatenate([ids[offsets[i] : offsets[i + 1]], end])
                    edges = [*range(0, len(own), window), len(own)]
                    if (rest := edges[-1] - edges[-2]) > LONG and rest < window:
                        edges.insert(-1, len(own) - FILLER - rest % (4 * FILLER))
                    for s, e in zip(edges, edges[1:], strict=False):
                        piece = own[s:e]
                        row.append(a + i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.astype("<u4").tobytes()))
                        total.append(len(own))
                        if with_ids:
                            out.append(piece.astype(np.int32))
                columns = [whole.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(out, pa.list_(pa.int32()))] if with_ids else [])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids])

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def pack(docs: DataFrame, *, path: str | None = None, end_id: int = 2, window: int = WINDOW, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """Pack docs (doc_id, text) into windows: one row per piece with its sequence_id and offset.

    A null or empty text is its end token alone. Repeated rows and null ids are packed like any other row. An empty
    table gives none. Very long texts are cut into full windows, a slice of rows at a time. Other columns of docs are
    left out, whatever their names. Groups hold about `group` remainders whatever their ids, so no key makes a large one.
    """
    pieces = cut(encode_pieces(docs, path or vocabulary_path(), end_id, window, with_ids))
    # the pieces are read from written files, so the row numbers that deal them out are the same on every reread
    pieces = pieces.withColumn("__row", F.monotonically_increasing_id())
    groups = max(1, -(-pieces.where(F.col("length") < window).count() // group))
    full = pieces.where(F.col("length") == window).withColumn("sequence_id", F.col("__row") * 2).withColumn("offset", F.lit(0).cast("long")).drop("__row")
    rest = pieces.where(F.col("length") < window).withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.schema.fields)
    names = full.columns

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__row", ignore_index=True)
        length = rows["length"].to_numpy()
        found = windows(length, window)
        order = np.lexsort((rows["__row"].to_numpy(), found))
        rows, length, found = rows.iloc[order].reset_index(drop=True), length[order], found[order]
        before = np.cumsum(length) - length
        first = np.flatnonzero(np.diff(found, prepend=-1))
        rows["offset"] = before - np.repeat(before[first], np.diff(np.append(first, len(found))))
        # a window has the odd number after its first piece's row number: unique, and never a full window's
        rows["sequence_id"] = np.repeat(rows["__row"].to_numpy()[first], np.diff(np.append(first, len(found)))) * 2 + 1
        return rows.drop(columns=["__row", "__group"])[names]

    return full.unionByName(rest.groupBy("__group").applyInPandas(place, schema))
