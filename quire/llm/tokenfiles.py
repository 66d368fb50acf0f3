"""Token ids of documents in Parquet files: a list column of ids that a reader can take in part.

Files stand in ascending order of ids, cut by range, so that each row knows its place in its file (`offset`) and a small
table of the files' sizes gives it the place in all (`start`). Ids are dictionary-coded (a vocabulary's worth of values
at most, bit-packed), the sorted numbers beside them are delta-coded. Row groups are bounded in bytes and pages in rows;
Parquet's statistics and page indexes over doc_id and offset then let a reader fetch some documents, or some span of ids,
from the pages that hold them, and the metadata without any page of ids.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import subwords as sw
from .packing import WordEncoder, vocabulary_path
from .storage import BROADCAST_ROWS, fresh_path

VOCABULARY = "byte_bpe_50k.json"
#: Bytes of a row group, rows of a page.
ROW_GROUP, PAGE_ROWS = 16 << 20, 128
#: Bytes of texts that are encoded at once, distinct pieces given to the tokenizer at once, and bytes of ids in a batch.
SLICE, PIECES, BATCH = 3 << 20, 2_000, 4 << 20
#: Distinct pieces that a worker remembers.
CACHE_PIECES = 200_000


def layout(row_group: int = ROW_GROUP, page_rows: int = PAGE_ROWS) -> dict[str, str]:
    """Options of Spark's Parquet writer for token files."""
    return {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",  # delta coding of whole numbers that have no dictionary
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#offset": "false",
        "parquet.block.size": str(row_group),
        "parquet.page.row.count.limit": str(page_rows),
    }


class PieceEncoder(WordEncoder):
    """Token ids of whole texts, each distinct piece encoded once by the tokenizers library.

    The vocabulary's pre-tokenizer lets a match begin with one space and never has one go from a character that isn't white
    space to one that is. So a text falls apart before a space that a plain character follows, and around a line feed
    that stands alone between plain characters, whatever stands elsewhere; the pieces between are encoded as texts of
    their own. Plain is what surely isn't white space, judged by its first or only byte. A text that holds an added token's
    string is encoded whole.
    """

    held: dict[str, WordEncoder] = {}
    LETTERS = "^(?P<core> ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<tail>[!-/:-@\\[-`{-~]*)$"

    def __init__(self, path: str) -> None:
        from tokenizers import pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        super().__init__(path)
        space = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")[0][0]
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(len(vocabulary), bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(space)]] = True
        # bytes of letters and the space as the vocabulary's characters for them
        self.levels = {**self.shown, ord(" "): space}
        self.apart = not any(space in token.lstrip(space) and set(token) <= set(self.levels.values()) for token in vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = np.zeros(256, bool)
        plain[0x21:0x7F] = True
        self.plain_last = plain.copy()
        plain[0xC3:0xF5] = True
        plain[[0xE1, 0xE2, 0xE3]] = False  # these and 0xC2 begin white space too
        self.plain_first = plain

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each of the bytes."""
        after = np.append(self.plain_first[data[1:]], False)
        starts = (data == 0x20) & after
        feeds = np.flatnonzero((data == 0x0A) & after)
        feeds = feeds[feeds > 0]
        feeds = feeds[self.plain_last[data[feeds - 1]]]
        starts[feeds] = starts[feeds + 1] = True
        return starts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of each text in them)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        texts = pa.concat_arrays([texts])  # offsets from 0
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        if len(self.number) > CACHE_PIECES:
            self._trim()
        starts = self.cuts(data)
        whole = np.zeros(len(texts), bool)
        for content in self.special:
            whole |= np.asarray(pc.match_substring(texts, content))
        for i in np.flatnonzero(whole).tolist():
            starts[bounds[i] : bounds[i + 1]] = False
        # a text's start begins a piece too; an empty text has none
        starts[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(starts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        edges = np.append(starts, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pieces.dictionary_encode()
        # ids of the distinct pieces in a row, then those of all pieces by their places in it
        held, at = self._ids_of(self._units(coded.dictionary))
        of = np.asarray(coded.indices)
        lengths = np.diff(at)[of]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = held[np.repeat(at[of] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(starts, bounds)]

    def _ids_of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows of units, the place at which each row's begin, and their end)."""
        of = units.ravel()
        begin = self.bounds[of]
        lengths = self.bounds[of + 1] - begin
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[np.repeat(begin - ends[:-1], lengths) + np.arange(ends[-1])], ends[::2]

    def _units(self, forms: pa.Array) -> np.ndarray:
        """Two numbers for each piece: of Latin letters with the space before them and of the punctuation after them, else of the whole piece and none."""
        units = np.zeros((len(forms), 2), np.int64)
        units[:, 1] = self._numbers(pa.array([""]), False)[0]
        split = pc.extract_regex(forms, self.LETTERS)
        plain = np.asarray(split.is_valid())
        for at, part, cores in ((0, "core", True), (1, "tail", False)):
            distinct = split.field(part).filter(pa.array(plain)).dictionary_encode()
            if len(distinct):
                units[plain, at] = self._numbers(distinct.dictionary, cores)[np.asarray(distinct.indices)]
        if not plain.all():
            units[~plain, 0] = self._numbers(forms.filter(pa.array(~plain)), False)
        return units

    def _numbers(self, forms: pa.Array, cores: bool) -> np.ndarray:
        """Number of each form.

        Forms of one space and letters are words of the model each. No merge of the vocabulary reaches from a letter to a
        space, so many go to the model side by side; a token that begins with a space then begins a form.
        """
        words = forms.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in words if w not in self.number]
        spaced = [w for w in new if w[:1] == " "] if cores and self.apart else []
        for i in range(0, len(spaced), PIECES):
            part = spaced[i : i + PIECES]
            ids = np.array([t.id for t in self.model.tokenize("".join(part).encode().decode("latin-1").translate(self.levels))], np.uint32)
            self._keep(part, ids, np.diff(np.flatnonzero(self.begins[ids]), append=len(ids)))
        others = [w for w in new if w[:1] != " "] if cores and self.apart else new
        for i in range(0, len(others), PIECES):
            part = others[i : i + PIECES]
            coded = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            self._keep(part, np.fromiter(chain.from_iterable(coded), np.uint32), np.fromiter(map(len, coded), np.int64, len(coded)))
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.uses[numbers] += 1
        return numbers

    def reset(self) -> None:
        super().reset()
        self.uses = np.zeros(1 << 14, np.int32)

    def _trim(self) -> None:
        """Forget pieces that were asked for least often, at least half of them: most stand in one text only."""
        n, least = len(self.number), 2
        while np.count_nonzero(self.uses[:n] >= least) > CACHE_PIECES // 2:
            least += 1
        kept = np.flatnonzero(self.uses[:n] >= least)
        words, ids, bounds = list(self.number), self.ids, self.bounds
        lengths = bounds[kept + 1] - bounds[kept]
        ends = np.cumsum(lengths)
        self.reset()
        self._keep([words[i] for i in kept.tolist()], ids[np.repeat(bounds[kept] - ends + lengths, lengths) + np.arange(lengths.sum())], lengths)
        self.uses[: len(kept)] = 1

    def _keep(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Add words, whose ids stand in a row."""
        n = len(self.number)
        m = int(self.bounds[n])
        room = lambda a, size: a if size <= len(a) else np.concatenate([a, np.zeros(max(len(a), size - len(a)), a.dtype)])
        self.ids, self.bounds, self.uses = room(self.ids, m + len(ids)), room(self.bounds, n + len(words) + 1), room(self.uses, n + len(words))
        self.ids[m : m + len(ids)] = ids
        self.bounds[n + 1 : n + 1 + len(words)] = m + np.cumsum(lengths)
        self.number.update(zip(words, range(n, n + len(words)), strict=True))


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) cut by ranges of ids and sorted; null ids first, rows of one id by a hash of their text, then by the text."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """docs in the order they have as (doc_id, part, offset, n_tokens, ids): part is the task's number, offset the ids before the row in it."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, offset = PieceEncoder.of(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in sw.byte_slices(batch.column("text"), SLICE):
                ids, bounds = encoder.encode(batch.column("text").slice(a, b - a))
                sizes = np.diff(bounds)
                # the end token after each document
                ids, bounds = np.insert(ids, bounds[1:], end_id), np.concatenate([[0], np.cumsum(sizes + 1)])
                for c, d in split_rows(bounds * 4, BATCH):
                    lists = pa.ListArray.from_arrays(pa.array((bounds[c : d + 1] - bounds[c]).astype(np.int32)), pa.array(ids[bounds[c] : bounds[d]].astype(np.int32)))
                    columns = [batch.column("doc_id").slice(a + c, d - c), pa.array(np.full(d - c, part, np.int32)), pa.array(offset + bounds[c:d]), pa.array(np.diff(bounds[c : d + 1])), lists]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "offset", "n_tokens", "ids"])
                offset += int(bounds[-1])
            sw.give_back()

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {id_type}, part int, offset long, n_tokens long, ids array<int>")


def split_rows(ends: np.ndarray, at_most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about at_most bytes, given the bytes before each row (and all)."""
    cuts = [0]
    while cuts[-1] < len(ends) - 1:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, ends[cuts[-1]] + at_most, "right")) - 1))
    return pairwise(cuts)


def write(docs: DataFrame, path: str, *, vocabulary: str | None = None, end_id: int = 0, row_group: int = ROW_GROUP, page_rows: int = PAGE_ROWS) -> None:
    """Write the ids of docs (doc_id, text), each with end_id after it, below path: `ids` has the documents, `parts` the files' places.

    A null text is an empty one: its end token alone. Rows that repeat an id stand side by side, null ids first. A text is
    encoded and written whole, however long. An empty table makes empty tables. Further columns of docs are left out,
    whatever their names.
    """
    encoded(in_order(docs), vocabulary or vocabulary_path(VOCABULARY), end_id).write.options(**layout(row_group, page_rows)).parquet(f"{path}/ids")
    sizes = docs.sparkSession.read.parquet(f"{path}/ids").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    sizes.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")).alias("part_start"), "n_tokens", "n_docs").coalesce(1).write.parquet(f"{path}/parts")


def with_start(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """rows of token files with start, the number of ids before them in all files, in place of part and offset."""
    parts = spark.read.parquet(f"{path}/parts").select("part", "part_start")
    if parts.count() <= BROADCAST_ROWS:  # a row per file
        parts = F.broadcast(parts)
    return rows.join(parts, "part").withColumn("start", F.col("part_start") + F.col("offset")).drop("part", "offset", "part_start")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, start) of all documents; no page of ids is read."""
    return with_start(spark, path, spark.read.parquet(f"{path}/ids").select("doc_id", "part", "offset", "n_tokens"))


def documents(spark: SparkSession, path: str, first: object = None, last: object = None) -> DataFrame:
    """(doc_id, n_tokens, ids, start) of documents with first <= doc_id <= last; row groups and pages of other ids are passed over."""
    rows = spark.read.parquet(f"{path}/ids")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return with_start(spark, path, rows)


def span(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """(doc_id, start, ids) of the ids from place begin to before end, document by document; other files and pages are passed over."""
    parts = spark.read.parquet(f"{path}/parts").where((F.col("part_start") < end) & (F.col("part_start") + F.col("n_tokens") > begin))
    rows = spark.read.parquet(f"{path}/ids")
    bounds = parts.agg(F.min("part").alias("a"), F.max("part").alias("b"), F.min("part_start").alias("s"), F.max("part_start").alias("t")).first()
    if bounds["a"] is None:
        rows = rows.where(F.lit(False))
    else:
        low, high = F.col("part") > bounds["a"], F.col("part") < bounds["b"]
        rows = rows.where(F.col("part").between(bounds["a"], bounds["b"]))
        rows = rows.where((low | (F.col("offset") + F.col("n_tokens") > begin - bounds["s"])) & (high | (F.col("offset") < end - bounds["t"])))
    rows = with_start(spark, path, rows)
    skipped = F.greatest(F.lit(begin) - F.col("start"), F.lit(0))
    length = F.least(F.lit(end) - F.col("start"), F.col("n_tokens")) - skipped
    return rows.select("doc_id", (F.col("start") + skipped).alias("start"), F.slice("ids", (skipped + 1).cast("int"), length.cast("int")).alias("ids"))


def checked(rows: DataFrame) -> DataFrame:
    """rows of token files with ids_crc32, the unsigned CRC-32 of the ids as little-endian unsigned 32-bit numbers, in place of ids."""
    kept = [f for f in rows.schema.fields if f.name != "ids"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = np.asarray(lists.offsets).astype(np.int64) * 4
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            crc = pa.array([zlib.crc32(data[a:b]) for a, b in pairwise(bounds.tolist())], pa.int64())
            sw.give_back()
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), crc], [*(f.name for f in kept), "ids_crc32"])

    return rows.mapInArrow(check, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ids_crc32 long"]))


def round_trip(docs: DataFrame, *, path: str | None = None, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of docs, from token files written below path (a new shared folder if None)."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "tokens")
    write(docs, path, vocabulary=vocabulary, end_id=end_id)
    rows = checked(spark.read.parquet(f"{path}/ids").select("doc_id", "part", "offset", "n_tokens", "ids"))
    return with_start(spark, path, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
