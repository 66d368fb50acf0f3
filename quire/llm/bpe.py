"""Byte-level BPE: Spark higher-order functions fold ranked merges over the bytes of distinct words.

The rank map is a literal of the query, in hash buckets (a Spark map is searched from its start, so one map of all
ranks would not do). The most frequent words of a bounded sample of documents are encoded once and broadcast. Then a partition's rows go by
in three narrow steps without a shuffle:

1. each slice of texts is cut into words; words that are neither frequent nor met before by the partition are sent on
   as rows, before the slice's documents, which carry the numbers of their words;
2. Spark folds the merges over the bytes of every word row and decodes the outcome by concatenating the tokens' bytes;
3. documents are put together from their words' ids and bytes.

Steps 1 and 3 rely on the order of rows within a partition, which narrow steps keep; step 3 fails if a document comes
before one of its words.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .subwords import byte_slices

#: Bits of a token's number (its rank and 1) and of a place in a word; NONE is over any number, OUTSIDE is no token's.
ID_BITS, PLACE_BITS = 20, 20
NONE, OUTSIDE = 1 << ID_BITS, 0
#: Words kept by a partition at once; of more, those of the older half that didn't come again are forgotten.
HELD = 300_000
#: Ids of a very long word that go on as one row.
PART = 256
#: Chunks (a word with the white space before and the punctuation after it) of several words whose numbers are kept at once.
HELD_CHUNKS = 100_000
#: Documents in the sample of frequent words (about so many), and words broadcast (at most): some 15 MB.
HEAD_DOCUMENTS, HEAD_WORDS = 20_000, 250_000
#: The fold copies a word's pieces at each merge; a word of more bytes is merged by a heap instead (same result).
LONG_WORD = 2048
READY = pa.list_(pa.int32())
# The white space of the pattern's \s: every character with that Unicode property.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, f.read().splitlines()))}


def token_literal(ranks: dict[bytes, int]) -> Column:
    """array<binary>: the bytes of the token with rank i at place i."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return F.from_json(F.lit(json.dumps([base64.b64encode(t).decode() for t in tokens])), "array<binary>")


def packed_pairs(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """(shift, entries): the number of tokens l and r put together is entries[shift[l] + r] xor l * 2^ID_BITS, if that is under NONE.

    Tokens are numbered from 1, so that the plan, whose text has every entry, has a short one (0) where there is no pair.
    The matrix of ranks by left and right token is sparse: its rows are laid over one another, fullest first, each
    shifted (a shift may be negative) to the first place where none of its entries meets another's.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                rows.setdefault(left + 1, []).append((right + 1, rank + 1))
    size = max(ranks.values(), default=-1) + 2
    held = np.full(size + 2 * sum(map(len, rows.values())), -1, np.int64)
    shift = np.zeros(size, np.int64)
    first, last, among = 0, 0, 0  # no place before `first` is free; rows of `among` entries don't seek before `last`
    for left, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        rights = np.array(sorted(row), np.int64)
        while held[first] >= 0:
            first += 1
        place, step, found = (last if len(row) == among else first), 16, None  # of the row's first entry
        while found is None:
            if place + step + size > len(held):
                held = np.concatenate([held, np.full(len(held) + step, -1, np.int64)])
            free = place + np.flatnonzero(held[place : place + step] < 0)
            for further in rights[1:, 0] - rights[0, 0]:
                free = free[held[free + further] < 0]
                if not len(free):
                    break
            found = int(free[0]) if len(free) else None
            place, step = place + step, 2 * step
        last, among = found, len(row)
        shift[left] = found - rights[0, 0]
        held[found + rights[:, 0] - rights[0, 0]] = (left << ID_BITS) | rights[:, 1]
    held = held[: int(np.flatnonzero(held >= 0).max(initial=-1)) + 1]
    shift[OUTSIDE] = -2 * size  # never in entries
    return shift.tolist(), np.maximum(held, 0).tolist()


@cache
def read_pairs(path: str) -> tuple[list[int], list[int]]:
    return packed_pairs(read_ranks(path))


def with_pairs(path: str, use: Callable[[dict[str, Column]], Column]) -> Column:
    """use(the map of pairs (shift, entries) and the numbers of single bytes), each a literal array that is in the plan once.

    After the 256 bytes come two that are OUTSIDE: what stands before a word and after it.
    """
    ranks, (shift, entries) = read_ranks(path), read_pairs(path)
    single = [*(ranks.get(bytes([b]), NONE - 2) + 1 for b in range(256)), OUTSIDE, OUTSIDE]
    literal = lambda x: F.from_json(F.lit(json.dumps(x)), "array<bigint>")
    return bound(literal(shift), lambda s: bound(literal(entries), lambda e: bound(literal(single), lambda b: use({"shift": s, "entries": e, "bytes": b}))))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once, and in the plan once, however often use refers to it.

    It is what an aggregate of nothing makes of its start; a transform over an array of one would copy its result.
    """
    return F.aggregate(F.from_json(F.lit("[]"), "array<int>"), value, lambda kept, _: kept, use)


def merged_ids(word: Column, pairs: dict[str, Column]) -> Column:
    """Ids of a word (binary) after all ranked merges of its bytes, as a fold over an array of its pieces.

    A piece is one number: that of it and its next piece together (NONE if that is no token), its place in the word,
    and its token's. So the least number is the leftmost pair of the least rank, and it is as many pieces from the
    start as have a smaller place. A step takes it, removes its next piece, and puts the merged piece and the one before
    in with their new pairs; without a pair the state stays as it is. Before the first and after the last piece stands
    one that is OUTSIDE, so in no pair.

    Lambdas are interpreted node by node, so a step has few of them; slice and concat go through lazy sequences and take
    several times as long as a lambda over the few pieces of a word.
    """
    number = lambda x: F.lit(x).cast("bigint")
    low, below, places = number((1 << ID_BITS) - 1), number((1 << (ID_BITS + PLACE_BITS)) - 1), number(((1 << PLACE_BITS) - 1) << ID_BITS)
    none = number(NONE << (ID_BITS + PLACE_BITS))

    def pair_rank(left: Column, right: Column) -> Column:
        """The number of the pair, where a piece has it."""
        entry = F.get(pairs["entries"], (F.get(pairs["shift"], left.cast("int")) + right).cast("int"))
        return F.shiftleft(F.least(entry.bitwiseXOR(F.shiftleft(left, ID_BITS)), number(NONE)), ID_BITS + PLACE_BITS)

    def step(state: Column, _: Column) -> Column:
        def merge(least: Column, k: Column) -> Column:
            """The state with its pieces k and k + 1 (from 0), of which k is the least, as one."""
            new = F.shiftright(least, ID_BITS + PLACE_BITS)

            def joined(before: Column, after: Column) -> Column:
                left = pair_rank(before.bitwiseAND(low), new).bitwiseOR(before.bitwiseAND(below))
                merged = pair_rank(new, F.get(state, k + 2).bitwiseAND(low)).bitwiseOR(least.bitwiseAND(places)).bitwiseOR(new)
                return F.transform(F.array_remove(state, after), lambda y: F.when(y == least, merged).when(y == before, left).otherwise(y))

            return bound(F.get(state, k - 1), lambda before: bound(F.get(state, k + 1), lambda after: joined(before, after)))

        def least(x: Column) -> Column:
            k = bound(x.bitwiseAND(below), lambda at: F.size(F.filter(state, lambda y: y.bitwiseAND(below) < at)))
            return F.when(x >= none, state).otherwise(bound(k, lambda k: merge(x, k)))

        return bound(F.array_min(state), least)

    def start(tokens: Column) -> Column:
        pair = lambda t, k: pair_rank(t, F.coalesce(F.get(tokens, k + 1), number(OUTSIDE)))
        return F.transform(tokens, lambda t, k: pair(t, k).bitwiseOR(F.shiftleft(k.cast("bigint"), ID_BITS).bitwiseOR(t)))

    n = F.octet_length(word)
    text = F.concat(F.lit(chr(256)), F.decode(word, "ISO-8859-1"), F.lit(chr(257)))
    tokens = F.transform(F.split(text, ""), lambda c: F.get(pairs["bytes"], F.ascii(c)))
    folded = F.aggregate(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), bound(tokens, start), step)
    return F.array_remove(F.transform(folded, lambda x: x.bitwiseAND(low).cast("int") - 1), F.lit(OUTSIDE - 1))


def encode_word(word: Column, path: str) -> Column:
    """Ids of a word (binary, not empty) that is no token itself: what the fold of its ranked merges leaves."""
    return with_pairs(path, lambda pairs: merged_ids(word, pairs))


def decode_word(ids: Column, tokens: Column) -> Column:
    """The bytes of ids: their tokens' binary pieces, concatenated."""
    return F.aggregate(ids, F.lit(b""), lambda done, i: F.concat(done, F.get(tokens, i)))


def merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids for a very long word: a linked list of pieces and a heap of their pairs."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        j = after[i] if i >= 0 else n
        if i >= 0 and j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        push(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def split_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets of texts in index, index, distinct chunks): cuts before each white space that a word follows.

    No match of the word pattern spans such a cut, and none beside it changes, so chunks can be matched by themselves. That holds
    for cuts before the first white space after a word as well.
    """
    if pc.any(pc.match_substring_regex(texts, rf"[{SPACE_RE2}][ \n](?:[{SPACE_RE2}]|\z)")).as_py():
        cuts = pc.replace_substring_regex(texts, rf"([\t-\r ])([^{SPACE_RE2}])", "\x00\\1\\2")
    else:  # each space and line feed begins its white space or is the last of it; plain replacement is much cheaper
        cuts = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n")
    lists = pc.split_pattern(cuts, "\x00")
    offsets = np.asarray(lists.offsets).astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return offsets - offsets[0], np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


MARKS = ".,;:!?"  # punctuation that follows words in prose
# SPACE as RE2 writes it.
LETTERS_RE2 = "A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{24f}"
SPACE_RE2 = "\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"


def matches(listed: list[str], pattern: str) -> Iterator[bool]:
    """Whether each chunk is one match of the word pattern by itself, being Latin letters with a space before or without; only the vocabulary's own pattern is known for it."""
    if pattern != spark_pattern(word_pattern()):
        return iter([False] * len(listed))
    return iter(pc.match_substring_regex(pa.array(listed, pa.string()), f"^ ?[{LETTERS_RE2}]+$").to_numpy(zero_copy_only=False).tolist())


def edged(listed: list[str], pattern: str) -> Iterator[bool]:
    """Whether each chunk is Latin letters with a space or line feed before and one of MARKS after, or without: cut_edges has its matches."""
    if pattern != spark_pattern(word_pattern()):
        return iter([False] * len(listed))
    return iter(pc.match_substring_regex(pa.array(listed, pa.string()), f"^[ \\n]?[{LETTERS_RE2}]+[{MARKS}]?$").to_numpy(zero_copy_only=False).tolist())


def cut_edges(chunk: str) -> list[str]:
    """The matches of a chunk that is edged: a line feed and a mark are matches by themselves, a space belongs to its word."""
    words = []
    if chunk[0] == "\n":
        words.append("\n")
        chunk = chunk[1:]
    return [*words, chunk[:-1], chunk[-1]] if chunk[-1] in MARKS else [*words, chunk]


def ragged(flat: np.ndarray, bounds: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows `of` of a ragged array in a row, and where each begins (and the last ends)."""
    starts = bounds[of]
    lengths = bounds[of + 1] - starts
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return flat[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])], ends


def spark_pattern(pattern: str) -> str:
    """The pattern with its white space spelled out, so that every regex library takes the same characters for it."""
    return pattern.replace("[^\\s", f"[^{SPACE}").replace("\\s", f"[{SPACE}]").replace("\\S", f"[^{SPACE}]")


def encoded(rows: DataFrame, path: str) -> DataFrame:
    """rows (word binary, ready array<int>, ...) with ids (ready, else those of word) and their bytes; null where both are null."""
    tokens = token_literal(read_ranks(path))
    rows = rows.withColumn("ids", F.coalesce("ready", F.when(F.col("word").isNotNull(), encode_word(F.col("word"), path)))).drop("ready")
    return rows.withColumn("bytes", F.when(F.col("ids").isNotNull(), bound(tokens, lambda t: decode_word(F.col("ids"), t))))


def frequent_words(docs: DataFrame, path: str, pattern: str) -> pa.Table:
    """(word, ids, bytes), words as text, of the most frequent words of about HEAD_DOCUMENTS documents, HEAD_WORDS at most."""
    ranks = read_ranks(path)
    share = min(1.0, HEAD_DOCUMENTS / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1_000_000)) < int(share * 1_000_000)).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        for whole in batches:
            column = pc.fill_null(whole.column(0), "")
            for a, b in byte_slices(column, 2 << 20):
                _, index, listed = chunks_of(column.slice(a, b - a))
                many: dict[str, int] = {}
                for chunk, n, edge in zip(listed, np.bincount(index, minlength=len(listed)).tolist(), edged(listed, pattern), strict=True):
                    for word in cut_edges(chunk) if edge else find(chunk):
                        many[word] = many.get(word, 0) + n
                short = {w: n for w, n in ((w.encode(), n) for w, n in many.items()) if len(w) <= 64}
                own = [None if rank is None else [rank] for rank in map(ranks.get, short)]
                yield pa.RecordBatch.from_arrays([pa.array(list(short), pa.binary()), pa.array(own, READY), pa.array(list(short.values()), pa.int64())], ["word", "ready", "n"])

    counted = sample.mapInArrow(count, "word binary, ready array<int>, n long").groupBy("word").agg(F.sum("n").alias("n"), F.first("ready").alias("ready"))
    top = counted.orderBy(F.desc("n"), "word").limit(HEAD_WORDS)
    rows = encoded(top.repartition(docs.sparkSession.sparkContext.defaultParallelism), path)
    return rows.select(F.decode("word", "UTF-8").alias("word"), "ids", "bytes").toArrow().combine_chunks()


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """split_chunks, or whole texts where one holds the character by which it marks its cuts."""
    if pc.any(pc.match_substring(texts, "\x00")).as_py():
        listed = texts.to_pylist()
        return np.arange(len(listed) + 1), np.arange(len(listed)), listed
    return split_chunks(texts)


def encode_documents(docs: DataFrame, *, path: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for every row of docs (doc_id, text).

    Null texts are empty: no token, the digests of nothing. Very long texts and words are encoded whole. Repeated rows
    and null ids come out as they came in; other columns are left out, whatever their names; an empty table gives none.
    ids_sha256 is over the ids as little-endian unsigned 32-bit integers.
    """
    path = path or vocabulary_path()
    pattern = spark_pattern(pattern or word_pattern())
    ranks = read_ranks(path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    frequent = frequent_words(docs, path, pattern)
    whole_column = lambda name: pa.concat_arrays(frequent[name].chunks or [pa.array([], frequent.schema.field(name).type)])
    head = docs.sparkSession.sparkContext.broadcast(Numbered(whole_column("word")))
    head_store = docs.sparkSession.sparkContext.broadcast(Held.of(whole_column("ids"), whole_column("bytes")))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        common = head.value.numbers
        count = len(common)  # numbers given, those of the common words first
        older: dict[str, int] = {}  # number of each further word
        known: dict[str, int] = {}  # and of those that came in the newer half
        chunks: dict[str, tuple[int, ...]] = {}  # chunk: its words' numbers
        names = ["kind", "doc_id", "numbers", "word", "ready"]
        for whole in batches:
            ids, column = whole.column(0), pc.fill_null(whole.column(1), "")
            for a, b in byte_slices(column, 2 << 20):
                if len(chunks) > HELD_CHUNKS:
                    chunks = {}
                if len(known) > HELD // 2:
                    live = np.fromiter(known.values(), np.int32, len(known)).tobytes()
                    older, known, chunks = dict(zip(known, range(len(common), len(common) + len(known)), strict=True)), {}, {}
                    count = len(common) + len(older)
                    yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.nulls(1, ids.type), pa.array([live], pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, READY)], names)
                offsets, index, listed = chunks_of(column.slice(a, b - a))
                fresh: list[bytes | None] = []
                ready: list[list[int] | None] = []
                mapped = []
                ones = list(matches(listed, pattern))
                edges = edged([chunk for chunk, one in zip(listed, ones, strict=True) if not one], pattern)
                for chunk, one in zip(listed, ones, strict=True):
                    edge = not one and next(edges)
                    number = common.get(chunk) if one else None
                    numbers = chunks.get(chunk) if not one else None if number is None else (number,)  # a word by itself is looked up as one
                    if numbers is None:
                        numbers = []
                        for word in (chunk,) if one else cut_edges(chunk) if edge else find(chunk):
                            number = common.get(word)
                            if number is None:
                                number = known.get(word)
                                if number is None:
                                    number = older.get(word)
                                    if number is None:
                                        coded = word.encode()
                                        if len(coded) > LONG_WORD:
                                            merged = merge_by_heap(coded, ranks)
                                            for i in range(0, len(merged), PART):
                                                fresh.append(None)
                                                ready.append(merged[i : i + PART])
                                                numbers.append(count)
                                                count += 1
                                            continue
                                        number, count = count, count + 1
                                        own = ranks.get(coded)
                                        fresh.append(coded if own is None else None)
                                        ready.append(None if own is None else [own])
                                    known[word] = number
                            numbers.append(number)
                        numbers = tuple(numbers)
                        if not one and len(chunk) <= LONG_WORD:
                            chunks[chunk] = numbers
                    mapped.append(numbers)
                lengths = np.fromiter(map(len, mapped), np.int64, len(mapped))
                flat = np.fromiter(chain.from_iterable(mapped), np.int32, int(lengths.sum()))
                if fresh:
                    n = len(fresh)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, ids.type), pa.nulls(n, pa.binary()), pa.array(fresh, pa.binary()), pa.array(ready, READY)], names)
                all_numbers, ends = ragged(flat, np.concatenate([[0], np.cumsum(lengths)]), index)
                bounds = ends[offsets]
                rows = [all_numbers[s:e].tobytes() for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                n = b - a
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), ids.slice(a, n), pa.array(rows, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, READY)], names)
                del rows, all_numbers, ends, index, listed, mapped, flat, fresh, ready
            del whole, ids, column
            pa.default_memory_pool().release_unused()

    told = encoded(docs.mapInArrow(words, f"kind int, doc_id {kind}, numbers binary, word binary, ready array<int>"), path)
    told = told.select("kind", "doc_id", "numbers", "ids", "bytes")

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = head_store.value.copy()
        for whole in batches:
            kinds = np.asarray(whole.column(0))
            for part in np.split(np.arange(len(kinds)), np.flatnonzero(kinds == 2)):
                if not len(part):
                    continue
                batch = whole.slice(part[0], len(part))
                own = np.asarray(batch.column(0))
                if own[0] == 2:
                    store.keep(len(head_store.value), np.frombuffer(batch.column(2)[0].as_buffer(), np.int32).astype(np.int64))
                learnt = batch.filter(pa.array(own == 1))
                store.add(learnt.column(3), learnt.column(4))
                rows = batch.filter(pa.array(own == 0))
                n_tokens, ids_hash, text_hash, ids_out, text_out = [], [], [], [], []
                for numbers in rows.column(2):
                    of = np.frombuffer(numbers.as_buffer(), np.int32).astype(np.int64)
                    if len(of) and of.max() >= len(store):
                        raise RuntimeError("a document came before its words: the rows of a partition were reordered")
                    ids, _ = ragged(store.ids, store.id_bounds, of)
                    text, _ = ragged(store.bytes, store.byte_bounds, of)
                    n_tokens.append(len(ids))
                    ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    text_hash.append(hashlib.sha256(text.tobytes()).hexdigest())
                    if with_ids:
                        ids_out.append(ids)
                        text_out.append(text.tobytes())
                columns = [rows.column(1), pa.array(n_tokens, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                more = [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays([*columns, *more], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids])

    return told.mapInArrow(together, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids)


class Numbered:
    """Words and their numbers: an Arrow array until a worker asks for the dictionary, so that the driver holds no object a word."""

    def __init__(self, words: pa.Array) -> None:
        self.words = words

    def __getstate__(self) -> dict:
        return {"words": self.words}

    @cached_property
    def numbers(self) -> dict[str, int]:
        return dict(zip(self.words.to_numpy(zero_copy_only=False).tolist(), range(len(self.words)), strict=True))


class Held:
    """Ids and bytes of words by number."""

    def __init__(self) -> None:
        self.ids, self.id_bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.bytes, self.byte_bounds = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    @classmethod
    def of(cls, ids: pa.Array, text: pa.Array) -> Held:
        out = cls()
        out.add(ids, text)
        return out

    def copy(self) -> Held:
        out = Held()
        out.__dict__.update(self.__dict__)  # arrays are replaced, never written to
        return out

    def add(self, ids: pa.Array, text: pa.Array) -> None:
        if not len(ids):
            return
        self.ids = np.concatenate([self.ids, np.asarray(ids.flatten())])
        self.id_bounds = np.concatenate([self.id_bounds, self.id_bounds[-1] + np.cumsum(np.asarray(ids.value_lengths()), dtype=np.int64)])
        bounds = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
        self.bytes = np.concatenate([self.bytes, np.frombuffer(text.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]])
        self.byte_bounds = np.concatenate([self.byte_bounds, self.byte_bounds[-1] + np.cumsum(np.asarray(pc.binary_length(text)), dtype=np.int64)])

    def keep(self, head: int, live: np.ndarray) -> None:
        """Only the first `head` words and then those numbered `live`, in that order."""
        of = np.concatenate([np.arange(head), live])
        self.ids, self.id_bounds = ragged(self.ids, self.id_bounds, of)
        self.bytes, self.byte_bounds = ragged(self.bytes, self.byte_bounds, of)

    def __len__(self) -> int:
        return len(self.id_bounds) - 1
