"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints are computed where documents lie; only distinct fingerprints go on. Their bits are grouped so that
correlated bits share a partition, each partition gets its own threshold (-1: not probed) by dynamic programming on
estimated candidate counts, with the thresholds' sum set so that every pair within reach agrees within its threshold
in some partition. Probing is a grouping by partition value; each bucket is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import cut, join_hot

BITS = 64
SEED = 42
SAMPLE = 8192
#: Rows of a bucket in one task; larger buckets are verified block by block.
BUCKET = 1 << 16
#: Shingles (of 8 bytes) in a block of a group, and comparisons of fingerprints at once.
SHINGLES, AT_ONCE = 1 << 20, 1 << 21
#: Bits of 128 in which further fingerprints of a pair may differ: at a Jaccard of 0.8 twenty do on average.
MARK_REACH = 40
#: Work of sending a row to a bucket, in comparisons of two fingerprints.
ROW = 1000
#: Keys of texts to compare that are broadcast at most.
BROADCAST_KEYS = 200_000


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit b is 1 if set in over half of the hashes."""
    ones = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every run of `words` words, A-Z lower-cased and space-joined; of the whole if it has fewer words."""
    from xxhash import xxh64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= words:
        return np.array([xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    joined = b" ".join(found)
    ends = (np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-words]]]
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=True)), np.uint64, len(starts))


def word_hashes(text: str) -> np.ndarray:
    """XXH64 of the distinct words."""
    from xxhash import xxh64_intdigest

    found = set(text.encode("utf-8", "surrogatepass").lower().split())
    return np.fromiter((xxh64_intdigest(w, SEED) for w in found), np.uint64, len(found))


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns to keep and fp, the 64 bits as a signed long. Null, empty and blank texts have fingerprint zero."""
    kept = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column(len(keep))):
                hashes = shingle_hashes(text.as_py() or "", words)
                if len(hashes):
                    out[i] = fingerprint_of(hashes)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(out.view(np.int64))], [*keep, "fp"])

    return kept.mapInArrow(compute, f"{schema}, fp long")


def bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal size, each grown by the bit that correlates most with it.

    Correlated bits together leave the groups as independent of each other as may be.
    """
    x = bits.astype(float)
    spread = x.std(axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):  # a bit that is the same everywhere correlates with none
        c = np.abs(np.nan_to_num(np.corrcoef(x.T))) if len(x) > 1 else np.zeros((BITS, BITS))
    left = set(range(BITS))
    out = []
    for g in range(parts):
        size = BITS // parts + (g < BITS % parts)
        own = [max(left, key=lambda b: (spread[b], -b))]
        left.discard(own[0])
        while len(own) < size:
            b = max(left, key=lambda b: (c[own, b].sum(), -b))
            own.append(b)
            left.discard(b)
        out.append(sorted(own))
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (-1 and up, costs[i][t + 1] each) with the given sum and the least cost, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        now: dict[int, tuple[float, list[int]]] = {}
        for sum_so_far, (cost, chosen) in best.items():
            for t, more in enumerate(own, -1):
                s = sum_so_far + t
                if s not in now or cost + more < now[s][0]:
                    now[s] = (cost + more, [*chosen, t])
        best = now
    return best[total]


def plan(sample: np.ndarray, n: int, reach: int, row: float = 50) -> list[tuple[list[int], int]]:
    """Partitions (bits, threshold) with the least estimated work for n fingerprints.

    Of m partitions the thresholds must sum to reach - m + 1: were every partition's distance over its threshold, the
    whole distance would be over reach. Candidates are estimated from the sample's own pairs, smoothed by the number
    expected of independent bits. A row sent costs as much as `row` candidates; rows of large buckets are sent once
    per block.
    """
    bits = bit_matrix(sample)
    p = bits.mean(axis=0)
    agree = p * p + (1 - p) * (1 - p)
    left = np.arange(0, len(sample) - 1)
    rng = np.random.default_rng(5)
    right = (left + 1 + rng.integers(0, max(1, len(sample) - 1), len(left))) % max(1, len(sample))
    apart = bits[left] != bits[right] if len(left) else np.zeros((0, BITS), bool)
    options = []
    for m in range(1, reach + 3):
        groups = group_bits(bits, m)
        costs = []
        for own in groups:
            distance = apart[:, own].sum(axis=1)
            even = np.array([1.0])
            for b in own:
                even = np.convolve(even, [agree[b], 1 - agree[b]])
            price = [0.0]
            for t in range(reach + 1):
                probes = sum(len(list(combinations(range(len(own)), k))) if k < 3 else len(own) ** k for k in range(t + 1))
                share = max(float((distance <= t).mean()) if len(distance) else 0.0, float(even[: t + 1].sum()))
                price.append(n * probes * row * max(1.0, n * probes / 2 ** len(own) / BUCKET) + n * n / 2 * share)
            costs.append(price)
        cost, thresholds = allocate(costs, reach - m + 1)
        options.append((cost, [(own, t) for own, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(options, key=lambda x: x[0])[1]


def joined(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Make rows p[i] and q[i] one group each: label[row] is the smallest row of its group, before and after."""
    while len(p):
        a, b = label[p], label[q]
        apart = a != b
        p, q, a, b = p[apart], q[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def close_pairs(fps: DataFrame, reach: int = 2, row: float = 50, jaccard: float = 0) -> DataFrame:
    """(a, b): distinct fingerprints (fp) linked at reach or fewer differing bits, as a spanning forest of each bucket.

    Of sets (set, fp, mark, mark2, size) the same for sets, less pairs whose sizes exclude the Jaccard or whose marks,
    further fingerprints, differ in over MARK_REACH bits: without those, chance links of a wide reach connect most of a
    table. Buckets of over BUCKET rows are few (a share of the rows, counted): they are dealt out by pairs of blocks.
    """
    sets = "set" in fps.columns
    names = ["set", "fp", "mark", "mark2"] if sets else ["fp"]
    name = names[0]
    n = fps.count()
    sample = np.array([r["fp"] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64)
    if n < 2:
        return fps.select(F.col(name).alias("a"), F.col(name).alias("b")).limit(0)
    parts = plan(sample, n, reach, row)
    rows = n * sum(comb(len(own), j) for own, t in parts for j in range(t + 1))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each fingerprint at its own value of each partition (tag odd), and as a question at the values within the threshold."""
        for batch in batches:
            fp = np.asarray(batch.column(names.index("fp"))).view(np.uint64)
            tag = np.asarray(batch.column(len(names))) << 3 if sets else np.zeros(len(fp), np.int64)
            for k, (own, t) in enumerate(parts):
                value = fp & np.uint64(sum(1 << b for b in own))
                for j in range(t + 1):
                    for flip in combinations(own, j):
                        key = mixed((value ^ np.uint64(sum(1 << b for b in flip))) + np.uint64(k) * np.uint64(0xD6E8FEB86659FD93))
                        yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(tag | (j == 0)), pa.array(key.view(np.int64))], [*names, "tag", "key"])

    probed = fps.select(*names, *["size"] * sets).mapInArrow(probe, ", ".join(f"{c} long" for c in [*names, "tag", "key"]))
    cell = F.pmod("key", F.lit(min(1 << 20, max(1, 8 * rows // BUCKET))))
    crowded = probed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BUCKET).select("cell")
    large = probed.withColumn("cell", cell).join(F.broadcast(crowded), "cell", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    large = large.where(F.col("size") > BUCKET).select("key", F.ceil(F.col("size") / BUCKET).cast("int").alias("blocks"))
    held = probed.join(F.broadcast(large), "key", "left")  # one in BUCKET rows at most
    block = F.pmod(F.xxhash64(name), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    held = held.withColumn("block", block).withColumn("other", F.explode(other))
    # many small buckets share a group, so that a task's Python work isn't one call per bucket
    deal = F.when(F.col("other") < 0, F.pmod("key", F.lit(max(1, rows // BUCKET)))).otherwise(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")))
    side = F.when(F.col("block") < F.col("other"), 2).when(F.col("block") > F.col("other"), 4).otherwise(0)  # of a pair of blocks
    held = held.select(deal.alias("deal"), "key", F.col("tag").bitwiseOR(side.cast("bigint")).alias("tag"), *names)

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        key, tag = rows["key"].to_numpy(), rows["tag"].to_numpy()
        order = np.lexsort((1 - (tag & 1), key))  # in a bucket those at their own value first
        key, tag = key[order], tag[order]
        ids, *rest = (rows[c].to_numpy()[order] for c in names)
        prints = [x.view(np.uint64) for x in rest or [ids]]
        own, side, size = (tag & 1).astype(bool), tag & 6, tag >> 3
        label = np.arange(len(key))

        def link(p: np.ndarray, q: np.ndarray) -> None:
            """Join the rows of those pairs that are within reach."""
            near = np.bitwise_count(prints[0][p] ^ prints[0][q]) <= reach
            p, q = p[near], q[near]
            keep = (ids[p] != ids[q]) & ((side[p] == 0) | (side[p] != side[q]))
            if sets:
                keep &= np.bitwise_count(prints[1][p] ^ prints[1][q]) + np.bitwise_count(prints[2][p] ^ prints[2][q]) <= MARK_REACH
                keep &= np.minimum(size[p], size[q]) >= jaccard * np.maximum(size[p], size[q]) - 1e-9
            joined(label, p[keep], q[keep])

        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        narrow = np.repeat(sizes <= 32, sizes)
        for d in range(1, int(sizes[sizes <= 32].max(initial=1))):
            p = np.flatnonzero((key[:-d] == key[d:]) & narrow[:-d] & own[:-d])  # of a pair one at least is at its own value
            link(p, p + d)
        for s, many in zip(starts[sizes > 32].tolist(), sizes[sizes > 32].tolist(), strict=True):
            owners = int(own[s : s + many].sum())
            at = s
            while at < s + owners:
                step = min(max(1, AT_ONCE // (s + many - at)), s + owners - at)
                near = np.bitwise_count(prints[0][at : at + step, None] ^ prints[0][None, at : s + many]) <= reach
                p, q = np.nonzero(near)
                link(at + p, at + q)
                at += step
        found = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": ids[found], "b": ids[label[found]]})

    return held.groupBy("deal").applyInPandas(verify, "a long, b long")


def grouped(docs: DataFrame, words: int, reach: int, keep: tuple[str, ...]) -> DataFrame:
    """The columns to keep (doc_id among them), fp, and per group component (a fingerprint) and component_id."""
    marked = cut(fingerprints(docs, words, keep))
    first = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    linked = components(close_pairs(first.select("fp"), reach))
    of = first.join(linked.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "first", "n", F.coalesce("component", "fp").alias("component"))
    least = of.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("m"))
    of = join_hot(of.drop("first"), least, "component", "m", first.count())
    return join_hot(marked, of, "fp", "n", marked.count())


def near_duplicates(docs: DataFrame, *, words: int = 3, reach: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row: documents are linked where fingerprints differ in at most reach bits.

    component_id is the smallest doc_id reachable. Null texts and texts without a word share fingerprint zero; very long
    ones are read whole. Repeated rows come out as often as they came in. A null doc_id gets the component's smallest id,
    null where it has none. Other columns are left out, whatever their names; an empty table gives none.
    """
    return grouped(docs, words, reach, ("doc_id",)).select("doc_id", "fp", "component_id")


def as_hex(fp):
    """16 lowercase hex digits of a signed long's 64 bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def mixed(x: np.ndarray) -> np.ndarray:
    """Other hashes of hashes (SplitMix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def set_keys(docs: DataFrame, words: int, keep: tuple[str, ...], whole: bool = False) -> DataFrame:
    """The columns to keep, and set (a digest of the distinct shingles), with fp, two marks and size (their number).

    fp is the fingerprint of the distinct single words: a changed word changes `words` shingles but one word, so texts
    of similar shingles lie much closer there. The marks are fingerprints of the shingles.

    With whole, the columns to keep, set and the sorted shingles.
    """
    kept = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            fp, mark, mark2, key, size = np.zeros((5, batch.num_rows), np.uint64)
            own = []
            for i, text in enumerate(batch.column(len(keep))):
                hashes = shingle_hashes(text.as_py() or "", words)
                distinct = np.unique(hashes)
                held = distinct.astype("<u8").tobytes()
                key[i], size[i] = xxh3_64_intdigest(held, SEED), len(distinct)
                if whole:
                    own.append(held)
                elif len(hashes):
                    fp[i], mark[i], mark2[i] = fingerprint_of(word_hashes(text.as_py())), fingerprint_of(distinct), fingerprint_of(mixed(distinct))
            found = {"set": pa.array(key.view(np.int64))}
            found |= {"shingles": pa.array(own, pa.binary())} if whole else {n: pa.array(x.view(np.int64)) for n, x in (("fp", fp), ("mark", mark), ("mark2", mark2), ("size", size))}
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *found.values()], [*keep, *found])

    return kept.mapInArrow(compute, f"{schema}{', ' if schema else ''}set long, {'shingles binary' if whole else 'fp long, mark long, mark2 long, size long'}")


def similar_sets(left: list[np.ndarray], right: list[np.ndarray], names: np.ndarray, others: np.ndarray, least: float) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs (a name, another's) of sets of Jaccard `least` and more, counted exactly."""
    sizes = np.array([len(x) for x in right])
    flat, of = np.concatenate(right), np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    label: dict[int, int] = {n: i for i, n in enumerate(dict.fromkeys([*names.tolist(), *others.tolist()]))}
    group = np.arange(len(label))
    at, to = np.array([label[n] for n in names.tolist()]), np.array([label[n] for n in others.tolist()])
    out_a, out_b = [], []
    for i, own in enumerate(left):
        mine = group[at[i]]
        if not len(own) or (group[to] == mine).all():
            continue
        low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
        many = high - low
        spots = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        shared = np.bincount(of[spots], minlength=len(right))
        for j in np.flatnonzero(shared >= least * (len(own) + sizes - shared) - 1e-9):
            if shared[j] and group[to[j]] != group[at[i]]:
                out_a.append(int(names[i]))
                out_b.append(int(others[j]))
                group[group == group[to[j]]] = group[at[i]]
    return out_a, out_b


def similar_groups(rows: DataFrame, words: int, reach: int, jaccard: float) -> DataFrame:
    """(doc_id, __key, component) of rows (doc_id, __key, text): linked where the Jaccard of their shingles is `jaccard` and more.

    Candidates are the groups that fingerprints within reach connect; in them, sets are compared exactly and block by
    block, so that no task holds more than two blocks of a group. Only the reach, of both fingerprints, can miss a pair.
    """
    marked = cut(set_keys(rows, words, ("doc_id", "__key")))
    sets = cut(marked.groupBy("set").agg(*[F.min(c).alias(c) for c in ("fp", "mark", "mark2", "size", "__key")]))
    near = components(close_pairs(sets.drop("__key"), reach, row=ROW, jaccard=jaccard)).select(F.col("id").alias("set"), F.col("component").alias("near"))
    placed = sets.select("set", "__key", "size").join(near, "set")
    blocks = placed.groupBy("near").agg(F.ceil(F.sum("size") / SHINGLES).cast("int").alias("blocks"))
    placed = cut(placed.join(blocks, "near").drop("size"))
    number = placed.count()
    keys = placed.select("__key").distinct()
    keys = F.broadcast(keys) if number <= BROADCAST_KEYS else keys  # counted, so safe to broadcast
    texts = set_keys(rows.join(keys, "__key", "left_semi"), words, (), whole=True).dropDuplicates(["set"])
    held = texts.join(placed.drop("__key"), "set").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    deals = max(1, number // 256)
    deal = F.when(F.col("blocks") > 1, F.xxhash64("near", F.least("block", "other"), F.greatest("block", "other"))).otherwise(F.pmod(F.xxhash64("near"), F.lit(deals)))
    held = held.select(deal.alias("deal"), "near", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set", "shingles")

    def verify(part: pd.DataFrame) -> pd.DataFrame:
        out_a, out_b = [], []
        for (_, i, j), own in part.groupby(["near", "i", "j"], sort=False):
            x = [np.frombuffer(b, "<u8") for b in own["shingles"]]
            block, names = own["block"].to_numpy(), own["set"].to_numpy()
            l, r = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if len(l) and len(r):
                a, b = similar_sets([x[k] for k in l], [x[k] for k in r], names[l], names[r], jaccard)
                out_a += a
                out_b += b
        return pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})

    edges = held.groupBy("deal").applyInPandas(verify, "a long, b long")
    linked = components(edges).withColumnRenamed("id", "set")
    return marked.join(linked, "set", "left").select("doc_id", "__key", F.coalesce("component", "set").alias("component"))


def one_of_each(docs: DataFrame, *, words: int = 3, reach: int = 2, jaccard: float | None = None) -> DataFrame:
    """docs less all but one document of each group: that with the smallest doc_id stays, with all its columns.

    With jaccard, documents are linked where their shingles have that Jaccard and more and fingerprints within reach
    lead from one to the other; without, where fingerprints differ in at most reach bits.
    Of repeated rows of that doc_id one stays. A group without any doc_id keeps one of its texts. Whole rows are
    shuffled once, by the key that both the choice and the repeated rows go by.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("~"), F.md5(F.coalesce("text", F.lit("")))))
    rows = docs.withColumn("__key", key)
    found = grouped(rows, words, reach, ("doc_id", "__key")) if jaccard is None else similar_groups(rows, words, reach, jaccard)
    kept = found.groupBy("component").agg(F.min_by("__key", F.struct(F.col("doc_id").isNull(), "doc_id", "__key")).alias("__key"))
    return rows.join(kept.select("__key"), "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
