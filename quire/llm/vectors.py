"""Embedding near-dedup: an exact metric range join.

Unit vectors are partitioned by their nearest of a bounded number of pivots. Two vectors with cosine >= t lie within
r = sqrt(2 - 2 t) of each other, so by the triangle inequality a vector is needed in the cell of another pivot only if
its distance to that pivot exceeds its distance to its own by at most 2 r: that sets the boundary replication. Cells
join independently; a pair counts for a vector in that vector's home cell alone, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import cut, join_hot

BLOCK = 16384
MOST_PIVOTS = 1024
SAMPLE = 4096


def fine_vector() -> Column:
    """Whether embedding can link; false, never null, where it can't."""
    finite = F.forall("embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce((F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, x) of vectors that can link: not null or zero, no null or non-finite component; -0 as 0."""
    return table.where(fine_vector()).select("vec_id", F.transform("embedding", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)).alias("x"))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: list[np.ndarray], n: int, reach: float, seed: int = 3) -> list[np.ndarray]:
    """For each vector length, pivots from the (bounded) sample.

    Their number is the one with the least estimated work for n vectors: comparisons in cells (home x all members,
    from the sample's own replication) against copies sent. Data without structure leave one cell, which is then
    joined block by block; clustered data get many.
    """
    rng = np.random.default_rng(seed)
    out = []
    for dims in sorted({len(x) for x in sample}):
        x = unit(np.stack([v for v in sample if len(v) == dims]))
        order = rng.permutation(len(x))
        best, least = x[order[:1]], np.inf
        many = 1
        while many <= min(MOST_PIVOTS, max(1, len(x) // 4)):
            own = np.unique(x[order[:many]], axis=0)
            home, row, cell = members(x, own, reach)
            inside, sent = np.bincount(home, minlength=len(own)), np.bincount(cell, minlength=len(own))
            compared = float((inside * sent).sum()) / len(x) ** 2 * n * n * dims * 2e-10
            moved = len(row) / len(x) * n * dims * 1e-7
            if compared + moved < least:
                best, least = own, compared + moved
            many *= 4
        out.append(best)
    return out


def members(v: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home pivot of each vector, and row and cell of every membership, home included).

    If u within reach of v has pivot q as its nearest, then by the triangle inequality d(v, q) <= d(v, home) + 2 reach,
    and v lies no farther than reach beyond the plane between both pivots; v joins the cells that meet both.
    """
    d = np.sqrt(np.maximum(0, 2 - 2 * v @ pivots.T))
    home = d.argmin(axis=1)
    own = d[np.arange(len(v)), home][:, None]
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))[home]
    keep = (d <= own + 2 * reach + 1e-9) & (d**2 - own**2 <= 2 * reach * apart + 1e-9)
    keep[np.arange(len(v)), home] = True
    row, cell = np.nonzero(keep)
    return home, row, cell


def range_links(data: DataFrame, cosine: float, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(links, edges) among data's distinct vectors (rep, copies, x).

    links: (rep, n) with n linked vectors, copies of other vectors counted. edges: (a, b), enough pairs to connect
    what links connect. A cell of many vectors is joined block by block, so no task holds more than two blocks.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    sample = data.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE).toPandas()["x"].tolist()
    pivots = choose_pivots(sample, data.count(), reach)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2)
            flat, lengths = np.asarray(x.flatten(), dtype=float), np.asarray(x.value_lengths())
            at = np.cumsum(lengths) - lengths
            first = 0
            # a length that the sample lacks has a cell of its own, numbered below zero
            rest = np.flatnonzero((lengths > 0) & ~np.isin(lengths, [own.shape[1] for own in pivots]))
            for rows in np.array_split(rest, max(1, len(rest) // 1024)):
                if len(rows):
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(-lengths[rows], pa.int32()), pa.array(np.full(len(rows), True))], ["rep", "copies", "x", "cell", "home"])
            for own in pivots:
                dims = own.shape[1]
                here = np.flatnonzero(lengths == dims)
                for rows in np.array_split(here, max(1, len(here) // 1024)):
                    if len(rows):
                        home, row, cell = members(unit(flat[at[rows][:, None] + np.arange(dims)]), own, reach)
                        part = batch.take(pa.array(rows[row]))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(first + cell, pa.int32()), pa.array(cell == home[row])], ["rep", "copies", "x", "cell", "home"])
                first += len(own)

    kinds = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    placed = cut(data.select("rep", "copies", "x").mapInArrow(place, f"rep {kinds['rep']}, copies long, x {kinds['x']}, cell int, home boolean"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    # a row per pivot, and pivots are MOST_PIVOTS at most for each vector length, or per other length: safe to broadcast
    placed = placed.join(F.broadcast(sizes), "cell").withColumn("parts", F.ceil(F.col("size") / block).cast("int")).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    sent = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.select("cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "home", "rep", "copies", "x")

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        part = rows["part"].to_numpy()
        a, same = rows[part == rows["i"].iat[0]], rows["i"].iat[0] == rows["j"].iat[0]
        b = a if same else rows[part == rows["j"].iat[0]]
        found = [pd.DataFrame({"rep": a["rep"].to_numpy()[:0], "n": np.zeros(0, np.int64), "other": a["rep"].to_numpy()[:0]})]
        if len(a) and len(b):
            ua, ub = unit(np.stack(a["x"].to_numpy()).astype(float)), unit(np.stack(b["x"].to_numpy()).astype(float))
            ia, ib, na, nb, ha, hb = (x[c].to_numpy() for c in ("rep", "copies", "home") for x in (a, b))
            fa, fb = ua.astype(np.float32), ub.astype(np.float32)
            for start in range(0, len(ua), 256):
                # single precision finds all that could link, double precision decides
                p, q = np.nonzero(fa[start : start + 256] @ (fb[start:] if same else fb).T >= cosine - 1e-4)
                p, q = p + start, q + (start if same else 0)
                if same:
                    p, q = p[p < q], q[p < q]
                near = np.concatenate([np.einsum("ij,ij->i", ua[p[k : k + 65536]], ub[q[k : k + 65536]]) for k in range(0, len(p), 65536)] or [np.zeros(0)])
                sure = near >= cosine
                for k in np.flatnonzero(np.abs(near - cosine) < 1e-12):
                    sure[k] = close(ua[p[k]], ub[q[k]], cosine)
                p, q = p[sure & (ha[p] | hb[q])], q[sure & (ha[p] | hb[q])]
                for own, ids, at, their in ((ha, ia, p, nb[q]), (hb, ib, q, na[p])):
                    number = np.bincount(at, weights=their, minlength=len(ids))
                    got = np.flatnonzero((number > 0) & own)
                    found.append(pd.DataFrame({"rep": ids[got], "n": number[got].astype(np.int64), "other": ids[got]}))
                # a spanning forest of these pairs keeps what they connect
                tree = forest(ia[p], ib[q])
                found.append(pd.DataFrame({"rep": np.array(tree[0], ia.dtype), "n": 0, "other": np.array(tree[1], ia.dtype)}))
        return pd.concat(found)

    out = cut(sent.groupBy("cell", "i", "j").applyInPandas(join, f"rep {kinds['rep']}, n long, other {kinds['rep']}"))
    return out.where("n > 0").groupBy("rep").agg(F.sum("n").alias("n")), out.where("n = 0").select(F.col("rep").alias("a"), F.col("other").alias("b"))


def close(a: np.ndarray, b: np.ndarray, cosine: float) -> bool:
    import math

    return math.fsum((a * b).tolist()) / math.sqrt(math.fsum((a * a).tolist()) * math.fsum((b * b).tolist())) >= cosine


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs, by union-find."""
    parent: dict[int, int] = {}
    out_a, out_b = [], []

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            out_a.append(x)
            out_b.append(y)
    return out_a, out_b


def near_duplicates(table: DataFrame, *, cosine: float = 0.9, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of table (vec_id, embedding).

    Equal vectors are joined as one, with their number. A vector that cannot link (null, zero, with a null or
    non-finite component) has no link and is its own component. Vectors of different lengths never link. Repeated
    rows of one vec_id come out once each; links count other rows. A null vec_id has no link and a null component.
    Other columns are left out, whatever their names; an empty table gives none.
    """
    good = usable(table.where(F.col("vec_id").isNotNull()))
    same = good.groupBy("x").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    same = cut(same.select("rep", "copies", "x"))
    number = good.count()
    links, edges = range_links(same, cosine, block)
    linked = components(edges)
    per = same.join(links, "rep", "left").join(linked.withColumnRenamed("id", "rep"), "rep", "left")
    per = per.select("x", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    own = join_hot(good, per, "x", "copies", number).select("vec_id", "n_links", "component_id")
    bad = table.where(F.col("vec_id").isNull() | ~fine_vector()).select("vec_id")
    rows = own.unionByName(bad.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
