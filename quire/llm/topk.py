"""Exact top-k by inner product: columnar branch-and-bound in vertical layout.

Rows are dealt into chunks, and every block of queries meets every chunk once (a stated query set against all
rows). In a chunk vectors lie dimension block by dimension block; a query accumulates its scores block by block
and, after each, keeps only the candidates whose score so far plus the remaining-mass bound |q_rest| |x_rest| can
still reach its k-th best lower bound. Where there are several chunks, one of them is searched first: a query's k-th
score there is a floor that it takes along to all chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut

DIMENSIONS = 16
#: Rows and queries of a tile at most, and rows of a chunk at least where a chunk for each core would be smaller.
CHUNK, QUERIES, LEAST = 65536, 16384, 4096
#: Whole numbers below it are exact in doubles.
EXACT = 2.0**53


def chunk_top(queries: np.ndarray, own: np.ndarray, floors: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, numbers: np.ndarray, k: int, step: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best rows of one chunk (query index, row index, score); vectors are integers held as doubles.

    Ties go to the smaller id; the row whose number is the query's own is left out, and rows that can't reach its floor may be.
    """
    by_id = np.lexsort((numbers, row_ids))
    rows, numbers = rows[by_id], numbers[by_id]
    dims = rows.shape[1]
    edges = list(range(0, dims, step)) + [dims]
    blocks = [np.ascontiguousarray(rows[:, a:b].T) for a, b in zip(edges, edges[1:], strict=False)]
    mass = np.stack([np.sqrt((rows[:, b:] ** 2).sum(axis=1)) for b in edges[1:]])
    out_q, out_r, out_s = [], [], []
    for i in range(len(queries)):
        q = queries[i]
        alive = np.flatnonzero(numbers != own[i])
        score = np.zeros(len(alive))
        for j, block in enumerate(blocks):
            part = block if len(alive) == len(rows) else block[:, alive]
            score = score + q[edges[j] : edges[j + 1]] @ part
            if j + 1 < len(blocks) and len(alive) > k:
                bound = np.sqrt((q[edges[j + 1] :] ** 2).sum()) * mass[j][alive] * (1 + 1e-9) + 1e-6
                floor = max(floors[i], np.partition(score - bound, len(alive) - k)[len(alive) - k])
                keep = score + bound >= floor
                if not keep.all():
                    alive, score = alive[keep], score[keep]
        best = np.lexsort((alive, -score))[:k]
        out_q.append(np.full(len(best), i))
        out_r.append(by_id[alive[best]])
        out_s.append(score[best])
    if not out_q:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def large_top(queries: np.ndarray, own: np.ndarray, floors: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, numbers: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """chunk_top for components whose scores doubles can't hold: Python's whole numbers, score by score."""
    whole = lambda table: np.array([[int(x) for x in row] for row in table], object)
    rows = whole(rows)
    out = []
    for i, q in enumerate(whole(queries)):
        scores = (rows * q).sum(axis=1)
        best = sorted((r for r in range(len(rows)) if numbers[r] != own[i]), key=lambda r: (-scores[r], row_ids[r]))[:k]
        out += [(i, r, scores[r]) for r in best]
    return np.array([i for i, _, _ in out], np.int64), np.array([r for _, r, _ in out], np.int64), np.array([s for _, _, s in out], object)


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v) with v = floor(256 x) per component as doubles.

    Left out: vectors that are null or empty or hold a null or non-finite component, and rows without a vec_id.
    """
    whole = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    scaled = lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)  # a larger double is whole
    return table.where(F.coalesce(whole, F.lit(False))).select("vec_id", F.transform("embedding", lambda x: scaled(x.cast("double") * 256)).alias("v"))


def tiles(queries: DataFrame, rows: DataFrame, chunks: int, blocks: int, k: int) -> DataFrame:
    """(query, query_id, vec_id, score): the k best rows of each chunk for each of queries (vec_id, v, n, number, floor)."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("number"), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("n").alias("q_n"), F.col("number").alias("query"), "floor")
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query", F.lit(1)), F.lit(blocks)).cast("int"))
    sent = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for dims, own in right.groupby("n"):
            asking = left[left["q_n"] == dims]
            if not len(asking):
                continue
            x, ids = np.stack(own["v"].to_numpy()), own["vec_id"].to_numpy()
            names, asked = asking["query_id"].to_numpy(), asking["query"].to_numpy()
            asked_of = np.stack(asking["q"].to_numpy())
            small = dims * np.abs(x).max() * np.abs(asked_of).max() < EXACT
            q, r, s = (chunk_top if small else large_top)(asked_of, asked, asking["floor"].to_numpy(), x, ids, own["number"].to_numpy(), k)
            found.append(pd.DataFrame({"query": asked[q], "query_id": names[q], "vec_id": ids[r], "score": np.array(s.tolist(), np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query", "query_id", "vec_id", "score")})

    # a task holds one block of queries and one chunk of rows
    return sent.groupBy("chunk", "block").cogroup(rows.groupBy("chunk", "block")).applyInPandas(search, "query long, query_id long, vec_id long, score long")


def top_k(table: DataFrame, *, k: int = 5, query_every: int = 50, chunk: int = CHUNK, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row whose vec_id is divisible by query_every.

    Rows without a vec_id and empty vectors take no part. Every other row is a candidate but for the query's own: rows that
    repeat a vec_id are candidates each, and queries each, so that their query_id and ranks come as often. Scores are exact:
    where doubles can't hold a chunk's, whole numbers of any size count, far more slowly; a score among the k best that no
    long holds fails the job. Equal scores go by the smaller vec_id. Vectors of different lengths never meet. Other columns
    are left out, whatever their names. An empty table gives no row.
    """
    data = cut(vectors(table).withColumns({"n": F.size("v"), "number": F.monotonically_increasing_id()}))
    n = data.count()
    cores = data.sparkSession.sparkContext.defaultParallelism
    chunks = max(1, -(-n // chunk), min(cores, -(-n // min(chunk, LEAST))))
    asked = data.where(F.col("vec_id") % query_every == 0)
    blocks = max(1, -(-asked.count() // block))
    queries = asked.withColumn("floor", F.lit(float("-inf")))
    if chunks > 1:
        first = tiles(queries, data.where(F.pmod(F.xxhash64("number"), F.lit(chunks)) == 0), 1, blocks, k)
        floors = first.groupBy("query").agg(F.min("score").cast("double").alias("floor"), F.count(F.lit(1)).alias("found")).where(F.col("found") == k)
        queries = asked.join(floors.select(F.col("query").alias("number"), "floor"), "number", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    best = tiles(queries, data, chunks, blocks, k)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
