"""Centroid clustering (Lloyd's rounds) in whole numbers, each vector's nearest centroid found by an annulus search.

Centroids are sorted by norm. The exact distance u from a vector to a centroid of about its own norm bounds the distance
to its nearest from above; by the triangle inequality the nearest, and every one as near, has a norm within u of the
vector's. Those are found by binary search and compared exactly; the least number wins a tie. Centroids are a parameter's
worth of rows; the vectors stay where they are and only each task's sums per centroid leave it. No state is kept per
vector between rounds, so a lost executor costs its tasks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import cut, fresh_path

#: Of components under this, squares of differences of up to 128 components sum up to less than 2^63.
SMALL = 1 << 27
LONGEST = (1 << 63) - 1
#: Norms are rounded: the annulus is wider by this share of the norms.
SLACK = 1e-9


def scaled(table: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, v) of the vectors with exactly dims components, none null or non-finite; v has floor(scale x component)."""
    finite = F.forall("embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return table.where(F.coalesce((F.size("embedding") == dims) & finite, F.lit(False))).select("vec_id", whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors of the least sha256 of salt and id, in that order; repeated ids by their components, null ids last."""
    mark: Column = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    return [list(r["v"]) for r in vectors.select("v", mark.alias("mark")).orderBy(F.col("mark").asc_nulls_last(), "v").limit(k).collect()]


def matrix(rows: list[list[int]] | np.ndarray, dims: int) -> np.ndarray:
    """rows as 64-bit numbers where no distance overflows, else as Python's own."""
    x = np.array(rows, dtype=object).reshape(-1, dims) if isinstance(rows, list) else rows
    if x.dtype == object and not (len(x) and max(abs(int(x.max())), abs(int(x.min()))) >= SMALL):
        return x.astype(np.int64)
    return x


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(axis=1)


def norms(x: np.ndarray) -> np.ndarray:
    f = x.astype(np.float64)
    return np.sqrt((f * f).sum(axis=1))


class Annulus:
    """Centroids sorted by norm, and the nearest of them to each of a batch of vectors."""

    def __init__(self, centroids: list[list[int]], dims: int) -> None:
        c = matrix(centroids, dims)
        norm = norms(c)
        self.number = np.argsort(norm, kind="stable")
        self.c, self.norm = c[self.number], norm[self.number]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, its squared distance, number of distances computed) for the rows of x."""
        c = self.c
        if x.dtype == object or c.dtype == object or len(x) and max(-int(x.min()), int(x.max())) >= SMALL:
            x, c = x.astype(object), c.astype(object)
        norm, k = norms(x), len(c)
        right = np.clip(np.searchsorted(self.norm, norm), 0, k - 1)
        left = np.maximum(right - 1, 0)
        anchor = np.where(norm - self.norm[left] <= self.norm[right] - norm, left, right)
        best, place = squared(x, c[anchor]), anchor
        number = self.number[place]
        reach = np.sqrt(best.astype(np.float64))
        reach = reach + SLACK * (norm + self.norm[-1] + 1)
        low, high = np.searchsorted(self.norm, norm - reach, "left"), np.searchsorted(self.norm, norm + reach, "right")
        compared = len(x)
        for j in range(k):
            rows = np.flatnonzero((low <= j) & (j < high) & (anchor != j))
            if not len(rows):
                continue
            compared += len(rows)
            d = squared(x[rows], c[j])
            nearer = (d < best[rows]) | (d == best[rows]) & (self.number[j] < number[rows])
            best[rows[nearer]] = d[nearer]
            number[rows[nearer]] = self.number[j]
        return number, best, compared


def batches_of(vectors: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in vectors:
        if batch.num_rows:
            yield batch, batch.column("v").flatten().to_numpy().reshape(-1, dims)


def sums(vectors: DataFrame, centroids: list[list[int]], dims: int) -> list[tuple[int, int, list[int]]]:
    """(centroid, its number of vectors, their sums by component), of non-empty centroids; each task sends one row per centroid and component."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Annulus(centroids, dims)
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), object)
        for _, x in batches_of(batches, dims):
            number, _, _ = near.nearest(x)
            count += np.bincount(number, minlength=len(centroids))
            for j in np.unique(number).tolist():
                own = x[number == j]
                small = max(-int(own.min()), int(own.max())) < SMALL
                total[j] += (own if small else own.astype(object)).sum(axis=0).astype(object)
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(used)), pa.int32()), pa.array(np.repeat(count[used], dims)), pa.array([Decimal(int(t)) for t in total[used].ravel()], pa.decimal128(38, 0))],
                ["cluster", "dim", "n", "total"],
            )

    parts = vectors.select("v").mapInArrow(add, "cluster int, dim int, n long, total decimal(38,0)")
    rows = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # a parameter's worth
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["dim"]] = int(r["total"])
    return [(j, n, t) for j, (n, t) in sorted(out.items())]


def assigned(vectors: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector; a squared distance over a long is the largest long."""
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Annulus(centroids, dims)
        for batch, x in batches_of(batches, dims):
            number, best, _ = near.nearest(x)
            if best.dtype == object:
                best = np.minimum(best, LONGEST)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best.astype(np.int64))], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(place, f"vec_id {id_type}, cluster int, distance long")


def cluster(table: DataFrame, *, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3:") -> DataFrame:
    """Each vector of table (vec_id, embedding) with its cluster after `rounds` rounds and a last assignment.

    Columns: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256. Vectors null, of another
    length or with a null or non-finite component take no part. Repeated rows are vectors of their own; of a distance
    to two centroids the smaller number counts; an empty centroid stays where it is. Fewer than k vectors make that many
    centroids, an empty table gives none. Components beyond a long are the largest long, and so are distances and sums of
    distances. Further columns are left out, whatever their names.
    """
    path = fresh_path(table.sparkSession, "vectors")
    scaled(table, dims, scale).write.parquet(path)  # read once a round
    vectors = table.sparkSession.read.parquet(path)
    centroids = first_centroids(vectors, k, salt)
    for _ in range(rounds if centroids else 0):
        for j, n, total in sums(vectors, centroids, dims):
            centroids[j] = [t // n for t in total]
    placed = cut(assigned(vectors, centroids, dims))
    found = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()  # a row per centroid
    inertia = {r["cluster"]: int(r["inertia"]) for r in found}
    total = min(sum(inertia.values()), LONGEST)
    marks = [(j, min(x, LONGEST), total, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for j, x in sorted(inertia.items())]
    facts = table.sparkSession.createDataFrame(marks, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3:") -> str:
    """The same by brute force: every vector against every centroid in every round."""
    rows = f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{salt}' || vec_id), v) - 1 AS INT) AS cluster, v AS c FROM v QUALIFY cluster < {k})"""
    nearest = """
a{r} AS MATERIALIZED (SELECT vec_id, v, min(d).cluster AS cluster, min(d).distance AS distance
      FROM (SELECT vec_id, v, cluster, {{'distance': CAST(list_sum(list_transform(range(1, {n}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT), 'cluster': cluster}} AS d FROM v CROSS JOIN c{r}) GROUP BY vec_id, v)"""
    moved = """
s{s} AS (SELECT cluster, i, sum(x) AS total, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, {n})) AS i FROM a{r}) GROUP BY cluster, i),
m{s} AS (SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{s} GROUP BY cluster),
c{s} AS MATERIALIZED (SELECT cluster, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{s} m USING (cluster))"""
    for r in range(rounds):
        rows += "," + nearest.format(r=r, n=dims + 1) + "," + moved.format(r=r, s=r + 1, n=dims + 1)
    rows += "," + nearest.format(r=rounds, n=dims + 1)
    return f"""{rows}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (cluster)"""
