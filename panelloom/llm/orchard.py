"""Centroid clustering on whole numbers with Orchard's nearest-centroid search.

Every centroid holds a list of the others, nearest first. A vector starts at some centroid and walks its list; whenever a
centroid nearer to the vector turns up, the walk goes on in that one's list. Centroids met before are marked and not measured
again. By the triangle inequality nothing nearer follows once the list is *strictly* beyond twice the present distance, so
centroids at exactly the same distance are still met and the smaller number wins. All comparisons are between squared integers,
so there is no rounding.

A round is one pass over the vectors: each task walks its Arrow batches in numpy and hands over one row per cluster (count and
componentwise sums). The next centroids and their lists, ``k`` by ``dim`` and ``k`` by ``k`` numbers whatever the table's size, go out with the
next round's tasks. Centroids that did not move end the rounds early, as more of them change nothing.

Defined results: a row takes part if its vector has exactly ``dim`` components, all finite; others are left out, as are NULL
vectors. Rows with one id are vectors of their own; a NULL id counts as empty text in the choice of the first centroids and
ties there fall to the smaller vector. With fewer than ``k`` vectors there are as many centroids; an empty table gives no rows.
Components beyond +-2**27 after scaling raise an error, as their distances would not fit a long. Columns other than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.frames import bounded_batches, scratch, stored

SCALE, LIMIT = 256, 1 << 27


class Centroids(NamedTuple):
    """``lists[c]`` names the other centroids by distance from ``c`` and ``apart[c]`` holds those squared distances."""

    points: np.ndarray
    lists: np.ndarray
    apart: np.ndarray


def prepare(points: np.ndarray) -> Centroids:
    points = np.asarray(points, np.int64)
    between = np.stack([((points - p) ** 2).sum(1) for p in points])
    np.fill_diagonal(between, -1)
    order = np.argsort(between, axis=1, kind="stable")[:, 1:]
    return Centroids(points, order, np.take_along_axis(between, order, 1))


def nearest(vectors: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; all walks of the batch advance together."""
    n, k = len(vectors), len(c.points)
    at = np.zeros(n, np.int64)
    best = ((vectors - c.points[0]) ** 2).sum(1)
    met = np.zeros((n, k), bool)
    met[:, 0] = True
    place = np.zeros(n, np.int64)
    walking = np.arange(n) if k > 1 else np.zeros(0, np.int64)
    while len(walking):
        here = at[walking]
        going = c.apart[here, place[walking]] <= 4 * best[walking]
        walking, here = walking[going], here[going]
        other = c.lists[here, place[walking]]
        place[walking] += 1
        fresh = np.flatnonzero(~met[walking, other])
        rows, tried = walking[fresh], other[fresh]
        met[rows, tried] = True
        far = ((vectors[rows] - c.points[tried]) ** 2).sum(1)
        closer = (far < best[rows]) | ((far == best[rows]) & (tried < at[rows]))
        rows, tried = rows[closer], tried[closer]
        best[rows], at[rows], place[rows] = far[closer], tried, 0
        walking = walking[place[walking] < k - 1]
    return at, best


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """``id, point`` of the vectors that take part, components scaled and rounded down."""
    x = F.col("v")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf")))
    scaled: Column = F.transform(x, lambda e: F.floor(F.lit(float(SCALE)) * e))
    fits = F.forall(x, lambda e: F.abs(F.lit(float(SCALE)) * e) <= F.lit(float(LIMIT)))
    return (
        table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.coalesce((F.size(x) == dim) & F.forall(x, finite), F.lit(False)))
        .select("id", F.when(fits, scaled.cast("array<int>")).otherwise(F.raise_error(F.lit("vector component out of range"))).alias("point"))
    )


def _first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "point").orderBy("key", "point").limit(k).collect()
    return np.array([r.point for r in rows], np.int64)


def _sums(vectors: DataFrame, c: Centroids) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of each non-empty cluster."""
    k, dim = c.points.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            points = _matrix(batch.column(0), dim)
            at, _ = nearest(points, c)
            count += np.bincount(at, minlength=k)
            order = np.argsort(at, kind="stable")
            held, begins = np.unique(at[order], return_index=True)
            if len(held):
                total[held] += np.add.reduceat(points[order], begins)
        some = np.flatnonzero(count)
        if len(some):
            flat = pa.array(total[some].ravel(), pa.int64())
            sums = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * dim, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), sums], ["cluster", "n", "sums"])

    per_task = vectors.select("point").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    wide = per_task.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dim)))
    return {r.cluster: (r.n, [r[f"s{i}"] for i in range(dim)]) for r in wide.collect()}  # at most k rows


def _assigned(vectors: DataFrame, c: Centroids) -> DataFrame:
    dim = c.points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, far = nearest(_matrix(batch.column(1), dim), c)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32)), pa.array(far)], ["id", "cluster", "distance"])

    return vectors.select("id", "point").mapInArrow(run, "id bigint, cluster int, distance bigint")


def cluster(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, k: int = 40, rounds: int = 5, seed: str = "2:"
) -> DataFrame:
    """Per vector: ``id, cluster, distance, cluster_inertia, inertia, centroid`` (the final centroid's components)."""
    spark = table.sparkSession
    bounded_batches(spark)
    with scratch(spark):
        vectors = stored(whole_vectors(table, id_col, vector_col, dim), "orchard-points")
        first = _first_centroids(vectors, k, seed)
        if not len(first):
            return spark.createDataFrame([], f"`{id_col}` bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
        centroids = prepare(first)
        for _ in range(rounds):
            points = centroids.points.copy()
            for number, (n, sums) in _sums(vectors, centroids).items():
                points[number] = [s // n for s in sums]
            if np.array_equal(points, centroids.points):
                break
            centroids = prepare(points)
        assigned = stored(_assigned(vectors, centroids), "orchard-assigned", keep=True)
    inertia = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # at most k rows
    about = spark.createDataFrame(
        [(c, t, sum(inertia.values()), [int(x) for x in centroids.points[c]]) for c, t in inertia.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>",
    )
    # One row per centroid, k at most: safe to send whole.
    return assigned.join(F.broadcast(about), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
