"""Exact nearest neighbours in blocks, and labels by their votes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Points and queries that meet in one task at a time.
BLOCK_ROWS = 4096


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def nearest_of(queries: np.ndarray, points: np.ndarray, names: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, name of the point, distance) of each query's k nearest points, itself left out; ties go to the smaller name.

    Products of the matrices find them; what is as near as the k-th, within rounding, is measured again by differences.
    """
    rough = (queries**2).sum(axis=1)[:, None] - 2 * queries @ points.T + (points**2).sum(axis=1)[None, :]
    rough[own[:, None] == names[None, :]] = np.inf
    at = min(k, len(names)) - 1
    limit = np.partition(rough, at, axis=1)[:, at]
    scale = 1e-9 * (1 + (queries**2).sum(axis=1) + (points**2).sum(axis=1).max())
    i, j = np.nonzero(rough <= np.where(np.isfinite(limit), limit + scale, np.finfo(np.float64).max)[:, None])
    d = np.sqrt(((queries[i] - points[j]) ** 2).sum(axis=1))
    order = np.lexsort((names[j], d, i))
    i, j, d = i[order], j[order], d[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    keep = rank < k
    return i[keep], names[j[keep]], d[keep]


def nearest(queries: DataFrame, points: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, rank, neighbour, distance): of each query (id, x) the k nearest of points (id, x) but itself, in Euclid's distance.

    Both are dealt into blocks by a hash, each pair of blocks is one task's work, and the best of all blocks are merged.
    Rows with a null id or vector are left out; all vectors have one length.
    """
    queries, points = (df.select(F.col("id").cast("long").alias("id"), F.col("x").cast("array<double>").alias("x")).dropna() for df in (queries, points))
    n_queries, n_points = (max(1, -(-df.count() // block_rows)) for df in (queries, points))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("qb", block(n_queries)).withColumn("pb", every(n_points))
    held = points.withColumn("pb", block(n_points)).withColumn("qb", every(n_queries))

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        out = ([], [], [])
        if a.num_rows and b.num_rows:
            q, names, own = matrix(a.column("x")), b.column("id").to_numpy(), a.column("id").to_numpy()
            i, found, d = nearest_of(q, matrix(b.column("x")), names, own, k)
            out = (own[i], found, d)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["id", "neighbour", "distance"])

    best = asked.groupBy("qb", "pb").cogroup(held.groupBy("qb", "pb")).applyInArrow(pair, "id long, neighbour long, distance double")
    rank = F.row_number().over(W.partitionBy("id").orderBy("distance", "neighbour"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("id", "rank", "neighbour", "distance")


def voted(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label): the label (id, label) that most of a row's neighbours have; ties go to the smaller."""
    votes = neighbours.join(labels.select(F.col("id").alias("neighbour"), "label"), "neighbour").groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("id").agg(F.min(F.struct(-F.col("n"), F.col("label").alias("label")))["label"].alias("label"))
