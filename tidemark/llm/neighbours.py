"""Approximate nearest neighbours by counting collisions of query-centred windows.

Every projection has one sorted array. A query's windows stand around its own
projections and widen together (virtual rehashing: nothing is hashed again).
A vector that lies in the windows of enough projections is verified with its
exact distance; a query is done when its k-th best distance is within the
radius that the windows stand for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Projections, and the share of them in which a vector must collide.
PROJECTIONS = 64
SHARE = 0.55
#: Half a window in units of the radius. A vector at the radius is in one window with probability 0.683.
HALF_WIDTH = 1.0
#: Growth of the radius from round to round.
GROWTH = 1.2
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
SEED = 42


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class SortedProjections:
    """A block of vectors with one sorted array per projection."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.base = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        projected = vectors @ self.base
        self.order = np.ascontiguousarray(projected.argsort(0, kind="stable").T)
        self.sorted = np.ascontiguousarray(np.take_along_axis(projected.T, self.order, 1))
        some = vectors[:: max(1, len(vectors) // 64)]
        spread = np.sqrt(((some[:, None] - some[None, :]) ** 2).sum(-1))
        self.first = max(float(spread.max()) / 8, 1e-12)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and distances of the k nearest found, nearest first, ties to the smaller id."""
        need, radius, m = int(np.ceil(SHARE * PROJECTIONS)), self.first, PROJECTIONS
        at = query @ self.base
        counts = np.zeros(len(self.ids), np.int64)
        lo = np.array([np.searchsorted(self.sorted[j], at[j]) for j in range(m)])
        hi = lo.copy()
        verified = self.ids == own
        rows, dist = np.empty(0, int), np.empty(0)
        while True:
            half = HALF_WIDTH * radius
            new = []
            for j in range(m):
                a = np.searchsorted(self.sorted[j], at[j] - half, "left")
                b = np.searchsorted(self.sorted[j], at[j] + half, "right")
                a, b = min(a, lo[j]), max(b, hi[j])
                new += [self.order[j, a : lo[j]], self.order[j, hi[j] : b]]
                lo[j], hi[j] = a, b
            counts += np.bincount(np.concatenate(new), minlength=len(counts))
            fresh = np.flatnonzero((counts >= need) & ~verified)
            if len(fresh):
                verified[fresh] = True
                found = np.sqrt(((self.vectors[fresh] - query) ** 2).sum(1))
                rows, dist = np.concatenate([rows, fresh]), np.concatenate([dist, found])
                best = np.lexsort((self.ids[rows], dist))[:k]
                rows, dist = rows[best], dist[best]
            if verified.all() or (len(rows) == k and dist[-1] <= radius):
                return rows, dist
            radius *= GROWTH


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k nearest vectors found for each query by Euclidean distance: query_id, rank, vec_id, score.

    Both tables have vec_id and embedding. Each block of vectors, dealt evenly
    whatever the ids, meets each block of queries once. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor do null ids;
    a query's own vec_id is no candidate of its; vectors of another length are
    not compared; ties go to the smaller vec_id; repeated rows count each for
    itself; an empty side gives no rows.
    """
    cast = [F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")]

    def clean(df: DataFrame) -> DataFrame:
        return df.select(*cast).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))

    data, asked = clean(vectors), clean(queries)
    n_data, n_asked = data.count(), asked.count()
    blocks, groups = max(1, -(-n_data // BLOCK_ROWS)), max(1, -(-n_asked // QUERY_ROWS))
    row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    size = F.size("embedding").alias("dims")
    data = data.select("*", size, row.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    asked = asked.select("*", size, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part.alias("part"))

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids = left.column("vec_id").to_numpy()
            index = SortedProjections(_matrix(left.column("embedding")), ids)
            for own, query in zip(right.column("vec_id").to_numpy(), _matrix(right.column("embedding")), strict=True):
                rows, dist = index.search(query, own, k)
                for out, values in zip(found, (np.full(len(rows), own), ids[rows], dist), strict=True):
                    out.append(values)
        arrays = [pa.array(np.concatenate(v) if v else [], t) for v, t in zip(found, schema.types, strict=True)]
        return pa.Table.from_arrays(arrays, schema=schema)

    keys = ["dims", "block", "part"]
    near = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
