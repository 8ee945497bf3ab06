"""Differences of two tables from a small table of sums, whatever the size of the tables.

Every row adds its hash to three cells, the other side's rows take theirs away,
so rows that agree leave nothing. A cell that is left with the copies of one
row tells its hash and number; taking these out of their other cells frees
more (peeling). The table has to be as large as the difference only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.missing import except_all, missing_rows, row_digest

#: Cells of one of the three parts at first, and at most: what comes to the driver is at most 40 bytes for each of three cells.
FIRST_CELLS = 1 << 12
MAX_CELLS = 1 << 18
#: Three cells for a row can be peeled while rows are at most this share of all cells.
LOAD = 0.75

_LOW = 0xFFFFFFFF
_CHECK = 0x7FFFFFFF


def difference_sketch(source: DataFrame, target: DataFrame, cells: int) -> DataFrame:
    """``cell, n, low, high, check``: source minus target; cells without anything left are left out.

    Sums instead of exclusive ors, so that rows that stand several times count.
    Hashes go in halves: the sums of 2**31 rows of a cell fit.
    """

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(row_digest(df)[0].alias("h"), F.lit(sign).cast("bigint").alias("s"))

    rows = side(source, 1).unionByName(side(target.select(*(f"`{c}`" for c in source.columns)), -1))
    rows = rows.withColumn("c", F.xxhash64("h"))
    places = [F.pmod(h, F.lit(cells)) + part * cells for part, h in enumerate((F.col("h"), F.col("c"), F.col("h").bitwiseXOR(F.col("c"))))]
    sign = F.col("s")
    sums = {
        "n": sign,
        "low": sign * F.col("h").bitwiseAND(F.lit(_LOW)),
        "high": sign * F.shiftrightunsigned("h", 32),
        "check": sign * F.col("c").bitwiseAND(F.lit(_CHECK)),
    }
    dealt = rows.select(F.explode(F.array(*places)).alias("cell"), *(v.alias(k) for k, v in sums.items()))
    net = dealt.groupBy("cell").agg(*(F.sum(k).alias(k) for k in sums))
    return net.filter("n <> 0 OR low <> 0 OR high <> 0 OR check <> 0")


def _hash_of_hash(keys: np.ndarray) -> np.ndarray:
    """The 64-bit xxHash of single longs with seed 42, as the engine's function computes it."""
    # The primes of the published algorithm.
    p1, p2, p3, p4, p5 = (
        np.uint64(p)
        for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
    )

    def turn(x: np.ndarray, bits: int) -> np.ndarray:
        return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))

    with np.errstate(over="ignore"):
        h = np.full(len(keys), 42 + 8, np.uint64) + p5
        h ^= turn(keys * p2, 31) * p1
        h = turn(h, 27) * p1 + p4
        h ^= h >> np.uint64(33)
        h *= p2
        h ^= h >> np.uint64(29)
        h *= p3
        return h ^ (h >> np.uint64(32))


def _places(keys: np.ndarray, check: np.ndarray, cells: int) -> np.ndarray:
    return np.stack([h.astype(np.int64) % cells + part * cells for part, h in enumerate((keys, check, keys ^ check))])


def peel(cells: int, cell: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashes and their net counts, or None if the table is too small for the difference."""
    sums = np.zeros((4, 3 * cells), np.int64)
    sums[:, cell] = n, low, high, check
    keys, counts = [], []
    while True:
        at = np.flatnonzero(sums[0])
        part = sums[:, at]
        one = part[1:] // part[0]
        pure = (one * part[0] == part[1:]).all(0) & (one >= 0).all(0) & (one[:2] <= _LOW).all(0) & (one[2] <= _CHECK)
        at, one = at[pure], one[:, pure]
        key = (one[1].astype(np.uint64) << np.uint64(32)) | one[0].astype(np.uint64)
        c = _hash_of_hash(key)
        right = ((c & np.uint64(_CHECK)).astype(np.int64) == one[2]) & (_places(key, c, cells) == at).any(0)
        key, first = np.unique(key[right], return_index=True)
        if not len(key):
            break
        at, c = at[right][first], c[right][first]
        copies = sums[0, at].copy()
        keys.append(key)
        counts.append(copies)
        taken = np.stack([copies, *(copies * v for v in one[:, right][:, first])])
        for places in _places(key, c, cells):
            for field in range(4):
                np.subtract.at(sums[field], places, taken[field])
    if sums.any():
        return None
    none = np.empty(0, np.int64)
    return np.concatenate([none.astype(np.uint64), *keys]).view(np.int64), np.concatenate([none, *counts])


def uneven_hashes(
    source: DataFrame, target: DataFrame, cells: int = FIRST_CELLS, max_cells: int = MAX_CELLS
) -> DataFrame | None:
    """``h, net``: hashes of rows whose counts differ and by how much; None if they are too many for a sketch.

    A table that can't be peeled is made again with twice the cells or as many
    as the counts alone show to be needed; each try costs a scan of both sides
    and no shuffle of rows.
    """
    while cells <= max_cells:
        left = difference_sketch(source, target, cells).toPandas()  # at most 3 * max_cells rows
        columns = [left[name].to_numpy(np.int64) for name in ("cell", "n", "low", "high", "check")]
        found = peel(cells, *columns)
        if found is not None:
            rows = [(int(h), int(net)) for h, net in zip(*found, strict=True)]
            return source.sparkSession.createDataFrame(rows, "h long, net long")
        surely = abs(int(columns[1][columns[0] < cells].sum()))
        cells *= 2
        while cells <= max_cells and 3 * cells * LOAD < surely:
            cells *= 2
    return None


def missing_by_sketch(
    source: DataFrame, target: DataFrame, cells: int = FIRST_CELLS, max_cells: int = MAX_CELLS
) -> DataFrame:
    """Source rows that the target lacks, as a multiset: for large tables that agree on nearly all rows.

    The sketch names the hashes that differ; whole rows are compared for those
    only. Where the difference is too large for it, rows are compared by their
    digests as in :func:`missing_rows`. A row is overlooked only if a row of
    the other side that differs from it has the same 64-bit hash.
    """
    target = target.select(*(f"`{c}`" for c in source.columns))
    hashes = uneven_hashes(source, target, cells, max_cells)
    if hashes is None:
        return missing_rows(source, target, by_digest=True)
    more = F.broadcast(hashes.filter("net > 0").select(F.col("h").alias("_h")))  # at most 3 * max_cells longs

    def suspected(df: DataFrame) -> DataFrame:
        return df.withColumn("_h", row_digest(df)[0]).join(more, "_h", "left_semi").drop("_h")

    return except_all(suspected(source), suspected(target))


def surplus_by_sketch(source: DataFrame, target: DataFrame, **sizes: int) -> DataFrame:
    """Target rows the source no longer has, found the same way."""
    return missing_by_sketch(target.select(*(f"`{c}`" for c in source.columns)), source, **sizes)
