"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.session import scratch_path

#: Edges that one step of local contraction holds.
CONTRACT_EDGES = 200_000


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of these edges alone: every node with the smallest of its component, itself left out."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, again := new[new]):
            new = again
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def contract(edges: DataFrame) -> DataFrame:
    """Replace bounded runs of edges by the stars that connect the same nodes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held):
            u, v = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            child, root = _stars(u, v)
            return pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], ["u", "v"])

        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += len(batch)
            if size >= CONTRACT_EDGES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether no node has two parents and no parent is itself a child."""
    parents = edges.select(F.col("v").alias("u"), F.lit(1).alias("p")).distinct()
    bad = (
        edges.groupBy("u")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        .join(parents, "u", "left")
        .where("lo <> hi or p is not null")
    )
    return bad.limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v) but the smallest of each component.

    ``component`` is the smallest node of the component. Loops and edges with
    nulls are ignored; repeated edges and an empty table are fine. Each round
    contracts runs of edges locally, then moves neighbours to smaller nodes
    (large star, small star), so hubs and long chains take few rounds; every
    round is a written table, so lost executors cost that round only.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
    edges = edges.where("u is not null and v is not null and u <> v")
    while True:
        edges = _written(contract(edges).distinct())
        if _is_forest_of_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = down.unionByName(least.select("u", F.col("m").alias("v")))
