"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.session import staged

#: Edges that one task joins by itself.
CHUNK = 500_000


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of a task's edges: every node linked to the least of its own."""
    parts = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches]
    if not parts:
        return
    u, v = (np.concatenate(x) for x in zip(*parts))
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = list(range(len(nodes)))
    for a, b in zip(ends[: len(u)].tolist(), ends[len(u) :].tolist()):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        parent[max(a, b)] = min(a, b)
    root = np.array(parent, np.int64)
    while (root[root] != root).any():
        root = root[root]
    some = np.flatnonzero(root != np.arange(len(root)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[root[some]])], names=["u", "v"])


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to its least neighbour or itself."""
    every = both_ways(edges)
    least = every.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return every.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, label) of every node in ``edges`` (u long, v long): the label is the least
    node of its component.

    Tasks first reduce chunks of edges to forests, which settles a single chunk. Several
    are joined by large and small stars, each round written to the shared folder; rows
    are spread by node, and the least neighbour is found with partial aggregation, so a
    node with very many edges is split by a skew join only."""
    state = staged(edges.where("u <> v"), "edges")
    chunks = -(-state.count() // chunk)
    state = staged(state.coalesce(max(1, chunks)).mapInArrow(forest, "u long, v long"), "edges")
    mark = None
    while chunks > 1:
        row = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == (row.n, row.h):
            break
        mark = (row.n, row.h)
        state = staged(small_star(large_star(state)), "edges")
    return state.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
