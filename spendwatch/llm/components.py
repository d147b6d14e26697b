"""Connected components of an edge table, named by their smallest node."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendwatch.llm.common import stored

# Edges that one task contracts at a time; it never changes a result.
CHUNK = 200_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges that is not the smallest of its component, and that smallest node."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = np.arange(len(names))
    one, two = ends[:len(a)], ends[len(a):]
    while True:
        # Each root takes the least root it meets; then every node points to its root.
        left, right = low[one], low[two]
        new = low.copy()
        np.minimum.at(new, left, right)
        np.minimum.at(new, right, left)
        while True:
            further = new[new]
            if np.array_equal(further, new):
                break
            new = further
        if np.array_equal(new, low):
            break
        low = new
    child = np.flatnonzero(low != np.arange(len(names)))
    return names[child], names[low[child]]


def _contracted(edges: DataFrame, rows: int) -> DataFrame:
    """The edges of each chunk as stars around their smallest nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def stars() -> pa.RecordBatch:
            a, b = (np.concatenate([np.asarray(x.column(c)) for x in held]) for c in "ab")
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in forest(a, b)], ["a", "b"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield stars()
                held, n = [], 0
        if n:
            yield stars()

    # Narrow, and by the counted rows: a task gets about a chunk.
    return edges.select("a", "b").coalesce(max(1, -(-rows // CHUNK))).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the edges (a, b) that differ; both long, the smallest node names a component.

    Chunks of edges are contracted to stars inside the tasks. While there is more than one chunk, a large star (nodes take
    the least node around their larger neighbours) and a small star (around their smaller ones) follow, until every
    node has one edge, to a node that has none. Each round writes one table.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
                   .distinct(), "edges")
    while True:
        rows = edges.count()
        few = _contracted(edges, rows)
        if rows <= CHUNK:
            edges = stored(few, "edges")
            break
        few = few.distinct()
        both = few.unionByName(few.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .where("a != b").distinct())
        joined = large.join(large.groupBy("a").agg(F.min("b").alias("low")), "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            joined.select("a", F.col("low").alias("b"))).where("a != b").distinct()
        edges = stored(small, "edges")
        ends = edges.groupBy("a").agg(F.count("*").alias("n"))
        open_ends = edges.select(F.col("b").alias("a")).distinct().join(ends, "a", "left_semi").select("a").unionByName(
            ends.where("n > 1").select("a"))
        if open_ends.isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
