"""Connected components by alternating stars, edges contracted inside tasks first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import stored

#: Edges that one task joins at a time (16 bytes each, some hundred MB of arrays at most).
CONTRACTED = 1_000_000


def least_of_components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, and the least node of each one's component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            return nodes, nodes[root]
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        # the larger root hangs on the smaller one, then all paths are made short
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def _contract(edges: DataFrame, with_roots: bool) -> DataFrame:
    """Per task ``u, v``: stars of its edges' components, the least node in the middle (with
    ``with_roots`` also that node itself).  More than ``CONTRACTED`` edges go in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def star() -> tuple[np.ndarray, np.ndarray]:
            node, root = least_of_components(*(np.concatenate(x) for x in zip(*held)))
            keep = slice(None) if with_roots else node != root
            return node[keep], root[keep]

        rows = lambda u, v: pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v")))
            size += batch.num_rows
            if size >= CONTRACTED and not with_roots:
                held = [star()]
                size = len(held[0][0])
                if 2 * size >= CONTRACTED:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*star())

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with m: the least v of u (combined before the shuffle, joined back).

    The join is on ~u, so that it doesn't reuse the aggregate's exchange and a
    node with very many edges can be split at run time.
    """
    least = pairs.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select(F.bitwise_not("k").alias("k"), "m")
    return pairs.join(least, F.bitwise_not("u") == F.col("k")).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected edges (u, v); root is the
    component's least node.

    Every task first joins its own edges: what is left of them are stars, at most one edge a node.
    As long as more than ``CONTRACTED`` edges are left, each round links every larger neighbour,
    then every smaller one, to the least node known; rounds grow with the logarithm of a
    component's diameter.  Every round is a written table, so its lineage is short and a lost
    executor repeats one round at most.  That many edges or fewer are joined by one task.
    Self-loops are ignored.
    """
    once = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    # a task has all edges from a node to smaller ones, so a star's leaves are in one task each
    now = stored(_contract(once.repartition("u"), with_roots=False), "edges")
    if now.count() <= CONTRACTED:
        return stored(_contract(now.repartition(1), with_roots=True), "components").select(F.col("u").alias("node"), F.col("v").alias("root"))
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_least_neighbour(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct())
        small = _least_neighbour(large)
        now = stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                     .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == sums:
            break
        seen = sums
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
