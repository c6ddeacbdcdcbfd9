"""Merkle manifest of a dataset: one tree per group of rows, the groups' roots in one more
tree, and for every leaf the siblings that prove it.

A *leaf* is the digest of a row.  In a tree every 8 consecutive nodes of a level (the last
run may be shorter) become the digest of their concatenated digests, until one node is left.

Trees are built by time-forward processing.  Nodes are labelled by level and place, so a
parent's label is greater than its children's; a priority queue ordered by label delivers
the children's digests to their parent.  Leaves are numbered per group (range exchange, counts per range, local
row numbers), and a *block* is a whole subtree of ``8 ** BLOCK_LEVELS`` leaves.  Inside a block
the queue is a heap of one task; from block to block it is Spark's exchange, sorted and
spilled by Spark: a block's root is a message to the block of its parent.  So a round
shrinks all trees by that factor, however large one group is, and a few rounds are enough.

The reversed sweep begins at the root of roots.  The same labels in descending order deliver
to every node its proof suffix, that is, the siblings on the way from its parent to the root.

Leaves ascend by key, null keys first; rows with equal keys ascend by digest.  Groups ascend
bytewise, the null group first.  Nulls, empty and very long values are told apart in a
leaf's digest (``-``, or byte count and value).  A table without rows gives none.  Columns
that are not named are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textops import stored

FANOUT = 8
#: Levels of a block; it has 512 leaves.
BLOCK_LEVELS = 3
_BLOCK = FANOUT ** BLOCK_LEVELS
PROOF = "array<struct<left:string,right:string>>"

Label = tuple[int, int]


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level from the leaf's run to the root."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``order``) and ``total`` in their ``group`` (not null).

    Rows are dealt in ranges and written, as range borders are sampled; ranges are counted,
    so only rows of one range are sorted together.  A range holds rows of a few groups or
    part of a large one.
    """
    dealt = stored(rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [group, *order]])
                   .withColumn("__part", F.spark_partition_id()), "ranges")
    count = dealt.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # a group has a row per range here
    before = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    count = count.select("__g", "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                         F.sum("__n").over(Window.partitionBy("__g")).alias("total"))
    inside = Window.partitionBy(group, "__part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (dealt.join(count, (F.col(group) == F.col("__g")) & (F.col("__part") == F.col("__p")))
            .withColumn("place", F.col("__before") + F.row_number().over(inside) - 1)
            .select(*rows.columns, "place", "total"))


def levels_of(total: int) -> int:
    """Levels above the ``total`` nodes of a tree, in the block they are in."""
    levels = 0
    while total > 1 and levels < BLOCK_LEVELS:
        total, levels = -(-total // FANOUT), levels + 1
    return levels


def ascend(digests: list[str], levels: int) -> dict[Label, list[str]]:
    """The children's digests of every inner node of a block, by label, and the block's
    root under (levels + 1, 0)."""
    queue = [((1, i // FANOUT), i, d) for i, d in enumerate(digests)] if levels else [((1, 0), 0, digests[0])]
    heapq.heapify(queue)
    children: dict[Label, list[str]] = {}
    while queue:
        label = queue[0][0]
        run = []
        while queue and queue[0][0] == label:
            run.append(heapq.heappop(queue)[2])
        children[label] = run
        level, place = label
        if level <= levels:
            heapq.heappush(queue, ((level + 1, place // FANOUT), place, sha256("".join(run).encode()).hexdigest()))
    return children


def descend(children: dict[Label, list[str]], levels: int, suffix: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """Proofs of a block's leaves in order, given the proof of its root."""
    queue = [(-levels, 0, suffix)]
    proofs = []
    while queue:
        level, place, above = heapq.heappop(queue)
        if level == 0:
            proofs.append(above)
            continue
        run = children[-level, -place]
        for i in range(len(run)):
            step = "".join(run[:i]), "".join(run[i + 1:])
            child = FANOUT * -place + i
            # leaves come out by place, inner nodes by descending label
            heapq.heappush(queue, (level + 1, child if level == -1 else -child, [step, *above]))
    return proofs


def _up(table: pa.Table) -> pa.Table:
    table = table.sort_by("place")
    total = table.column("total")[0].as_py()
    levels = levels_of(total)
    top = ascend(table.column("digest").to_pylist(), levels)[levels + 1, 0]
    return pa.table({"g": table.column("g").slice(0, 1), "place": pa.array([table.column("place")[0].as_py() // _BLOCK], pa.int64()),
                     "total": pa.array([-(-total // _BLOCK)], pa.int64()), "digest": pa.array(top, pa.string())})


def _down(nodes: pa.Table, above: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("place")
    levels = levels_of(nodes.column("total")[0].as_py())
    suffix = [(s["left"], s["right"]) for s in above.column("proof")[0].as_py()]
    proofs = descend(ascend(nodes.column("digest").to_pylist(), levels), levels, suffix)
    steps = [s for p in proofs for s in p]
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum([len(p) for p in proofs]))), pa.int32()),
        pa.StructArray.from_arrays([pa.array([s[k] for s in steps], pa.string()) for k in (0, 1)], names=["left", "right"]))
    out = nodes.append_column("proof", lists)
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.array([above.column(name)[0].as_py()] * nodes.num_rows, pa.string()))
    return out


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """``g, place, total, digest`` of the leaves, of their blocks, and so on up to one node a tree."""
    rounds, largest = [nodes], nodes.agg(F.max("total")).first()[0] or 0
    while largest > 1 or len(rounds) == 1:
        up = rounds[-1].select("g", "place", "total", "digest").groupBy("g", F.expr(f"place div {_BLOCK}")).applyInArrow(
            _up, "g string, place long, total long, digest string")
        rounds.append(stored(up, "nodes"))
        largest = -(-largest // _BLOCK)
    return rounds


def _proofs(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``tops`` (``g, place, proof, subroot, root`` of every tree's root) brought down to the leaves."""
    for nodes in reversed(rounds[:-1]):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + f", proof {PROOF}, subroot string, root string"
        tops = (nodes.groupBy("g", F.expr(f"place div {_BLOCK}")).cogroup(
            tops.select("g", "place", "proof", "subroot", "root").groupBy("g", "place")).applyInArrow(_down, schema))
    return tops


def manifest(leaves: DataFrame, group: str, key: str, leaf: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, leaf``, the columns ``keep``, ``proof`` (sibling digests left and right of the
    path, from the leaf's run up to the root), ``subroot`` of the group and ``root`` for every
    row of ``leaves``."""
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    # a group's name sorts as asked for: the null group is the empty name
    rows = stored(leaves.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
                                F.col(key).alias("key"), F.col(leaf).alias("digest"), *kept), "leaves")
    trees = _rounds(stored(numbered(rows, "g", ["key", "digest"]), "places"))
    subroots = trees[-1].select(F.lit("").alias("g"), F.col("g").alias("key"), "digest")
    top = _rounds(stored(numbered(subroots, "g", ["key"]), "places"))
    root = top[-1].select("g", "place", F.array().cast(PROOF).alias("proof"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    tops = _proofs(top, root).select(F.col("key").alias("g"), F.lit(0).cast("long").alias("place"), "proof",
                                     F.col("digest").alias("subroot"), "root")
    return _proofs(trees, tops).select(F.col("key").alias(key), F.col("digest").alias(leaf),
                                       *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "proof", "subroot", "root")
