"""Mixing sources to target weights under a token budget.

The corpus is a tree domain - language - source; the weights of a node's
children say how its budget is split.  A child can use no more than its
subtree holds (tokens times ``epochs``); what it cannot use goes to its
siblings by their weights, and only what all of them together cannot use was
already withheld one level up, where the ancestors' siblings got it: at every
node the split is a water level, capacities filled first.

Within a leaf the budget buys whole epochs and then a prefix of one more, each
epoch in its own seeded order, as long as whole documents fit.  The prefix is
found by sums over ranges of the order's key, two levels of 4096 ranges, and
ends in a cut key per leaf; documents are then compared with their leaf's cut
where they lie, so texts are never shuffled and a leaf that holds a third of
all rows is summed in parts.

Only DataFrame and SQL operations run here.  Null names form a leaf of their
own, null and empty texts have no tokens (they come with any prefix they are
ordered into), null identifiers are ordered as the text ``null``; repeated
rows are ordered side by side and taken or left together only if they fit.  Names
without a weight, null among them, each have the weight given under the key
None; without that key it is 0 and they get nothing.  Tables without rows give no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textops import SPACE_PATTERN, stored

LEVELS = ["domain", "lang", "source"]
#: A table of leaves up to this size is broadcast.
BROADCAST_LEAVES = 20_000
_RANGES = 4096
_KEY_BITS = 60


def tokens(text: Column) -> Column:
    """Number of words."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), "")).cast("long")


def epoch_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """The place of a document in an epoch's order: 60 bits of a digest."""
    name = F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, _KEY_BITS // 4), 16, 10).cast("long")


def source_domain(source: Column) -> Column:
    """The domain of a source name: by the number in it, modulo 3 (none: web)."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d+)", 1)
    return F.element_at(F.array(F.lit("web"), F.lit("books"), F.lit("code")),
                        F.when(number == "", 1).otherwise(F.pmod(F.substring(number, -9, 9).cast("int"), F.lit(3)) + 1))


def keyed(docs: DataFrame, domain: Column) -> DataFrame:
    """``r`` (the row of ``docs``), ``doc_id``, ``__domain, __lang, __source`` (never null) and ``__n``."""
    return docs.select(F.struct("*").alias("r"), "doc_id", F.coalesce(domain, F.lit("")).alias("__domain"),
                       F.coalesce("lang", F.lit("")).alias("__lang"), F.coalesce("source", F.lit("")).alias("__source"),
                       tokens(F.col("text")).alias("__n"))


def _weight(weights: Mapping[str | None, float], default: float, name: str) -> Column:
    default = weights.get(None, default)
    named = {k: v for k, v in weights.items() if k is not None}
    if not named:
        return F.lit(float(default))
    table = F.create_map(*[F.lit(x) for k, v in named.items() for x in (k, float(v))])
    return F.coalesce(F.try_element_at(table, F.col(name)), F.lit(float(default)))


def _fill(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Split ``budget`` (of the parent) by ``weight`` among children of capacity ``capacity``: adds ``share``.

    In order of capacity per weight, level i fills child i if the budget
    reaches that far; the first level below its child's ratio is the water level.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parents).orderBy("ratio", child)
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    levels = (children.withColumn("ratio", ratio)
              .withColumn("filled", F.coalesce(F.sum("capacity").over(below), F.lit(0)))
              .withColumn("weights", F.sum("weight").over(rest))
              .withColumn("place", F.row_number().over(order))
              .withColumn("level", F.when(F.col("weights") > 0, (F.col("budget") - F.col("filled")) / F.col("weights"))))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(Window.partitionBy(*parents))
    return (levels.withColumn("water", first["level"])
            .withColumn("share", F.when(F.col("weight") <= 0, F.lit(0.0)).when(F.col("water").isNull(), F.col("capacity").cast("double"))
                        .otherwise(F.least(F.col("capacity").cast("double"), F.col("weight") * F.col("water"))))
            .drop("ratio", "filled", "weights", "place", "level", "water"))


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str | None, float]], budget: Column, epochs: int) -> DataFrame:
    """``leaves`` (``__domain, __lang, __source, supply``) with ``tokens``: the whole tokens a leaf may spend."""
    names = [f"__{x}" for x in LEVELS]
    weight = {n: _weight(weights.get(x, {}), 0 if weights.get(x) else 1, n) for n, x in zip(names, LEVELS)}
    # what lies under a weight of 0 can't be used, at any level
    usable = F.when(F.least(*weight.values()) > 0, F.col("supply") * epochs).otherwise(0)
    found = leaves.withColumn("share", budget.cast("double")).withColumn("usable", usable)
    for depth, name in enumerate(names):
        parents, path = names[:depth], names[:depth + 1]
        children = found.groupBy(*path).agg(F.sum("usable").alias("capacity"), F.first("share").alias("budget"))
        children = children.withColumn("weight", weight[name])
        children = _fill(children, parents, name)
        found = leaves.withColumn("usable", usable).join(children.select(*path, "share"), path)
    return found.withColumn("tokens", F.floor(F.col("share") + F.lit(1e-6)).cast("long")).drop("share", "usable")


def _with_leaf(rows: DataFrame, leaves: DataFrame, name: str) -> DataFrame:
    """``rows`` with the columns of a table of leaves, which is written once and broadcast
    if its checked size allows.  The join is on one key made of the names, so
    that sums by name don't reuse its exchange and a large leaf can be split."""
    names = [f"__{x}" for x in LEVELS]
    leaves = stored(leaves, name)
    key = F.to_json(F.struct(*names))
    named = leaves.select(key.alias("__leaf"), *[c for c in leaves.columns if c not in names])
    small = leaves.count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(named) if small else named, key == F.col("__leaf")).drop("__leaf")


def leaf_cuts(rows: DataFrame, budgets: DataFrame, seed: int) -> DataFrame:
    """Per leaf: ``whole`` epochs, and where the prefix of the next one ends: at the
    document ``end`` (key, doc_id, n), or before the key ``edge``; both null if there is none.

    ``rows`` has ``doc_id``, the leaf's names and ``__n``.
    """
    names = [f"__{x}" for x in LEVELS]
    whole = F.when(F.col("supply") > 0, F.floor(F.col("tokens") / F.col("supply"))).otherwise(0).cast("long")
    wanted = budgets.withColumn("whole", whole).select(
        *names, "whole", (F.col("tokens") - F.col("whole") * F.col("supply")).alias("rest"))
    part = (_with_leaf(rows, wanted.where("rest > 0"), "mix-wanted")
            .withColumn("key", epoch_key(seed, F.col("whole"), F.col("doc_id"))).withColumn("before", F.lit(0).cast("long")))
    for level in (1, 2):
        # tokens per range of keys; the prefix ends in the first range that does not fit whole
        part = part.withColumn("range", F.shiftright("key", _KEY_BITS - 12 * level))
        sums = part.groupBy(*names, "rest", "before", "range").agg(F.sum("__n").alias("n"))
        upto = F.col("before") + F.sum("n").over(Window.partitionBy(*names).orderBy("range"))
        last = stored(sums.withColumn("upto", upto).where("upto > rest").groupBy(*names).agg(
            F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("start"))).alias("last")), "mix-last")
        part = (_with_leaf(part, last, "mix-range").where(F.col("range") == F.col("last.range"))
                .withColumn("before", F.col("last.start")).drop("range", "last"))
    # what is left of a leaf is one 2^24th of its keys; rows that the order doesn't tell apart (null
    # identifiers of one length) are one
    part = part.groupBy(*names, "rest", "before", "key", "doc_id", "__n").agg(F.sum("__n").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*names).orderBy("key", "doc_id", "__n"))
    end = part.withColumn("upto", upto).where("upto <= rest").groupBy(*names).agg(F.max(F.struct("key", "doc_id", "__n")).alias("end"))
    edge = last.select(*names, F.shiftleft(F.col("last.range"), _KEY_BITS - 24).alias("edge"))
    return wanted.select(*names, "whole").join(edge, names, "left").join(end, names, "left")


def mix_sources(docs: DataFrame, weights: Mapping[str, Mapping[str | None, float]], domain: Column, share: float = 0.5,
                epochs: int = 1, seed: int = 1) -> DataFrame:
    """``r`` (the row of ``docs``), ``domain``, ``n_tokens`` and ``copies``: how often a row is in
    a mix of ``share`` times all tokens (0 if it is left out)."""
    names = [f"__{x}" for x in LEVELS]
    table = keyed(docs, domain)
    rows = stored(table.select("doc_id", *names, "__n"), "mix-rows")
    leaves = stored(rows.groupBy(*names).agg(F.sum("__n").alias("supply")), "mix-supply")
    budget = F.floor(leaves.select(F.coalesce(F.sum("supply"), F.lit(0))).scalar() * F.lit(share))
    budgets = stored(leaf_budgets(leaves, weights, budget, epochs), "mix-budgets")
    own = _with_leaf(table, leaf_cuts(rows, budgets, seed), "mix-cuts").withColumn("__key", epoch_key(seed, F.col("whole"), F.col("doc_id")))
    within = F.coalesce(F.struct(F.col("__key").alias("key"), "doc_id", "__n") <= F.col("end"), F.col("__key") < F.col("edge"), F.lit(False))
    return own.select("r", F.col("__domain").alias("domain"), F.col("__n").alias("n_tokens"),
                      (F.col("whole") + F.when(within, 1).otherwise(0)).alias("copies"))
