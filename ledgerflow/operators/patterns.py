"""Scale patterns reused by the views.

Every pattern replaces a window that would otherwise put a whole key (or the
whole table) into one task:

* ``scalar``            - whole-table aggregate as a scalar subquery (no
                          unpartitioned window, no cross join).
* ``distributed_row_number`` - global ROW_NUMBER over a total order via range
                          partitioning, per-partition counts and offsets.
* ``value_rank``        - global rank by a value, planned lazily: counts per
                          order-preserving cell, then a window inside a cell.
* ``forward_range_sum`` - SUM over [d, d+N] days via a RANGE frame on the
                          per-day aggregate.
* ``without_null_skew``  - left join on a key that is often NULL.
* ``whole_rows``         - one shuffle for all readers of an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate of ``df`` usable inside another frame's expressions."""
    return df.select(expr).scalar()


def scalars(df: DataFrame, **exprs: Column) -> dict[str, Column]:
    """Several aggregates of ``df`` computed by ONE scalar subquery (a struct),
    returned as columns by name."""
    s = df.select(F.struct(*[e.alias(k) for k, e in exprs.items()])).scalar()
    return {k: s.getField(k) for k in exprs}


def whole_rows(df: DataFrame) -> DataFrame:
    """``df``, of which every reader takes all columns, whatever it needs of them.

    An aggregate that is read twice for different columns is computed twice, with all
    shuffles below it; asked for the same columns its readers share one exchange.  For
    aggregates that are much smaller than what they are made of."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


#: Characters of a tie-breaker that name its outer and inner cell.
CELL_PREFIXES = (6, 12)


def value_rank(df: DataFrame, value: str, tie: str, name: str) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY value DESC, tie ASC NULLS LAST), without a job
    while the plan is built and without a window over the whole frame.

    Rows fall into steps of the value that keep its order (64 per power of
    two, so their number is bounded by the number format), inside a step into
    cells of one value and the beginning of the tie-breaker, and those into cells of a
    longer beginning.  Steps and cells are counted; only rows of one cell are ordered,
    so a value that very many rows share is not one task's, nor are
    tie-breakers that begin alike.
    """
    v = F.coalesce(F.col(value).cast("double"), F.lit(float("-inf")))
    step = F.floor(F.signum(v) * F.least(F.log2(F.abs(v) + 1), F.lit(1100.0)) * 64).cast("int")
    last = F.lit("\U0010ffff")
    short, long = (F.coalesce(F.substring(tie, 1, n), last) for n in CELL_PREFIXES)
    celled = df.withColumns({"__step": step, "__value": v, "__cell": short, "__inner": long})
    keys = ["__step", "__value", "__cell", "__inner"]
    inner = celled.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    cells = inner.groupBy(*keys[:3]).agg(F.sum("__n").alias("__n"))
    steps = cells.groupBy("__step").agg(F.sum("__n").alias("__n"))
    before = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = steps.select("__step", before(Window.orderBy(F.col("__step").desc())).alias("__above"))
    beside = Window.partitionBy("__step").orderBy(F.col("__value").desc(), "__cell")
    cells = cells.select(*keys[:3], before(beside).alias("__left")).join(steps, "__step")
    inner = inner.select(*keys, before(Window.partitionBy(*keys[:3]).orderBy("__inner")).alias("__first")).join(cells, keys[:3])
    inside = Window.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(tie).asc_nulls_last())
    return (celled.join(inner, keys)
            .withColumn(name, (F.col("__above") + F.col("__left") + F.col("__first") + F.row_number().over(inside)).cast("long"))
            .drop(*keys, "__above", "__left", "__first"))


def without_null_skew(df: DataFrame, other: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join on ``key``; rows whose key is NULL match nothing and are dealt out
    by ``spread`` instead of meeting in one task of a sort-merge join."""
    around = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(spread), F.lit(4096)).cast("string"))
    named = other.withColumnRenamed(key, "__key")
    return df.join(named, F.coalesce(F.col(key), around) == F.col("__key"), "left").drop("__key")


def distributed_row_number(df: DataFrame, order: list[Column], name: str = "row_num",
                           num_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) without a single-partition window.

    ``order`` must be a total order (add a unique tie-breaker).  Rows are
    range-partitioned and sorted; the position inside a partition comes from
    ``monotonically_increasing_id`` (partition index in the upper bits) and
    the per-partition counts (one row per partition, broadcast) give the
    offsets.  The range boundaries are sampled with a seed that depends on
    the RDD id, so two evaluations may cut differently: the ranged rows with
    their ids are therefore checkpointed once (shared checkpoint folder, so
    a lost executor does not change them) and both passes read that copy.
    The input is cached for the two jobs that build it (sampling, write).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cached = df.persist()
    ranged = (cached.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("__mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    cached.unpersist()
    ranged = ranged.withColumn("__pid", F.shiftright(F.col("__mid"), 33)) \
                   .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per partition: a window over it is tiny
    offsets = counts.select(
        "__pid",
        (F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid", "left")
    return out.withColumn(name, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__pos") + 1).cast("long")) \
              .drop("__mid", "__pid", "__pos", "__off")


def forward_range_sums(daily: DataFrame, partition: list[str], day: str, horizons: dict[str, int]) -> DataFrame:
    """On a per-(partition, day) frame, add SUM over days [d, d+N] for each horizon."""
    base = Window.partitionBy(*partition).orderBy(F.unix_date(F.col(day)))
    out = daily
    for name, n in horizons.items():
        out = out.withColumn(name, F.sum("__day_sum").over(base.rangeBetween(0, n)))
    return out
