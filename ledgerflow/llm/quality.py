"""Quality rules with risk-controlled cutoffs.

``measures`` computes the rules' figures from whole texts.  ``calibrate`` reads
labelled holdout rows and selects, per stratum and rule, a cutoff for which the
share of good rows rejected is shown to be small:

* each rule rejects ``value >= cutoff`` for one of a fixed list of cutoffs,
  from lenient to strict, that does not depend on the data;
* for a cutoff that rejects k of n good holdout rows, the exact binomial tail
  P(Bin(n, alpha / rules) <= k) is the p-value of "it rejects more than its
  share" (equivalent to a Clopper-Pearson upper bound);
* cutoffs of a rule are tested in their order and testing ends with the first
  that fails (fixed sequence: no correction is needed within a rule); over
  strata and rules Bonferroni's correction applies.  So with probability
  1 - delta no stratum loses more than ``alpha`` of its good rows to all
  rules together;
* rules choose one after the other; of the cutoffs that passed, the one with the
  largest gain (bad rows caught less ``price`` times good rows lost, of those
  that earlier rules let pass) is used, the most lenient of equals; a rule
  without gain, or with too few holdout rows to pass, rejects nothing.

Only DataFrame and SQL operations run here.  Null and empty texts have no words
(and fail the base rules); null strata form a stratum of their own; strata
without labels keep what passes the base rules; a row with several labels is
good if any says so; rows with null labels don't count.  Repeated rows are
judged one by one, tables without rows give no rows, other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from math import log, pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .textops import SPACE_PATTERN, stored

SYMBOLS = "[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
#: A table of cutoffs with at most so many strata is broadcast.
BROADCAST_STRATA = 10_000


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the figures of ``MEASURES`` in place of ``text``.

    Repeated 3-word windows are found by sorting (hash, position) pairs inside
    the row, so a text of n words costs n log n and nothing is shuffled.  The
    hashes have 64 bits and are compared within one text only.
    """
    i64 = lambda c: c.cast("long")
    words = docs.withColumn("__text", F.coalesce("text", F.lit(""))).withColumn(
        "__words", F.array_remove(F.split("__text", SPACE_PATTERN), "")).withColumn(
        "__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    w, n = F.col("__words"), F.size("__words")
    windows = words.withColumn("__windows", F.when(n >= 3, F.transform(
        F.slice(w, F.lit(1), n - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))))
    hashes = F.col("__windows")
    pairs = windows.withColumn("__pairs", F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    p = F.col("__pairs")
    places = pairs.withColumn("__at", F.sort_array(F.filter(F.transform(p, lambda x, k: F.when(
        x["h"].eqNullSafe(F.get(p, k - 1)["h"]) | x["h"].eqNullSafe(F.get(p, k + 1)["h"]), x["i"])),
        lambda x: x.isNotNull())))
    at = F.col("__at")
    covered = F.aggregate(F.transform(at, lambda a, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - a, F.lit(3)))),
                          F.lit(0).cast("long"), lambda total, x: total + x)
    return places.withColumns({
        "n_words": i64(n), "word_chars": i64(F.char_length(F.array_join("__words", ""))),
        "n_symbols": i64(F.regexp_count("__text", F.lit(SYMBOLS))), "n_lines": i64(F.size("__lines")),
        "n_dup_lines": i64(F.size("__lines") - F.size(F.array_distinct("__lines"))),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
    }).drop("text", "__text", "__words", "__lines", "__windows", "__pairs", "__at")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: Per rule its cutoffs from lenient to strict.
CUTOFFS = {
    "symbols": [round(4 * 2 ** (-j / 4), 6) for j in range(33)],
    "repeated_words": [round(0.5 - 0.0125 * j, 6) for j in range(33)],
    "repeated_lines": [round(0.9 - 0.025 * j, 6) for j in range(33)],
    "long_words": [round(40 * 2 ** (-j / 10), 6) for j in range(33)],
    "short_words": [round(-1 - 0.1 * j, 6) for j in range(33)],
}


def rules() -> dict[str, tuple[Column, list[float]]]:
    """Name: (value, cutoffs); a rule rejects value >= cutoff."""
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    values = {"symbols": per_word("n_symbols"), "repeated_words": per_word("n_repeat_words"),
              "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
              "long_words": per_word("word_chars"), "short_words": -per_word("word_chars")}
    return {name: (values[name], cutoffs) for name, cutoffs in CUTOFFS.items()}


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 10."""
    y = x + 10
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - 1 / (1680 * y * y * y * y * y * y * y)
    below = F.lit(0.0)
    for i in range(10):
        below = below + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * log(2 * pi) + series - below


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) as P(X = k) times the sum of the falling ratios P(X = k - j) / P(X = k).

    The tail is 1 in double precision beyond 12 standard deviations (and 60)
    above the mean; up to there the ratios are followed as far below the mean.
    """
    k, n = k.cast("double"), n.cast("double")
    wide = F.ceil(12 * F.sqrt(n * p)) + 60
    at_k = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * log(p) + (n - k) * log(1 - p)
    terms = F.least(k, F.greatest(k - n * p, F.lit(0.0)) + wide).cast("int")
    total = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, j: F.struct((s["term"] * (k - j) / (n - k + j + 1) * (1 - p) / p).alias("term"),
                              (s["sum"] + s["term"] * (k - j) / (n - k + j + 1) * (1 - p) / p).alias("sum")),
        lambda s: s["sum"])
    return F.when(k > n * p + wide, 1.0).otherwise(F.least(F.lit(1.0), F.exp(at_k + F.log(total))))


def _passes(value: Column, cutoffs: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in cutoffs]), lambda c: c > value))


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02,
              delta: float = 0.05, price: float = 20.0) -> DataFrame:
    """One row per stratum and rule with a cutoff: ``stratum, rule, cutoff, good, lost, caught, p_value``.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad).
    """
    found = rules()
    label = labels.where("quality is not null").groupBy("doc_id").agg((F.max("quality") >= 1).alias("good"))
    # per rule: how many cutoffs, lenient first, let the row pass
    passes = {f"passes_{name}": _passes(value, cutoffs) for name, (value, cutoffs) in found.items()}
    held = stored(measured.where(~base_failed()).withColumns(passes).join(label, "doc_id")
                  .select(F.col(stratum).alias("stratum"), "good", *passes), "holdout")
    level = delta / (max(held.select("stratum").distinct().count(), 1) * len(found))
    chosen, caught = [], F.lit(False)
    for name, (_, cutoffs) in found.items():
        own = F.col(f"passes_{name}")
        count = lambda what: F.sum(F.when(what, 1).otherwise(0))
        cells = held.groupBy("stratum", own.alias("passes")).agg(
            count(F.col("good")).alias("good"), count(F.col("good") & ~caught).alias("new_good"),
            count(~F.col("good") & ~caught).alias("new_bad"))
        # from here on: strata x cutoffs rows
        sums = lambda field: F.aggregate("mine", F.lit(0).cast("long"), lambda t, x: t + x[field])
        steps = (cells.groupBy("stratum").agg(F.sum("good").alias("n"), F.collect_list(F.struct("passes", "good", "new_good", "new_bad")).alias("cells"))
                 .select("stratum", "n", "cells", F.posexplode(F.array(*[F.lit(c) for c in cutoffs])).alias("step", "cutoff"))
                 .withColumn("mine", F.filter("cells", lambda x: x["passes"] <= F.col("step")))
                 .withColumn("lost", sums("good"))
                 .withColumn("p_value", binomial_tail(F.col("lost"), F.col("n"), alpha / len(found)))
                 .withColumn("failed", F.max(F.when(F.col("p_value") > level, 1).otherwise(0)).over(
                     Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)))
                 .withColumn("caught", sums("new_bad")).withColumn("gain", F.col("caught") - price * sums("new_good")))
        best = stored(steps.where("failed = 0 and gain > 0").groupBy("stratum").agg(F.max(F.struct(
            F.col("gain"), (-F.col("step")).alias("lenient"), "cutoff", F.col("n").alias("good"), "lost", "caught", "p_value")).alias("b"))
            .select("stratum", F.lit(name).alias("rule"), "b.cutoff", "b.good", "b.lost", "b.caught", "b.p_value",
                    (-F.col("b.lenient")).alias("step")), "cutoffs")
        chosen.append(best.drop("step"))
        mine = best.select(F.col("stratum").alias("s"), F.col("step").alias(f"step_{name}"))
        held = held.join(mine, F.col("stratum").eqNullSafe(F.col("s")), "left").drop("s")
        caught = caught | F.coalesce(own <= F.col(f"step_{name}"), F.lit(False))
    return reduce(DataFrame.unionByName, chosen)


def apply_cutoffs(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``base_failed``, ``failed_rules`` and ``kept``."""
    table = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("__cut"))
    if table.count() <= BROADCAST_STRATA:
        table = F.broadcast(table)
    joined = measured.join(table, measured[stratum].eqNullSafe(table["stratum"]), "left").drop("stratum")
    failed = F.filter(F.array(*[F.when(value >= F.try_element_at(F.col("__cut"), F.lit(name)), F.lit(name))
                                for name, (value, _) in rules().items()]), lambda x: x.isNotNull())
    return (joined.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed).drop("__cut")
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk: float) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (``doc_id``, ``text`` and the stratum's column).

    The measures are written once; calibration and verdict read them there.
    """
    measured = stored(measures(docs.select("doc_id", "text", stratum)), "quality")
    cutoffs = stored(calibrate(measured, labels, stratum, **risk), "cutoffs")
    return apply_cutoffs(measured, cutoffs, stratum)
