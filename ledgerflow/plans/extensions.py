"""Derived operators labelled as extensions of the reference views:
X1 benford_histogram, X4 trial_balance (X2, X3 live next to their views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_double, only_if
from ..operators.patterns import scalar
from ..oracle.prologue import rnd
from ..registry import register


@register("benford_histogram", f"""
WITH d AS (
    SELECT CAST(regexp_extract(CAST(abs(ec_montant) AS VARCHAR), '[1-9]', 0) AS INTEGER) AS digit
    FROM f_ecriturec WHERE ec_montant <> 0
),
g AS (SELECT digit, COUNT(*) AS n FROM d GROUP BY digit)
SELECT digit, n, CAST(n AS DOUBLE) / (SELECT SUM(n) FROM g) AS share,
    {rnd('log10(1 + 1.0 / digit)', 12)} AS expected,
    CAST(n AS DOUBLE) / (SELECT SUM(n) FROM g) - {rnd('log10(1 + 1.0 / digit)', 12)} AS deviation
FROM g
""")
def benford_histogram(t, as_of: str) -> DataFrame:
    """First significant digit of every non-zero amount against the
    log10(1 + 1/d) expectation (the view only flags amounts below 1)."""
    ec = t.f_ecriturec.filter(F.col("ec_montant") != 0)
    digit = F.regexp_extract(F.abs("ec_montant").cast("string"), "[1-9]", 0).cast("int")
    g = ec.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
    total = scalar(g, F.sum("n"))
    expected = F.round(F.log10(1 + 1.0 / F.col("digit")), 12)
    share = as_double("n") / total
    return g.select("digit", "n", share.alias("share"), expected.alias("expected"),
                    (share - expected).alias("deviation"))


@register("trial_balance", """
SELECT jo_num, ec_piece,
    CAST(SUM(CASE WHEN ec_sens = 0 THEN ec_montant ELSE 0 END) AS DOUBLE) AS total_debit,
    CAST(SUM(CASE WHEN ec_sens = 1 THEN ec_montant ELSE 0 END) AS DOUBLE) AS total_credit,
    CAST(SUM(CASE WHEN ec_sens = 0 THEN ec_montant ELSE 0 END) - SUM(CASE WHEN ec_sens = 1 THEN ec_montant ELSE 0 END)
         AS DOUBLE) AS ecart,
    SUM(CASE WHEN ec_sens = 0 THEN ec_montant ELSE 0 END) = SUM(CASE WHEN ec_sens = 1 THEN ec_montant ELSE 0 END)
        AS equilibre
FROM f_ecriturec GROUP BY jo_num, ec_piece
""")
def trial_balance(t, as_of: str) -> DataFrame:
    """Debit against credit per journal and piece."""
    m, s = F.col("ec_montant"), F.col("ec_sens")
    g = t.f_ecriturec.groupBy("jo_num", "ec_piece").agg(F.sum(only_if(s == 0, m)).alias("d"),
                                                        F.sum(only_if(s == 1, m)).alias("c"))
    return g.select("jo_num", "ec_piece", as_double("d").alias("total_debit"), as_double("c").alias("total_credit"),
                    as_double(F.col("d") - F.col("c")).alias("ecart"), (F.col("d") == F.col("c")).alias("equilibre"))
