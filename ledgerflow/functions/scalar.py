"""Column helpers shared by the views (all built-in expressions, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def root(c, n: int) -> Column:
    """First ``n`` characters of an account number (LEFT(cg_num, n))."""
    return F.substring(col(c), 1, n)


def debit_positive(amount, sens) -> Column:
    """+amount for a debit (sens 0), -amount for any other code."""
    return F.when(col(sens) == 0, col(amount)).otherwise(-col(amount))


def credit_positive(amount, sens) -> Column:
    """+amount for a credit (sens 1), -amount for any other code."""
    return F.when(col(sens) == 1, col(amount)).otherwise(-col(amount))


def only_if(cond: Column, value: Column, zero=0) -> Column:
    """value where cond holds, else zero (CASE WHEN .. ELSE 0 END)."""
    return F.when(cond, value).otherwise(F.lit(zero))


def as_double(c) -> Column:
    return col(c).cast("double")


def ratio(num, den) -> Column:
    """num / den in double, NULL when den is 0 or NULL."""
    d = as_double(den)
    return F.when(d != 0, as_double(num) / d)


def is_blank(c) -> Column:
    """LTRIM(RTRIM(ISNULL(x, ''))) = ''."""
    return F.trim(F.coalesce(col(c), F.lit(""))) == ""


def us_week(d) -> Column:
    """DATEPART(WEEK, d) with US settings: week 1 holds 1 January, weeks start Sunday."""
    d = col(d)
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1).cast("int")


def age_days(d, as_of: str) -> Column:
    """DATEDIFF(DAY, d, as_of)."""
    return F.datediff(F.lit(as_of).cast("date"), col(d))


def in_age_band(age: Column, lo: int, hi: int | None) -> Column:
    return (age > lo) if hi is None else age.between(lo, hi)


def flag(cond: Column) -> Column:
    """1/0 integer flag; NULL condition counts as 0."""
    return F.when(cond, 1).otherwise(0)
