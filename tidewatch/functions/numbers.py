"""Rounding and safe arithmetic."""

from pyspark.sql import Column, functions as F


def rounded(col: Column, digits: int) -> Column:
    """Round half to even on the binary value, as numeric array libraries do."""
    return F.rint(col * F.lit(10.0**digits)) / F.lit(10.0**digits)


def ratio(num: Column, den: Column) -> Column:
    """``num / den``; null for a zero denominator instead of an error."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def total(col: Column) -> Column:
    """Sum of doubles; callers round the result, never the addends."""
    return F.sum(col)


def mean(col: Column) -> Column:
    return ratio(total(col), F.count(col))


def clip01(col: Column) -> Column:
    return F.least(F.greatest(col, F.lit(0.0)), F.lit(1.0))


def flag(cond: Column) -> Column:
    """1.0 where the condition holds, else 0.0; an unknown condition counts as not held."""
    return F.coalesce(cond, F.lit(False)).cast("double")


def flag_int(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))
