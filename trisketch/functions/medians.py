"""Medians of small, parameter-sized value lists (runs, sketch rows)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _middle(values: Column) -> tuple[Column, Column, Column]:
    ordered = F.sort_array(values)
    n = F.size(values)
    upper = F.get(ordered, F.floor(n / 2).cast("int"))
    lower = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    return n % 2, lower, upper


def truncated_median(values: Column) -> Column:
    """Median of a BIGINT array; an even count gives the mean cut towards zero.

    The mean adds the quotients and remainders of both halves, so the sum of two large
    values cannot overflow.
    """
    odd, lower, upper = _middle(values)
    mean = F.call_function("div", lower.cast("decimal(20,0)") + upper.cast("decimal(20,0)"), F.lit(2))
    return F.when(odd == 1, upper).otherwise(mean)


def truncated_decimal_median(values: Column) -> Column:
    """The same for non-negative DECIMAL(38,0) values such as sums of squares."""
    odd, lower, upper = _middle(values)
    mean = F.floor((lower + upper) / 2).cast("decimal(38,0)")
    return F.when(odd == 1, upper).otherwise(mean)
