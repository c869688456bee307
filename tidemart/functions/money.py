"""Exact money and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"
# Totals are wider than single amounts: a month of a large shop does not fit 16 digits, and an
# overflow would stop the job.
TOTAL = "decimal(26,2)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def or_zero(col: Column) -> Column:
    return F.coalesce(money(col), zero())


def money_sum(col: Column) -> Column:
    return F.sum(col).cast(TOTAL)


def money_sum_if(condition: Column, col: Column) -> Column:
    return F.sum(F.when(condition, col).otherwise(zero())).cast(TOTAL)


def sum_if(condition: Column, col: Column) -> Column:
    return F.sum(F.when(condition, col).otherwise(F.lit(0))).cast("bigint")


def ratio(part: Column, whole: Column) -> Column:
    """Quotient of two counts with two digits, half up; null when `whole` is zero."""
    return money(F.try_divide(part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")))


def mean_floor(total: Column, count: Column, unit: int = 1) -> Column:
    """Mean of whole numbers cut to a whole number; null without rows."""
    whole = F.call_function("div", total, F.nullif(count * F.lit(unit), F.lit(0)))
    return whole.cast("bigint")
