"""Aggregate expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(24,3)"


def money_sum(c: Column) -> Column:
    """Order-independent money total: summed as DECIMAL, returned as double.

    Double sums depend on the order partitions are merged in; a decimal sum
    is exact, so every run (and the SQL oracle) sees the same total.  An
    all-NULL group sums to 0, as in the source system.
    """
    return F.coalesce(F.sum(c.cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def guarded_ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))
