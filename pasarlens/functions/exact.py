"""Numeric helpers whose result does not depend on how the data is partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(column: str | Column) -> Column:
    """Amount in fixed point; null if it is not a number, infinite or beyond 34 digits."""
    source = F.col(column) if isinstance(column, str) else column
    return source.try_cast("decimal(38,4)")


def money_sum(column: str | Column) -> Column:
    """Sum that does not depend on the order of addition.

    An amount that fixed point cannot hold shows in the sum: not-a-number makes it not-a-number,
    an infinite or huge one is added as a double.
    """
    source = F.col(column) if isinstance(column, str) else column
    odd = source.isNotNull() & money(source).isNull()
    fixed = F.try_sum(money(source)).cast("double")
    plain = F.sum(source.cast("double"))
    return F.when(F.coalesce(F.bool_or(odd), F.lit(False)), plain).otherwise(F.coalesce(fixed, plain))


def flag(condition: Column) -> Column:
    """0/1 integer; null when the condition is unknown."""
    return condition.cast("int")
