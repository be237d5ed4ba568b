"""Money arithmetic whose result does not depend on how rows are partitioned.

A mean of doubles changes in its last digits with the order of addition. Here every amount is a decimal
with six places, the sums are exact, and the mean is rounded once, at the end, so it is the same on 8
cores and on 8,000. NaN, infinity and amounts of 1e22 and more are no such decimals: a mean that
they are part of is NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(28,6)"


def round_money(amount: Column) -> Column:
    """Two decimals, halves away from zero; what holds no cents stays as it is."""
    return F.coalesce(F.round(amount.try_cast(_EXACT), 2).cast("double"), amount)


def money_sums(amount: Column, prefix: str = "pay") -> list[Column]:
    """Aggregates that ``mean_money`` needs. All of them add up, so partial sums can be merged."""
    exact = amount.try_cast(_EXACT)
    return [
        F.sum(exact).alias(f"{prefix}_sum"),
        F.count(exact).alias(f"{prefix}_n"),
        F.count_if(amount.isNotNull() & exact.isNull()).alias(f"{prefix}_odd"),
    ]


def mean_money(prefix: str = "pay") -> Column:
    """Mean in two decimals, halves away from zero, from the columns of ``money_sums``; null for no
    amounts. In whole millionths, since a decimal quotient would be rounded twice."""
    n = f"cast(nullif({prefix}_n, 0) AS decimal(20,0))"
    above = f"(2 * cast(abs({prefix}_sum) * 1000000 AS decimal(38,0)) + 10000 * {n})"
    below = f"(20000 * {n})"
    cents = F.expr(f"cast(({above} - {above} % {below}) / {below} AS double)")
    mean = F.when(F.col(f"{prefix}_sum") < 0, -cents).otherwise(cents) / F.lit(100.0)
    return F.when(F.col(f"{prefix}_odd") > 0, F.lit(float("nan"))).otherwise(mean)


def share(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals; null if there is nothing to share."""
    return F.floor(F.try_divide(part * F.lit(10000.0), whole) + F.lit(0.5)) / F.lit(100.0)


def format_money(amount: Column) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(amount, 2))
