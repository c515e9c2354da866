"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens import config as fixed

# Wide enough for any money value with up to eight decimals. Exact sums make totals
# independent of the order in which tasks finish or are retried.
MONEY = "decimal(28,8)"


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def median_of_sorted(values: Column) -> Column:
    """Exact median of a short sorted array (NULL when empty)."""
    count = F.size(values)
    low = F.try_element_at(values, F.floor((count + 1) / 2).cast("int"))
    high = F.try_element_at(values, F.floor(count / 2).cast("int") + 1)
    return F.when(count > 0, (low + high) / F.lit(2.0))


def population_spread(values: Column) -> Column:
    """Population standard deviation of a short array (NULL when empty)."""
    count = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x) / count
    squares = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(count > 0, F.sqrt(squares / count))


def order_momentum(orders_90d: Column, orders_365d: Column) -> Column:
    return orders_90d / F.greatest(orders_365d / F.lit(4.0), F.lit(0.25))


def cadence_progress(recency_days: Column, typical_gap: Column) -> Column:
    return recency_days / F.greatest(typical_gap, F.lit(fixed.MIN_CADENCE_DAYS))


def lifecycle_segment(
    tenure_days: Column,
    orders_lifetime: Column,
    orders_90d: Column,
    recency_days: Column,
    typical_gap: Column,
) -> Column:
    return (
        F.when((tenure_days <= 150) & (orders_lifetime <= 4), "New")
        .when(recency_days > F.greatest(F.lit(60.0), F.lit(1.5) * typical_gap), "At Risk")
        .when(orders_90d >= 3, "Loyal")
        .otherwise("Growing")
    )


def cadence_readiness(progress: Column, momentum: Column) -> Column:
    """Logistic curve over purchase-cycle progress, nudged by momentum."""
    nudge = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), momentum - 1.0))
    linear = F.lit(2.1) * (progress - 0.75) + F.lit(0.25) * nudge
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))


def probability_literals(values: list[float]) -> Column:
    return F.array(*[F.lit(float(value)) for value in values])


def class_position(label: Column, classes: list[str] | tuple[str, ...]) -> Column:
    """1-based position of ``label`` in the class list, NULL when it is not a class."""
    position = F.array_position(F.array(*[F.lit(name) for name in classes]), label)
    return F.when(position > 0, position.cast("int"))
