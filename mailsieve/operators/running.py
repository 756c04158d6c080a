"""Running totals in value order without one task that sees every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Number of value ranges is two to this power.
RANGE_BITS = 10


def _range_of(value: Column, bounds: Column) -> Column:
    """How many of the sorted bounds are not above the value, by binary search."""
    steps = F.array(*(F.lit(1 << bit) for bit in reversed(range(RANGE_BITS))))
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(F.get(bounds, low + step - 1) <= value, low + step).otherwise(low),
    )
    # Never null, and declared so: otherwise a null check on the whole search is
    # pushed down to the rows the values were made from.
    return F.coalesce(found, F.lit(0))


def totals_before(frame: DataFrame, order_col: str, totals: Sequence[str]) -> DataFrame:
    """Add ``<name>_before``: the sum of ``name`` over all rows with a lower value.

    ``frame`` has one row per value. The values are cut into ranges of about equal
    size, whose totals are few enough to be added up on their own; the rows of one
    range are then added up apart from all others. The cuts come from approximate
    quantiles: they decide how even the ranges are, never the result.
    """
    n_ranges = 1 << RANGE_BITS
    shares = [i / n_ranges for i in range(1, n_ranges)]
    bounds = frame.agg(F.percentile_approx(order_col, shares).alias("bounds"))
    ranged = (
        frame.withColumn("_bounds", bounds.scalar())
        .withColumn("_range", _range_of(F.col(order_col), F.col("_bounds")))
        .drop("_bounds")
    )
    by_range = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(*(F.sum(name).alias(f"_{name}") for name in totals))
        .select(
            "_range",
            *(F.coalesce(F.sum(f"_{n}").over(by_range), F.lit(0)).alias(f"_{n}") for n in totals),
        )
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.join(F.broadcast(offsets), "_range")  # at most 1,024 rows
        .withColumns(
            {
                f"{name}_before": F.col(f"_{name}")
                + F.coalesce(F.sum(name).over(inside), F.lit(0))
                for name in totals
            }
        )
        .drop("_range", *(f"_{name}" for name in totals))
    )
