"""Small numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0.0 for a zero denominator."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    )


def sigmoid(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def round_half_even(value: Column, digits: int = 6) -> Column:
    return F.bround(value, digits)


def share_percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.bround(100.0 * safe_divide(part, whole), digits)
