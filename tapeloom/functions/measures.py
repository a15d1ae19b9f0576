"""Measures derived from a price and its change in percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the price classes, and the default bounds between them.
LABELS = ("Low", "Medium", "High")
LOW, HIGH = 2000, 5000


def total_return(price: Column, percentage_change: Column) -> Column:
    return price * (F.lit(1) + percentage_change / F.lit(100))


def earning_per_share(returned: Column, price: Column) -> Column:
    return returned - price


def guarded_ratio(numerator: Column, divisor: Column) -> Column:
    """NULL where the divisor is 0 or NULL."""
    return F.when(divisor != 0, numerator / divisor)


def category(
    value: Column,
    low: float = LOW,
    high: float = HIGH,
    labels: tuple[str, str, str] = LABELS,
    null_label: str | None = None,
) -> Column:
    """Below ``low``, between both bounds inclusive, or neither.

    NULL compares with nothing, so it gets the last label unless ``null_label`` names another.
    """
    below, between, otherwise = labels
    classes = F.when(value < low, below).when(value.between(low, high), between)
    if null_label is not None:
        classes = classes.when(value.isNull(), null_label)
    return classes.otherwise(otherwise)
