"""Projections: all narrow, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.times import formatted

# Fixed value: what a masked column shows.
MASK = "********"


def in_order(df: DataFrame, steps: Iterable[tuple[str, Column] | Mapping[str, Column]]) -> DataFrame:
    """Set columns one after the other; a later step sees the result of an earlier one.

    A mapping is one step that sets several columns which do not need each other.
    """

    def step(current: DataFrame, change) -> DataFrame:
        if isinstance(change, Mapping):
            return current.withColumns(dict(change))
        name, value = change
        return current.withColumn(name, value)

    return reduce(step, steps, df)


def name_case(df: DataFrame, case: str = "upper") -> DataFrame:
    """Column names to upper or lower case; any other value of ``case`` leaves them alone."""
    change = {"upper": str.upper, "lower": str.lower}.get(case.lower())
    if change is None:
        return df
    names = [change(name) for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"names that become equal: {', '.join(repeated)}")
    return df.toDF(*names)


def mask(df: DataFrame, columns: Iterable[str], value: str = MASK) -> DataFrame:
    """Replace whole columns, NULLs too, by a constant text."""
    columns = list(columns)
    known = {name.lower() for name in df.columns}
    unknown = [name for name in columns if name.lower() not in known]
    if unknown:
        raise ValueError(f"no such column to mask: {', '.join(unknown)}")
    return df.withColumns({name: F.lit(value) for name in columns}) if columns else df


def format_date(df: DataFrame, column: str, pattern: str, name: str = "Date") -> DataFrame:
    """Add the timestamp in ``column`` as formatted text."""
    return df.withColumn(name, formatted(F.col(column), pattern))
