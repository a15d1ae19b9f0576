"""Grouped sums. Spark sums within each task first, so a hot key shuffles one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tapeloom.functions.text import strip_rupee


def sum_by(df: DataFrame, keys: str | Sequence[str], value: str, alias: str = "total") -> DataFrame:
    """Sum of one column per group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def ceil_sum(
    df: DataFrame, keys: str | Sequence[str], value: str, alias: str = "total", clean: bool = True
) -> DataFrame:
    """Round every value up as a float, then sum per group, as bigint.

    Of text the rupee sign and thousands commas are removed first; sign and exponent count. With
    ``clean=False`` only the rupee sign is, so text with commas counts as NULL. What is no number is NULL.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    amount = F.col(value)
    if isinstance(df.select(value).schema[0].dataType, StringType):
        amount = strip_rupee(F.replace(amount, F.lit(","), F.lit("")) if clean else amount)
    whole = F.ceil(amount.try_cast("float")).cast("bigint")
    return df.groupBy(*keys).agg(F.sum(whole).alias(alias))
