"""Timestamps and their text forms. Bad text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How raw text writes a moment, and how dates and months are written.
RAW_MOMENT = "yyyy-MM-dd HH:mm:ss"
DATE = "yyyy-MM-dd"
MONTH = "MMM"


def parse_timestamp(c: Column | str, pattern: str = RAW_MOMENT) -> Column:
    """Text to timestamp by a pattern."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c, F.lit(pattern))


def formatted(c: Column | str, pattern: str) -> Column:
    """A timestamp, or text that reads as one, in the given pattern."""
    return F.date_format((F.col(c) if isinstance(c, str) else c).try_cast("timestamp"), pattern)
