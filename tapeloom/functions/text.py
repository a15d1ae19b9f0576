"""Numbers held as text. What does not parse becomes NULL; ``quality_report`` counts it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each cleaning step removes.
NOT_DIGIT_OR_DOT = "[^0-9.]+"
NOT_DIGIT_DOT_OR_MINUS = "[^0-9.-]+"
PERCENT = "%"
RUPEE = "₹"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without(c: Column, part: str) -> Column:
    return F.replace(c.cast("string"), F.lit(part), F.lit(""))


def clean_price(c: Column | str, signed: bool = False) -> Column:
    """Keep digits and dots, as float. A minus sign is lost unless ``signed``."""
    unwanted = NOT_DIGIT_DOT_OR_MINUS if signed else NOT_DIGIT_OR_DOT
    return F.regexp_replace(_column(c), unwanted, "").try_cast("float")


def clean_percent(c: Column | str) -> Column:
    """``-1.5%`` as the double -1.5."""
    return _without(_column(c), PERCENT).try_cast("double")


def strip_rupee(c: Column | str) -> Column:
    """Remove only the rupee sign, as float. Thousands commas are left and so give NULL."""
    return _without(_column(c), RUPEE).try_cast("float")


def to_float(c: Column | str) -> Column:
    """The text as it is, as float."""
    return _column(c).try_cast("float")
