"""The steps every pipeline starts with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import clean_percent, clean_price, earning_per_share, formatted, guarded_ratio, total_return
from tapeloom.functions.times import DATE, MONTH
from tapeloom.operators.columns import in_order

# The measures a cleaned trade has, in table order.
MEASURES = ["Price", "percentage_change", "return", "earning_per_share", "earning_ratio"]
CALENDAR = ["Day", "Date", "Month", "Time"]


def with_calendar(df: DataFrame, time: Column) -> DataFrame:
    """Day of month, date text and short month name of a timestamp, or of text that reads as one."""
    moment = time.try_cast("timestamp")
    return df.withColumns(
        {"Day": F.dayofmonth(moment), "Date": formatted(moment, DATE), "Month": formatted(moment, MONTH)}
    )


def with_numbers(df: DataFrame) -> DataFrame:
    """Clean the two text numbers."""
    return df.withColumns(
        {"Price": clean_price("Price"), "percentage_change": clean_percent("percentage_change")}
    )


def with_derived(df: DataFrame) -> DataFrame:
    """Return, earning per share and their ratio from the two numbers."""
    price, change, returned, earned = (F.col(name) for name in MEASURES[:4])
    return in_order(
        df,
        [
            ("return", total_return(price, change)),
            ("earning_per_share", earning_per_share(returned, price)),
            ("earning_ratio", guarded_ratio(returned, earned)),
        ],
    )


def with_measures(df: DataFrame) -> DataFrame:
    """All five measures from the two text numbers."""
    return with_derived(with_numbers(df))
