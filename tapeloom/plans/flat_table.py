"""Cleaned trades with running totals among trades of the same price."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import parse_timestamp
from tapeloom.functions.times import DATE
from tapeloom.operators.columns import format_date
from tapeloom.operators.skew import GROUP_ROWS
from tapeloom.operators.windows import running_totals
from tapeloom.plans.trades import CALENDAR, MEASURES, with_calendar, with_derived, with_numbers


def flat(trades: DataFrame, row_key: Sequence[str] = ("trade_id",), group_rows: int = GROUP_ROWS) -> DataFrame:
    """Running total and average of ``Price`` in date order; trades of one day share a value.

    ``Time`` is parsed and ``Company`` named ``Stock``. Only the columns the rest follows from are
    shuffled. ``row_key`` deals out the rows of a hot price and is not in the result.
    """
    moment = parse_timestamp("Time")
    typed = with_numbers(trades.withColumnRenamed("Company", "Stock").withColumn("Time", moment))
    dated = format_date(typed, "Time", DATE)
    totals = running_totals(
        dated.select("Date", "Time", "Stock", "Exchange", "Price", "percentage_change", *row_key),
        "Price",
        "Date",
        "Price",
        total="Total_Price",
        average="Average_Price",
        group_rows=group_rows,
        spread_by=list(row_key),
    )
    derived = with_derived(with_calendar(totals, F.col("Time")))
    return derived.select(*CALENDAR, "Stock", "Exchange", *MEASURES, "Total_Price", "Average_Price")
