"""Raw trades to the silver table.

As defined, every trade meets every company seen on its exchange, and rank and totals then go by that
company. The result has trades times companies rows, so nothing is sorted or summed after that join:

* totals come from one count and sum per company and exchange, taken before the join;
* companies seen on the same set of exchanges meet the same trades, so they share one rank, worked
  out once per set;
* the join to companies is the last step and sends a small table to the trades.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.functions import category
from tapeloom.functions.measures import HIGH, LOW
from tapeloom.operators.columns import MASK, mask, name_case
from tapeloom.operators.joins import BROADCAST_BYTES, join_lookup, join_rows
from tapeloom.operators.skew import GROUP_ROWS, hot_among
from tapeloom.operators.windows import rank_within
from tapeloom.plans.trades import CALENDAR, MEASURES, with_calendar, with_derived, with_numbers

# Fixed value: the most rows an int rank can number.
INT_RANK = 2**31 - 1

# The silver columns in table order, before their names are put in upper case.
COLUMNS = [
    "Exchange",
    *CALENDAR,
    "Stock",
    *MEASURES,
    "Company",
    "Company_Rank",
    "Price_Category",
    "Total_Price",
    "Average_Price",
]

# Fixed value: names and types of the silver table.
SILVER_SCHEMA = """
    EXCHANGE string, DAY int, DATE string, MONTH string, TIME string, STOCK string, PRICE float,
    PERCENTAGE_CHANGE double, RETURN double, EARNING_PER_SHARE double, EARNING_RATIO string, COMPANY string,
    COMPANY_RANK int, PRICE_CATEGORY string, TOTAL_PRICE double, AVERAGE_PRICE double
"""


@dataclass(frozen=True)
class SilverOptions:
    """Bounds of the price classes, and where rows that fit in one task end."""

    low: float = LOW
    high: float = HIGH
    null_label: str | None = None
    mask: str = MASK
    group_rows: int = GROUP_ROWS
    broadcast_bytes: int = BROADCAST_BYTES
    rank_type: str = "int"


def typed_trades(trades: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """The columns all others follow from, with the numbers cleaned."""
    named = trades.withColumn("Stock", F.col("Company"))
    return with_numbers(named).select(*row_key, "Time", "Stock", "Exchange", "Price", "percentage_change")


def enriched(rows: DataFrame, options: SilverOptions) -> DataFrame:
    """Everything that needs the trade alone: derived, rounded, classed and masked."""
    derived = with_derived(with_calendar(rows, F.col("Time")))
    rounded = derived.withColumns({"Price": F.round("Price"), "return": F.round("return")})
    classed = rounded.withColumn(
        "Price_Category", category(F.col("Price"), options.low, options.high, null_label=options.null_label)
    )
    return mask(classed, ["earning_ratio"], options.mask)


def rank_order(rows: DataFrame, row_key: Sequence[str]) -> list[str]:
    """The row key and the stock; without a key every column, so that only rows alike in all are equal."""
    return [*row_key, "Stock"] if row_key else rows.columns


def checked_rank(rank_type: str, largest: int) -> None:
    """Refuse before the run what would overflow at its end."""
    if rank_type == "int" and largest > INT_RANK:
        raise ValueError(f"a group has {largest} rows; use rank_type='bigint'")


def silver(
    trades: DataFrame, row_key: Sequence[str] = ("trade_id",), options: SilverOptions = SilverOptions()
) -> DataFrame:
    """The silver table as defined: trades joined to companies on the exchange alone.

    ``row_key`` is a unique key that orders the rank and is not in the result. Where there is none, pass
    ``()`` and the rank follows the other columns.
    """
    # Counted, sampled for spans and sorted: the source is read and its text cleaned once.
    rows = scratch.keep(typed_trades(trades, row_key), "typed")
    companies, size, largest = scratch.keep_measured(
        companies_by_exchange(rows), "companies", ["Exchange", "_set"], largest="_set_rows"
    )
    limits = {"broadcast_bytes": options.broadcast_bytes, "hot_rows": options.group_rows, "spread_by": list(row_key)}

    sets = companies.select("Exchange", "_set").distinct()
    # Part of the table just measured, one row per key.
    sets_size = replace(size, rows=size.keys) if size.bytes <= options.broadcast_bytes else None
    in_sets = join_lookup(rows, sets, "Exchange", "inner", null_safe=True, size=sets_size, **limits)
    checked_rank(options.rank_type, largest)
    hot, stored = None, False
    if largest > options.group_rows:
        hot = hot_among(companies, ["_set"], "_set_rows", options.group_rows)
        stored = hot is not None and hot.keys == companies.select("_set").distinct().count()

    def ranked(some: DataFrame) -> DataFrame:
        order = rank_order(rows, row_key)
        return rank_within(some, "_set", order, "Company_Rank", options.group_rows, hot, options.rank_type, looked=True)

    # Enriched late, fewer columns are sorted; but rows that come stored are enriched in store, so that
    # the work is not done again for each row a trade is multiplied to.
    full = ranked(enriched(in_sets, options)) if stored else enriched(ranked(in_sets), options)
    companies, limits["spread_by"] = companies.drop("_set_rows"), list(row_key) or ["Company_Rank"]
    joined = join_lookup(
        full, companies, ["Exchange", "_set"], "inner", null_safe=True, size=size, dealt=stored, **limits
    )
    return name_case(joined.select(*COLUMNS))


def companies_by_exchange(rows: DataFrame) -> DataFrame:
    """What a trade on an exchange meets: each company, its totals, and its set of exchanges.

    One row per exchange and company, with a NULL company for an exchange that meets none. ``_set`` is
    a digest of the set, 128 bits, and ``_set_rows`` the number of trades it meets.
    """
    counts = rows.groupBy("Stock", "Exchange").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.round("Price")).alias("_sum"), F.count("Price").alias("_priced")
    )
    counts = scratch.keep(counts, "counts")
    per_exchange = counts.groupBy("Exchange").agg(*[F.sum(name).alias(name) for name in ("_rows", "_sum", "_priced")])
    seen = counts.where(F.col("Exchange").isNotNull()).select(F.col("Stock").alias("Company"), "Exchange")
    met = per_exchange.join(seen, "Exchange", "left")

    # A digest of the set that needs no array: rows are distinct here, so sums and a count tell sets apart.
    code = F.md5(F.to_json(F.struct(F.col("Exchange").isNull().alias("none"), "Exchange")))
    halves = [F.conv(F.substring(code, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 17)]
    members = F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(half).alias(f"h{i}") for i, half in enumerate(halves)])
    per_company = met.groupBy("Company").agg(
        F.sum("_sum").alias("Total_Price"),
        (F.sum("_sum") / F.nullif(F.sum("_priced"), F.lit(0))).alias("Average_Price"),
        F.sum("_rows").alias("_set_rows"),
        F.substring(F.unhex(F.sha2(F.to_json(members), 256)), 1, 16).alias("_set"),
    )
    named = per_company.withColumnRenamed("Company", "_company")
    return (
        met.select("Exchange", "Company")
        .join(named, F.col("Company").eqNullSafe(F.col("_company")))
        .select("Exchange", "Company", "_set", "_set_rows", "Total_Price", "Average_Price")
    )


def silver_by_company(
    trades: DataFrame, row_key: Sequence[str] = ("trade_id",), options: SilverOptions = SilverOptions()
) -> DataFrame:
    """The silver table with each trade joined to its own company's totals, so no row is multiplied.

    That join finds exactly one match where company and exchange are known and none elsewhere, so it
    comes down to a condition. A trade without a match has a NULL company, as in any left join.
    """
    rows = scratch.keep(typed_trades(trades, row_key), "typed")
    matched = rows.withColumn("Company", F.when(F.col("Exchange").isNotNull(), F.col("Stock")))
    price = F.round("Price")
    per_company = matched.groupBy("Company").agg(
        F.sum(price).alias("Total_Price"), F.avg(price).alias("Average_Price"), F.count(F.lit(1)).alias("_rows")
    )
    per_company, size, largest = scratch.keep_measured(per_company, "companies", ["Company"], largest="_rows")
    checked_rank(options.rank_type, largest)
    hot = hot_among(per_company, ["Company"], "_rows", options.group_rows) if largest > options.group_rows else None
    ranked = rank_within(
        matched, "Company", rank_order(rows, row_key), "Company_Rank", options.group_rows, hot, options.rank_type, looked=True
    )
    joined = join_lookup(
        enriched(ranked, options),
        per_company.drop("_rows"),
        "Company",
        "inner",
        null_safe=True,
        spread_by=list(row_key) or ["Company_Rank"],
        size=size,
        broadcast_bytes=options.broadcast_bytes,
        hot_rows=options.group_rows,
        unique=True,
    )
    return name_case(joined.select(*COLUMNS))


def silver_rows(trades: DataFrame) -> int:
    """How many rows ``silver`` will put out, from counts per exchange."""
    seen = trades.select(F.col("Company").alias("seen"), "Exchange").where(F.col("Exchange").isNotNull()).distinct()
    return join_rows(trades.select("Exchange"), seen, "Exchange")
