"""The supplied tables, and trades made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.plans.trades import with_numbers
from tapeloom.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Make each table named a temporary view of its own name."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def trades_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of raw trades: prices and changes as decorated text."""
    orders, customer, nation = (table(spark, sf_dir, name) for name in ("orders", "customer", "nation"))
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    placed = placed.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return placed.select(
        F.col("o_orderkey").alias("trade_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Time"),
        F.col("n_name").alias("Company"),
        F.col("o_orderpriority").alias("Exchange"),
        F.concat(F.lit("₹"), F.format_number("o_totalprice", 2)).alias("Price"),
        F.concat((F.col("o_orderkey") % 21 - 10).cast("string"), F.lit("%")).alias("percentage_change"),
    )


def trades_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with the two text numbers cleaned."""
    return with_numbers(trades_raw(spark, sf_dir))


def trades_rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' balances in the shape of raw trades, with all that text can hold: signs, commas, exponents, no numbers."""
    customer, nation = (table(spark, sf_dir, name) for name in ("customer", "nation"))
    plain, kind = F.col("c_acctbal").cast("string"), F.col("c_custkey") % 8
    price = (
        F.when(kind == 0, plain)
        .when(kind == 1, F.concat(F.lit("₹"), plain))
        .when(kind == 2, F.concat(F.lit("₹"), F.format_number("c_acctbal", 2)))
        .when(kind == 4, F.lit("n/a"))
        .when(kind == 5, F.lit(""))
        .when(kind == 6, F.concat((F.col("c_custkey") % 100).cast("string"), F.lit("e2")))
        .when(kind == 7, F.concat(F.lit(" "), plain))
    )
    change = F.concat((F.col("c_custkey") % 31 - 15).cast("string"), F.lit(".5%"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("trade_id"),
        F.col("n_name").alias("Company"),
        F.col("c_mktsegment").alias("Exchange"),
        price.alias("Price"),
        F.when(kind == 3, F.lit("x%")).when(kind != 4, change).alias("percentage_change"),
    )
