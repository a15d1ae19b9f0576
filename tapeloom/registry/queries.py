"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType

from tapeloom import scratch
from tapeloom.functions import (
    category,
    clean_percent,
    clean_price,
    earning_per_share,
    formatted,
    guarded_ratio,
    parse_timestamp,
    strip_rupee,
    to_float,
    total_return,
)
from tapeloom.operators import (
    ceil_sum,
    fanout_report,
    format_date,
    in_order,
    join_lookup,
    join_rows,
    mask,
    name_case,
    preview,
    quality_report,
    rank_within,
    row_count,
    running_totals,
    sample_by_key,
    sample_exact,
    schema_violations,
    sum_by,
    totals_over,
)
from tapeloom.plans import Job, SilverOptions, flat, run, silver, silver_by_company
from tapeloom.plans.silver_table import SILVER_SCHEMA
from tapeloom.plans.trades import with_calendar, with_measures
from tapeloom.registry.inputs import register, table, trades_raw, trades_rough, trades_typed
from tapeloom.sinks import dated_path, write_days, write_files, write_judged, write_table
from tapeloom.sources import read_dated, read_table, sql_query, table_exists

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Class bounds that fit the supplied prices, the day of dated writes, the CSV dialect.
BOUNDS = SilverOptions(low=100_000, high=300_000)
RUN_DAY = date(2025, 3, 9)
CSV_OPTIONS = {"header": "true", "delimiter": ","}
TRADE_SCHEMA = StructType(
    [
        StructField("trade_id", LongType()),
        StructField("Time", StringType()),
        StructField("Company", StringType()),
        StructField("Price", DoubleType()),
        StructField("percentage_change", DoubleType()),
        StructField("Currency", StringType()),
    ]
)

NESTED_SCHEMA = StructType(
    [
        StructField("o_orderkey", LongType(), nullable=False),
        StructField(
            "buyer",
            StructType(
                [
                    StructField("key", StringType()),
                    StructField("status", StringType(), nullable=False),
                    StructField("region", StringType()),
                ]
            ),
        ),
        StructField(
            "lines",
            ArrayType(StructType([StructField("number", LongType()), StructField("flag", IntegerType())])),
            nullable=False,
        ),
        StructField("marks", MapType(StringType(), DoubleType(), valueContainsNull=False)),
    ]
)


def query(name: str) -> Callable[[Query], Query]:
    def register_query(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register_query


# Sources


@query("scan_table")
def scan_table(spark, sf_dir):
    register(spark, sf_dir, "orders")
    return read_table(spark, "orders")


@query("scan_filtered")
def scan_filtered(spark, sf_dir):
    register(spark, sf_dir, "lineitem")
    return read_table(spark, "lineitem", "l_quantity > 30")


@query("sql_query")
def sql_query_text(spark, sf_dir):
    return sql_query(
        spark, "select * from {orders} where o_orderstatus = 'F'", orders=table(spark, sf_dir, "orders")
    )


@query("table_exists")
def table_exists_rows(spark, sf_dir):
    """Which of some names can be read, and the rows of those that can."""
    register(spark, sf_dir, "orders", "lineitem")
    lines = []
    for name in ("orders", "lineitem", "no_such_table", "no_such_catalog.no_such_schema.orders"):
        there = table_exists(spark, name)
        rows = row_count(read_table(spark, name)) if there else spark.sql("select cast(null as bigint) as rows")
        lines.append(rows.select(F.lit(name).alias("table_name"), F.lit(there).alias("present"), "rows"))
    return lines[0].union(lines[1]).union(lines[2]).union(lines[3])


@query("scan_dated")
def scan_dated(spark, sf_dir):
    """Orders in a folder for each of seven days, of which three are read."""
    orders, root = table(spark, sf_dir, "orders"), scratch.new_path(spark, "days")
    for i in range(7):
        write_files(orders.where(F.col("o_orderkey") % 7 == i), dated_path(root, RUN_DAY + timedelta(i)))
    wanted = f"run_day between '{RUN_DAY + timedelta(2)}' and '{RUN_DAY + timedelta(4)}'"
    days = read_dated(spark, root, wanted, schema=orders.schema, day_column="run_day")
    return days.withColumn("run_day", F.col("run_day").cast("string"))


# Sinks


def _files_back(spark, df, format, **options):
    path = scratch.new_path(spark, format)
    write_files(df, path, "overwrite", format, options)
    return spark.read.format(format).schema(df.schema).options(**options).load(path)


@query("write_table_roundtrip")
def write_table_roundtrip(spark, sf_dir):
    name = f"tapeloom_orders_{uuid.uuid4().hex}"
    write_table(
        table(spark, sf_dir, "orders"), name, "overwrite", "parquet", {"path": scratch.new_path(spark, "table")}
    )
    back = read_table(spark, name)
    spark.sql(f"drop table {name}")  # the files stay
    return back


@query("write_parquet_roundtrip")
def write_parquet_roundtrip(spark, sf_dir):
    return _files_back(spark, table(spark, sf_dir, "orders"), "parquet")


@query("write_csv_roundtrip")
def write_csv_roundtrip(spark, sf_dir):
    return _files_back(spark, table(spark, sf_dir, "orders"), "csv", **CSV_OPTIONS)


@query("write_json_roundtrip")
def write_json_roundtrip(spark, sf_dir):
    return _files_back(spark, table(spark, sf_dir, "orders"), "json")


@query("write_append_roundtrip")
def write_append_roundtrip(spark, sf_dir):
    customer, path = table(spark, sf_dir, "customer"), scratch.new_path(spark, "append")
    write_files(customer, path, "overwrite")
    write_files(customer, path, "append")
    return spark.read.schema(customer.schema).parquet(path)


@query("write_dated_path")
def write_dated_path(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = dated_path(scratch.new_path(spark, "dated"), RUN_DAY)
    write_files(customer, path, "overwrite", "csv", {"header": "true"})
    back = spark.read.schema(customer.schema).csv(path, header=True)
    folder = F.regexp_extract("_metadata.file_path", r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return back.select("c_custkey", "c_name", folder.alias("run_day"))


@query("observed_write")
def observed_write(spark, sf_dir):
    """Counts taken while the rows were written."""
    orders = table(spark, sf_dir, "orders")
    seen = write_files(
        orders,
        scratch.new_path(spark, "observed"),
        observe={"rows": F.count(F.lit(1)), "large": F.count_if(F.col("o_totalprice") > 300_000)},
    )
    return spark.createDataFrame([(seen["rows"], seen["large"])], "rows bigint, large bigint")


@query("write_day_replaced")
def write_day_replaced(spark, sf_dir):
    """Orders in a table by year, of which two years are written anew, twice."""
    year = F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", year.alias("run_day"))
    name = f"tapeloom_days_{uuid.uuid4().hex}"
    write_days(orders, name, "run_day", options={"path": scratch.new_path(spark, "days")})
    days = [date(1995, 1, 1), date(1996, 1, 1)]
    changed = orders.where(F.col("run_day").isin(days)).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        write_days(changed, name, "run_day", days)
    back = scratch.keep(read_table(spark, name), "days")
    spark.sql(f"drop table {name}")
    return back.withColumn("run_day", F.col("run_day").cast("string"))


def _rough_rules():
    price, change = clean_price("Price", signed=True), clean_percent("percentage_change")
    return {"price is known": price.isNotNull(), "price is positive": price > 0, "change is small": change < 10}


@query("write_judged")
def write_judged_rows(spark, sf_dir):
    """Rows that pass all rules, and the others with the rules they fail, from one write to two folders."""
    trades = trades_rough(spark, sf_dir)
    target, rejects = scratch.new_path(spark, "passed"), scratch.new_path(spark, "rejects")
    write_judged(trades, _rough_rules(), target, rejects=rejects, most_failing={"price is known": 0.5})
    passed = spark.read.schema(trades.schema).parquet(target).withColumn("failed_rules", F.lit("passed"))
    failed = spark.read.schema(trades.schema.add("failed_rules", "string")).parquet(rejects)
    return passed.unionByName(failed)


# Columns


@query("sequential_columns")
def sequential_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return in_order(
        orders,
        [
            ("next_key", F.col("o_orderkey") + 1),
            ("o_custkey", F.col("o_custkey") + F.col("next_key")),
            {"doubled": F.col("o_custkey") * 2, "next_key": F.col("next_key") * 10},
        ],
    )


@query("concat_suffix")
def concat_suffix(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return in_order(customer, [("label", F.concat(F.lit("No. "), "c_custkey", F.lit(" / "), "c_name"))])


@query("select_columns")
def select_columns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")


@query("rename_column")
def rename_column(spark, sf_dir):
    return trades_raw(spark, sf_dir).withColumnRenamed("Company", "Stock")


@query("drop_column")
def drop_column(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("C_ACCTBAL", "no_such_column")


@query("names_upper")
def names_upper(spark, sf_dir):
    return name_case(table(spark, sf_dir, "customer"))


@query("names_lower")
def names_lower(spark, sf_dir):
    return name_case(trades_raw(spark, sf_dir), "Lower")


@query("names_unchanged")
def names_unchanged(spark, sf_dir):
    return name_case(trades_raw(spark, sf_dir), "invalid")


@query("mask_columns")
def mask_columns(spark, sf_dir):
    return mask(table(spark, sf_dir, "customer"), ["c_acctbal", "c_name"])


@query("price_category")
def price_category(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return lines.withColumn("price_category", category(F.col("l_extendedprice"), 2000, 5000))


@query("price_category_flat")
def price_category_flat(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return lines.withColumn("price_category", category(F.round("l_extendedprice", 0), 2000, 3000))


# Dates


@query("format_date")
def date_text(spark, sf_dir):
    return format_date(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "yyyy-MM-dd")


@query("format_date_variants")
def format_date_variants(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        formatted("ts", "yyyy-MM-dd").alias("iso"),
        formatted("ts", "MM/dd/yyyy").alias("month_first"),
        formatted("ts", "dd-MM-yyyy").alias("day_first"),
        formatted("ts", "dd/MM/yyyy").alias("day_first_slashes"),
    )


@query("day_and_month")
def day_and_month(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return with_calendar(events, F.col("ts")).select("event_id", "Day", "Month")


@query("parse_timestamp")
def parse_time(spark, sf_dir):
    trades = trades_raw(spark, sf_dir).select("trade_id", "Time")
    return trades.withColumn("parsed", parse_timestamp("Time").cast("timestamp_ntz"))


# Numbers


@query("clean_price")
def price_number(spark, sf_dir):
    trades = trades_raw(spark, sf_dir)
    return trades.select("trade_id", "Price", clean_price("Price").alias("price_number"))


@query("clean_percent")
def percent_number(spark, sf_dir):
    trades = trades_raw(spark, sf_dir)
    return trades.select("trade_id", clean_percent("percentage_change").alias("percent_number"))


@query("cast_float")
def cast_float(spark, sf_dir):
    """Direct casts: text that is no number gives NULL, and so do thousands commas."""
    trades = trades_rough(spark, sf_dir)
    return trades.select(
        "trade_id",
        to_float("Price").alias("as_it_is"),
        strip_rupee("Price").alias("without_rupee"),
        to_float(F.regexp_replace("percentage_change", "%", "")).alias("without_percent"),
    )


@query("clean_price_signed")
def price_with_sign(spark, sf_dir):
    trades = trades_rough(spark, sf_dir)
    unsigned, signed = clean_price("Price"), clean_price("Price", signed=True)
    classes = category(signed, -100, 5000, null_label="None")
    return trades.select(
        "trade_id", "Price", unsigned.alias("unsigned"), signed.alias("signed"), classes.alias("price_category")
    )


@query("round_columns")
def round_columns(spark, sf_dir):
    trades = with_measures(trades_raw(spark, sf_dir))
    return trades.select("trade_id", F.round("Price").alias("price"), F.round("return").alias("returned"))


@query("derived_return")
def derived_return(spark, sf_dir):
    trades = trades_typed(spark, sf_dir)
    returned = total_return(F.col("Price"), F.col("percentage_change"))
    return trades.select(
        "trade_id", returned.alias("returned"), earning_per_share(returned, F.col("Price")).alias("earned")
    )


@query("earning_ratio")
def earning_ratio(spark, sf_dir):
    trades = with_measures(trades_raw(spark, sf_dir))
    ratio = guarded_ratio(F.col("return"), F.col("earning_per_share"))
    return trades.select("trade_id", ratio.alias("ratio"))


# Groups


@query("ceil_sum")
def ceil_sum_by_company(spark, sf_dir):
    return ceil_sum(trades_raw(spark, sf_dir), ["Company", "Exchange"], "Price", "Total_Price")


@query("ceil_sum_rough")
def ceil_sum_of_rough(spark, sf_dir):
    """Sums over text with signs, commas, exponents and no numbers at all."""
    return ceil_sum(trades_rough(spark, sf_dir), ["Company", "Exchange"], "Price", "Total_Price")


@query("sum_by")
def sum_by_key(spark, sf_dir):
    return sum_by(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")


@query("sum_by_exchange")
def sum_by_exchange(spark, sf_dir):
    return sum_by(trades_typed(spark, sf_dir), "Exchange", "Price", "Total_Price")


# Joins


def _trades_and_totals(spark, sf_dir):
    trades = trades_typed(spark, sf_dir).withColumnRenamed("Company", "Stock")
    totals = ceil_sum(trades_raw(spark, sf_dir), ["Company", "Exchange"], "Price", "Total_Price")
    return trades.select("trade_id", "Stock", "Exchange", "Price"), totals


@query("join_exchange_fanout")
def join_exchange_fanout(spark, sf_dir):
    trades, totals = _trades_and_totals(spark, sf_dir)
    return join_lookup(trades, totals, "Exchange", spread_by=["trade_id"])


@query("join_exchange_fanout_shuffled")
def join_exchange_fanout_shuffled(spark, sf_dir):
    """The same as for a lookup too large to send, with every exchange cut into a grid."""
    trades, totals = _trades_and_totals(spark, sf_dir)
    return join_lookup(trades, totals, "Exchange", spread_by=["trade_id"], broadcast_bytes=0, hot_rows=1000)


@query("join_rows")
def join_rows_foreseen(spark, sf_dir):
    """How many rows two joins will put out, without joining."""
    trades, totals = _trades_and_totals(spark, sf_dir)
    some = totals.where("Exchange != '1-URGENT'")
    rows = [(join_rows(trades, some, "Exchange", how), how) for how in ("left", "inner")]
    return spark.createDataFrame(rows, "rows bigint, how string")


@query("join_exchange_total")
def join_exchange_total(spark, sf_dir):
    trades, _ = _trades_and_totals(spark, sf_dir)
    return join_lookup(trades, sum_by(trades, "Exchange", "Price", "Total_Price"), "Exchange", spread_by=["trade_id"])


@query("join_company_exchange")
def join_company_exchange(spark, sf_dir):
    trades, totals = _trades_and_totals(spark, sf_dir)
    totals = totals.withColumnRenamed("Company", "Stock")
    return join_lookup(trades, totals, ["Stock", "Exchange"], spread_by=["trade_id"])


@query("join_fanout_report")
def join_fanout_report(spark, sf_dir):
    trades, totals = _trades_and_totals(spark, sf_dir)
    return fanout_report(trades, totals, "Exchange")


# Windows


@query("rank_in_company")
def rank_in_company(spark, sf_dir):
    trades = trades_raw(spark, sf_dir).select("trade_id", "Company")
    return rank_within(trades, "Company", "trade_id", "company_rank")


@query("rank_in_company_split")
def rank_in_company_split(spark, sf_dir):
    """The same by positions in spans, as for keys too large for one task."""
    trades = trades_raw(spark, sf_dir).select("trade_id", "Company")
    return rank_within(trades, "Company", "trade_id", "company_rank", group_rows=100)


def _rounded(spark, sf_dir):
    trades = trades_typed(spark, sf_dir)
    return trades.select("trade_id", "Company", "Time", F.round("Price").alias("price"))


@query("totals_over_company")
def totals_over_company(spark, sf_dir):
    return totals_over(_rounded(spark, sf_dir), "Company", "price", spread_by=["trade_id"])


@query("totals_over_company_window")
def totals_over_company_window(spark, sf_dir):
    return totals_over(_rounded(spark, sf_dir), "Company", "price", form="window")


@query("totals_over_company_split")
def totals_over_company_split(spark, sf_dir):
    """The same with a shuffled join whose hot keys are split."""
    limits = {"group_rows": 100, "broadcast_bytes": 0}
    return totals_over(_rounded(spark, sf_dir), "Company", "price", spread_by=["trade_id"], **limits)


@query("running_totals")
def running_totals_by_bucket(spark, sf_dir):
    return running_totals(_bucketed(spark, sf_dir), "bucket", "Date", "price", spread_by=["trade_id"])


@query("running_totals_split")
def running_totals_split(spark, sf_dir):
    """The same by steps and spans, as for keys too large for one task."""
    return running_totals(_bucketed(spark, sf_dir), "bucket", "Date", "price", spread_by=["trade_id"], group_rows=50)


def _bucketed(spark, sf_dir):
    trades = format_date(_rounded(spark, sf_dir), "Time", "yyyy-MM-dd").drop("Company", "Time")
    return trades.withColumn("bucket", F.floor(F.col("price") / 50_000))


def _by_priority(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")


@query("running_totals_exact")
def running_totals_exact(spark, sf_dir):
    """Sums of fractions that come out the same however a group is split; here into steps and spans."""
    orders = _by_priority(spark, sf_dir)
    return running_totals(orders, "o_orderpriority", "o_orderdate", "o_totalprice", group_rows=200, exact=True)


@query("totals_exact")
def totals_exact(spark, sf_dir):
    orders = _by_priority(spark, sf_dir)
    return totals_over(orders, "o_orderpriority", "o_totalprice", form="window", exact=True)


# Checks


@query("schema_violations")
def schema_violation_report(spark, sf_dir):
    return schema_violations(trades_raw(spark, sf_dir), TRADE_SCHEMA)


@query("schema_violations_nested")
def schema_violation_report_nested(spark, sf_dir):
    """Violations inside a struct, an array of structs and a map."""
    line = F.struct(
        F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("quantity")
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderstatus"))
    nested = orders.select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("key"), status.alias("status")).alias("buyer"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("lines")).alias("lines"),
        F.create_map("o_orderpriority", F.when(F.col("o_totalprice") > 100_000, F.col("o_totalprice"))).alias("marks"),
    )
    return schema_violations(nested, NESTED_SCHEMA)


@query("quality_report_rough")
def quality_rules_on_rough(spark, sf_dir):
    """Rules on values that are negative, NULL or do not parse."""
    return quality_report(trades_rough(spark, sf_dir), _rough_rules())


@query("quality_report")
def quality_rules(spark, sf_dir):
    trades = with_measures(trades_raw(spark, sf_dir))
    return quality_report(
        trades,
        {
            "price is positive": F.col("Price") > 0,
            "price is below 400,000": F.col("Price") < 400_000,
            "ratio is over 20": F.col("earning_ratio") > 20,
        },
    )


@query("row_count")
def row_count_of(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query("preview")
def preview_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders"), "o_orderkey", 20)


@query("sample_by_key")
def sample_keys(spark, sf_dir):
    return sample_by_key(table(spark, sf_dir, "lineitem"), "l_orderkey", 10)


@query("sample_exact")
def sample_of_exact_size(spark, sf_dir):
    """Fifty lines of each return flag."""
    lines = table(spark, sf_dir, "lineitem")
    return sample_exact(lines, 50, ["l_orderkey", "l_linenumber"], "l_returnflag", "pick")


# Pipelines


@query("silver_pipeline")
def silver_pipeline(spark, sf_dir):
    return silver(trades_raw(spark, sf_dir), options=BOUNDS)


@query("silver_pipeline_split")
def silver_pipeline_split(spark, sf_dir):
    """The same with every join shuffled and every group split."""
    options = SilverOptions(BOUNDS.low, BOUNDS.high, group_rows=1000, broadcast_bytes=0)
    return silver(trades_raw(spark, sf_dir), options=options)


@query("silver_pipeline_by_company")
def silver_pipeline_by_company(spark, sf_dir):
    return silver_by_company(trades_raw(spark, sf_dir), options=BOUNDS)


@query("flat_pipeline")
def flat_pipeline(spark, sf_dir):
    flattened = flat(trades_raw(spark, sf_dir))
    return flattened.withColumn("Time", F.col("Time").cast("timestamp_ntz"))


@query("silver_job")
def silver_job(spark, sf_dir):
    """The silver pipeline from a named source to CSV files of a day, read back."""
    trades_raw(spark, sf_dir).createOrReplaceTempView("trades_raw")
    root = scratch.new_path(spark, "silver")
    job = Job("trades_raw", target_root=root, day=RUN_DAY, format="csv", writer_options=CSV_OPTIONS, options=BOUNDS)
    run(spark, job)
    return spark.read.schema(SILVER_SCHEMA).options(**CSV_OPTIONS).csv(dated_path(root, RUN_DAY))


@query("silver_job_judged")
def silver_job_judged(spark, sf_dir):
    """A job held against a schema, a number of rows and its rules; rows of the highest class are set aside."""
    trades = trades_raw(spark, sf_dir)
    trades.createOrReplaceTempView("trades_raw")
    root = scratch.new_path(spark, "silver")
    job = Job(
        "trades_raw", target_root=root, day=RUN_DAY, options=BOUNDS, schema=trades.schema,
        most_rows=100 * trades.count(), rules={"not the highest": F.col("PRICE_CATEGORY") != "High"},
        rejects_root=f"{root}-rejects", most_failing={"not the highest": 0.9},
    )
    run(spark, job)
    return spark.read.schema(SILVER_SCHEMA).parquet(dated_path(root, RUN_DAY))
