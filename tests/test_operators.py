"""Single operators on literal rows: the awkward values, and what is refused."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.testing import assertDataFrameEqual

from tapeloom import calls
from tapeloom.functions import (
    category,
    clean_percent,
    clean_price,
    guarded_ratio,
    parse_timestamp,
    strip_rupee,
    to_float,
)
from tapeloom.operators import (
    ceil_sum,
    fanout_report,
    format_date,
    in_order,
    join_lookup,
    mask,
    name_case,
    preview,
    quality_report,
    rank_within,
    row_count,
    running_totals,
    sample_by_key,
    schema_violations,
    sum_by,
    totals_over,
)
from tapeloom.sources import read_table, sql_query, table_exists

PRICES = ["₹1,234.50", "1234.5", "-12.5", "n/a", "", None, "2000", "5000", "1e3"]


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame(list(enumerate(PRICES)), "id int, price string")


def values(df, column):
    return [row[0] for row in df.orderBy("id").select(column).collect()]


# Text to numbers


def test_clean_price(prices):
    assert values(prices, clean_price("price")) == [1234.5, 1234.5, 12.5, None, None, None, 2000.0, 5000.0, 13.0]


def test_clean_price_signed(prices):
    assert values(prices, clean_price("price", signed=True))[2] == -12.5


def test_strip_rupee_leaves_commas(prices):
    got = values(prices, strip_rupee("price"))
    assert got == [None, 1234.5, -12.5, None, None, None, 2000.0, 5000.0, 1000.0]


def test_to_float(prices):
    assert values(prices, to_float("price"))[:3] == [None, 1234.5, -12.5]


def test_clean_percent(spark):
    df = spark.createDataFrame(list(enumerate(["2%", "-1.5%", "0%", "x", None])), "id int, pct string")
    assert values(df, clean_percent("pct")) == [2.0, -1.5, 0.0, None, None]


def test_types_of_clean_numbers(prices):
    assert prices.select(clean_price("price").alias("p"), clean_percent("price").alias("c")).dtypes == [
        ("p", "float"),
        ("c", "double"),
    ]


# Dates


TIMES = ["1999-12-31 23:59:59", "2024-02-29 00:00:00", "31.12.1999", None]


@pytest.fixture(scope="module")
def times(spark):
    return spark.createDataFrame(list(enumerate(TIMES)), "id int, t string")


@pytest.mark.parametrize(
    ("pattern", "texts"),
    [
        ("yyyyMMdd", ["19991231", "20240229"]),
        ("d MMM yy", ["31 Dec 99", "29 Feb 24"]),
        ("HH:mm", ["23:59", "00:00"]),
        ("'Q'q yyyy", ["Q4 1999", "Q1 2024"]),
    ],
)
def test_format_date(times, pattern, texts):
    assert values(format_date(times, "t", pattern), "Date") == [*texts, None, None]


def test_format_date_of_a_timestamp(spark):
    df = spark.createDataFrame([(0, datetime(1970, 1, 1, 0, 0, 1)), (1, None)], "id int, t timestamp_ntz")
    assert values(format_date(df, "t", "dd.MM.yyyy ss", "day"), "day") == ["01.01.1970 01", None]


def test_parse_timestamp(times):
    got = values(times, parse_timestamp("t").cast("timestamp_ntz"))
    assert got == [datetime(1999, 12, 31, 23, 59, 59), datetime(2024, 2, 29), None, None]


# Columns


def test_later_steps_see_earlier_ones(spark):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    got = in_order(df, [("x", F.col("a") + 1), ("x", F.col("x") * 10), ("b", F.col("x") + F.col("b"))])
    assertDataFrameEqual(got, spark.createDataFrame([(1, 22, 20), (3, 44, 40)], "a int, b int, x int"))


def test_a_mapping_is_one_step(spark):
    df = spark.createDataFrame([(1,)], "a int")
    got = in_order(df, [{"a": F.col("a") + 1, "b": F.col("a") * 10}])
    assert got.first().asDict() == {"a": 2, "b": 10}


def test_no_steps(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert in_order(df, []).collect() == df.collect()


@pytest.mark.parametrize(
    ("case", "want"),
    [
        ("upper", ["TRADE_ID", "PRICE IN €", "ÄNDERUNG", "A.B"]),
        ("LOWER", ["trade_id", "price in €", "änderung", "a.b"]),
        ("title", ["trade_Id", "Price in €", "Änderung", "a.B"]),
        ("", ["trade_Id", "Price in €", "Änderung", "a.B"]),
    ],
)
def test_name_case(spark, case, want):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["trade_Id", "Price in €", "Änderung", "a.B"])
    assert name_case(df, case).columns == want
    assert tuple(name_case(df, case).first()) == (1, 2, 3, 4)


def test_names_are_in_upper_case_unless_told(spark):
    assert name_case(spark.range(1).withColumnRenamed("id", "row_no")).columns == ["ROW_NO"]


def test_names_that_collide_are_refused(spark):
    df = spark.sql("select 1 as a, 2 as A")
    with pytest.raises(ValueError, match="equal: A"):
        name_case(df)


def test_mask_hides_nulls_and_refuses_unknown_columns(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "id int, secret double")
    masked = mask(df, ["SECRET"])
    assert [row[1] for row in masked.collect()] == ["********"] * 2
    assert mask(df, []).columns == ["id", "secret"]
    with pytest.raises(ValueError, match="secrt"):
        mask(df, ["secrt"])


def test_category_bounds_and_null(spark):
    df = spark.createDataFrame([(0, 1999.9), (1, 2000.0), (2, 5000.0), (3, 5000.1), (4, None)], "id int, p double")
    assert values(df, category(F.col("p"), 2000, 5000)) == ["Low", "Medium", "Medium", "High", "High"]
    assert values(df, category(F.col("p"), 2000, 5000, null_label="None"))[4] == "None"


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 1.0, 0.0), (2, 1.0, None)], "id int, n double, d double")
    assert values(df, guarded_ratio(F.col("n"), F.col("d"))) == [0.5, None, None]


# Groups


def test_ceil_sum(spark):
    rows = [("a", "₹1,234.50"), ("a", "0.1"), ("a", "n/a"), ("b", None)]
    df = spark.createDataFrame(rows, "k string, price string")
    assert {r["k"]: r["total"] for r in ceil_sum(df, "k", "price").collect()} == {"a": 1236, "b": None}
    raw = {r["k"]: r["t"] for r in ceil_sum(df, ["k"], "price", "t", clean=False).collect()}
    assert raw == {"a": 1, "b": None}
    assert ceil_sum(df, "k", "price").dtypes[1] == ("total", "bigint")


def test_ceil_sum_keeps_sign_and_exponent(spark):
    for text, total in (("-12.5", -12), ("₹-3", -3), ("1e3", 1000), ("₹1,234.5", 1235), ("x", None)):
        df = spark.createDataFrame([("a", text)], "k string, price string")
        assert ceil_sum(df, "k", "price").first()["total"] == total
    wide = spark.sql("select 'a' as k, cast(100000000.3 as double) as v, cast(1.5 as decimal(12,2)) as d")
    assert ceil_sum(wide, "k", "v").first()["total"] == 100_000_000
    assert ceil_sum(wide, "k", "d").dtypes[1] == ("total", "bigint") and ceil_sum(wide, "k", "d").first()["total"] == 2


def test_ceil_sum_of_numbers(spark):
    df = spark.createDataFrame([("a", 1.2), ("a", -1.2), ("a", 3.0)], "k string, v double")
    assert ceil_sum(df, "k", "v").first()["total"] == 2 - 1 + 3


def test_sum_by(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "k string, v int")
    assert {r["k"]: r["total"] for r in sum_by(df, "k", "v").collect()} == {"a": 3, None: 5}


# Joins


@pytest.fixture(scope="module")
def sides(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "z")], "id int, e string")
    lookup = spark.createDataFrame([("x", 10), ("x", 20), ("y", 30), (None, 40), ("w", 50)], "e string, total int")
    return rows, lookup


def test_join_puts_keys_first_and_keeps_unmatched(sides):
    got = join_lookup(*sides, "e")
    assert got.columns == ["e", "id", "total"]
    assert {r["id"]: r["total"] for r in got.collect() if r["e"] != "x"} == {3: 30, 4: None, 5: None}


def test_join_keeps_the_spelling_of_the_rows(sides):
    rows, lookup = sides
    got = join_lookup(rows.withColumnRenamed("e", "E"), lookup, "e")
    assert got.columns == ["E", "id", "total"]


def test_join_to_unique_keys_keeps_the_row_count(sides):
    rows, lookup = sides
    assert join_lookup(rows, sum_by(lookup, "e", "total"), "e").count() == rows.count()


def test_join_refuses_what_it_cannot_do(sides):
    rows, lookup = sides
    with pytest.raises(ValueError, match="full"):
        join_lookup(rows, lookup, "e", "full")
    with pytest.raises(ValueError, match="both sides"):
        join_lookup(rows, lookup.withColumnRenamed("total", "ID"), "e")
    with pytest.raises(TypeError, match="two types"):
        join_lookup(rows, lookup.select(F.lit(1).alias("e")), "e")


def test_fanout_report_foretells_the_join(sides):
    rows, lookup = sides
    report = {r["e"]: r for r in fanout_report(rows, lookup, "e").collect()}
    made = {r["e"]: r["count"] for r in rows.join(lookup, "e", "left").groupBy("e").count().collect()}
    assert {e: r["output_rows"] for e, r in report.items() if r["left_rows"]} == made
    assert report["x"]["right_repeats"] and not report["y"]["right_repeats"]
    assert report["w"]["output_rows"] == 0
    assert (report[None]["unmatched_left_rows"], report["z"]["unmatched_left_rows"]) == (1, 1)


# Windows


def test_rank_needs_an_order(sides):
    with pytest.raises(ValueError, match="order"):
        rank_within(sides[0], "e", [])


def test_rank_is_an_int_from_one(sides):
    got = rank_within(sides[0], "e", "id", "r")
    assert dict(got.dtypes)["r"] == "int"
    assert {r["id"]: r["r"] for r in got.collect()} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1}


def test_rank_of_large_groups_is_a_bigint(sides):
    for group_rows in (1, 100):
        got = rank_within(sides[0], "e", "id", "r", group_rows=group_rows, rank_type="bigint")
        assert dict(got.dtypes)["r"] == "bigint"
        assert sorted(r["r"] for r in got.collect()) == [1, 1, 1, 1, 2]


def test_totals_group_nulls(sides):
    got = totals_over(sides[1], "e", "total", "t", "a")
    assert {(r["e"], r["t"], r["a"]) for r in got.collect()} == {
        ("x", 30, 15.0), ("y", 30, 30.0), (None, 40, 40.0), ("w", 50, 50.0)
    }


def test_unknown_form_is_refused(sides):
    with pytest.raises(ValueError, match="form"):
        totals_over(sides[1], "e", "total", form="other")


def test_running_totals_share_a_value_in_a_tie(spark):
    rows = [(1, "d1", 1.0), (2, "d2", 2.0), (3, "d2", 3.0), (4, "d3", 4.0)]
    df = spark.createDataFrame(rows, "id int, d string, v double")
    got = running_totals(df.withColumn("k", F.lit(1)), "k", "d", "v", "t", "a")
    assert values(got, "t") == [1.0, 6.0, 6.0, 10.0]
    assert values(got, "a") == [1.0, 2.0, 2.0, 2.5]


# Checks


def test_schema_violations(spark):
    df = spark.createDataFrame([("1", "x", 1), ("y", None, 2), (None, "z", 3)], "price string, name string, extra int")
    expected = StructType.fromDDL("PRICE double, name string, id bigint")
    got = {r["column"]: tuple(r)[1:] for r in schema_violations(df, expected).collect()}
    assert got == {
        "PRICE": ("mistyped", "double", "string", 1, 3),
        "id": ("missing", "bigint", None, None, 3),
        "extra": ("extra", None, "int", None, 3),
    }
    assert schema_violations(df, df.schema).count() == 0


def test_quality_report(prices):
    number = clean_price("price")
    report = quality_report(prices, {"known": number.isNotNull(), "small": number < 100})
    got = {r["rule"]: tuple(r)[1:] for r in report.collect()}
    assert got == {"known": (9, 6, 3, 0), "small": (9, 2, 4, 3)}


def test_a_report_needs_rules(prices):
    with pytest.raises(ValueError, match="rules"):
        quality_report(prices, {})


def test_preview_and_row_count(prices):
    assert [r["id"] for r in preview(prices, "id", 3).collect()] == [0, 1, 2]
    assert row_count(prices).first()["rows"] == 9


def test_sample_is_repeatable_and_keeps_keys_whole(spark):
    df = spark.range(3000).selectExpr("id % 1000 as k", "id")
    first = {r["k"]: r["count"] for r in sample_by_key(df, "k", 5).groupBy("k").count().collect()}
    again = {r["k"] for r in sample_by_key(df.repartition(3), "k", 5).collect()}
    assert set(first) == again
    assert 100 < len(first) < 300
    assert set(first.values()) == {3}


# Sources


@pytest.fixture
def harbours(spark):
    rows = [(11, "Split", 9.5), (12, "Bar", None), (13, None, 14.0), (14, "Kotor", 30.25), (15, "Split", -1.0)]
    spark.createDataFrame(rows, "no bigint, place string, depth double").createOrReplaceTempView("harbours")
    yield rows
    spark.catalog.dropTempView("harbours")


@pytest.mark.parametrize(
    ("predicate", "numbers"),
    [
        (None, [11, 12, 13, 14, 15]),
        ("", [11, 12, 13, 14, 15]),
        ("place = 'Split' and depth > 0", [11]),
        ("depth is null or place is null", [12, 13]),
        ("no % 2 = 0 or depth < 0", [12, 14, 15]),
        ("false", []),
    ],
)
def test_read_table(spark, harbours, predicate, numbers):
    got = [tuple(r) for r in read_table(spark, "harbours", predicate).collect()]
    assert sorted(got) == [row for row in harbours if row[0] in numbers]


def test_read_takes_predicates_only(spark, harbours):
    with pytest.raises(AnalysisException):
        read_table(spark, "harbours", "no > 0 order by place limit 1")


def test_missing_table_raises(spark):
    with pytest.raises(AnalysisException):
        read_table(spark, "no_such_table")


def test_table_exists(spark, harbours):
    assert table_exists(spark, "harbours")
    assert not table_exists(spark, "no_such_table")
    assert not table_exists(spark, "no_such_schema.harbours")
    assert not table_exists(spark, "no_such_catalog.schema.harbours")


def test_sql_query(spark, harbours):
    assert sql_query(spark, "select count(place) as n from harbours").first()["n"] == 4
    assert sql_query(spark, "select min(depth) as m from {t}", t=read_table(spark, "harbours")).first()["m"] == -1.0


def test_predicates_reach_the_scan(spark, testdata, capsys):
    spark.read.parquet(f"{testdata}/sf0.001/lineitem.parquet").createOrReplaceTempView("lines")
    read_table(spark, "lines", "l_quantity > 30").select("l_orderkey").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(l_quantity,30.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


# The names notebooks call


def test_calls(spark, harbours, tmp_path):
    assert calls.check_table_exists(spark, "harbours")
    df = calls.ingest_data(spark, "harbours", "depth > 0")
    df = calls.apply_transformations(df, [("twice", F.col("depth") * 2)])
    assert {r["place"]: r["total"] for r in calls.transform_data(df, "place", "twice").collect()} == {"Split": 19.0, None: 28.0, "Kotor": 60.5}
    assert calls.aggregate_data(df, ["place"], "twice", "t").columns == ["place", "t"]
    df = calls.change_name_case(calls.mask_sensitive_data(df.select("no", "place"), ["place"]))
    calls.write_data(df, str(tmp_path / "out"), "overwrite", "csv", {"header": "true", "delimiter": ";"})
    back = spark.read.csv(str(tmp_path / "out"), header=True, sep=";")
    assert back.columns == ["NO", "PLACE"] and {tuple(r) for r in back.collect()} == {(n, "********") for n in ("11", "13", "14")}
    stamped = spark.createDataFrame([("2000-02-29 06:07:08",)], ["t"])
    assert calls.convert_timestamp_to_date(stamped, "t", "D yyyy").first()["Date"] == "60 2000"


def test_calls_by_keyword(spark, harbours):
    df = calls.ingest_data(spark, source_table="harbours", filter_condition="no > 13")
    assert calls.ingest_data_from_table(source_table="harbours", filter_condition="no > 13").collect() == df.collect()
    df = calls.apply_transformations(df, transformations=[("half", F.col("depth") / 2)])
    assert {r["total"] for r in calls.transform_data(df, group_column="place", agg_column="half").collect()} == {15.125, -0.5}
    totals = calls.aggregate_data(df, groupby_cols=["place"], agg_col="half", alias="t")
    assert totals.columns == ["place", "t"]
    assert calls.mask_sensitive_data(df, sensitive_columns=["place"]).first()["place"] == "********"
    assert calls.change_name_case(df, case="lower").columns == ["no", "place", "depth", "half"]
    assert calls.check_table_exists(spark, three_level_namespace="harbours")
    stamped = spark.createDataFrame([("2021-12-31 00:00:01",)], ["t"])
    dated = calls.convert_timestamp_to_date(stamped, timestamp_col="t", date_format_str="yyyy'-Q'q")
    assert dated.first()["Date"] == "2021-Q4"
