"""Hot keys: every result equals the plain one, however the rows are split."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import join_lookup, join_rows, rank_within, running_totals, totals_over
from tapeloom.operators.skew import CELL, HASH, ROWS, gridded, hot_among, hot_keys, key_hash
from tapeloom.operators.windows import _sorted_spans
from tapeloom.plans import flat, silver, silver_by_company
from tapeloom.plans.silver_table import SilverOptions, checked_rank
from tapeloom.registry.oracle import FLAT, SILVER, SILVER_BY_COMPANY
from tests.compare import assert_equal

BOUNDS = {"low": 100_000, "high": 300_000}
SPLIT = {"group_rows": 40, "broadcast_bytes": 0}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module", autouse=True)
def many_partitions(spark):
    """Spark would merge such small partitions, and everything would land in one span."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; one key holds half of them, NULL a tenth; values are whole, steps repeat."""
    rng = random.Random(7)
    keys = [None] * 2 + ["hot"] * 10 + ["a", "b", "c", "d", "e", "f", "g", "h"]
    rows = [(i, rng.choice(keys), rng.randint(1, 60), float(rng.randint(-50, 50))) for i in range(3000)]
    rows += [(3000 + i, "hot", rng.choice([None, 5]), None) for i in range(40)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id bigint, k string, step int, v double").repartition(6, "id")


@pytest.fixture(scope="module")
def trades(spark):
    """Trades with NULL and repeated companies and exchanges, so that exchange sets differ."""
    rng = random.Random(11)
    where = {"A": ["X", "Y"], "B": ["X", "Y"], "C": ["X"], "D": ["Y", "Z"], "E": ["Z"], None: ["Y", None]}
    prices = ["₹1,234.50", "1234.5", "-12.5", "n/a", "", None, "2000", "5000", "1e3", "₹250,000.25", "₹400,000"]
    changes = ["2%", "-1.5%", "0%", "x", None, "10%"]
    times = ["1999-12-31 23:59:59", "2024-02-29 00:00:00", "1970-01-01 00:00:01", "1999-12-31 01:00:00"]
    rows = []
    for i in range(600):
        company = rng.choice(["A"] * 5 + ["B", "C", "D", "E", None])
        exchange = rng.choice([*where[company], where[company][0], None if rng.random() < 0.1 else where[company][-1]])
        rows.append((i, rng.choice(times), company, exchange, rng.choice(prices), rng.choice(changes)))
    schema = "trade_id bigint, Time string, Company string, Exchange string, Price string, percentage_change string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def db(trades):
    con = duckdb.connect()
    frame = trades.toPandas()
    con.register("frame", frame)
    con.execute("create table raw as select * from frame")
    assert con.execute("select count(*) from raw where \"Exchange\" is null").fetchall()[0][0] > 0
    return con


def test_hot_keys_are_found(skewed):
    found = hot_keys(skewed, ["k"], 250)
    names = {row["h"]: row["k"] for row in skewed.select("k", key_hash(["k"]).alias("h")).distinct().collect()}
    counts = {names[row[HASH]]: row[ROWS] for row in found.table.collect()}
    assert counts == {k: skewed.where(F.col("k").eqNullSafe(F.lit(k))).count() for k in ("hot", None)}
    assert found.keys == 2 and found.rows == sum(counts.values())
    assert hot_keys(skewed, ["id"], 1) is None


def test_every_key_over_the_bound_is_split(spark):
    many = spark.range(8_000 * 250).selectExpr("id % 8000 as k", "id div 8000 as v")
    assert hot_keys(many, ["k"], 100).keys == 8_000
    assert hot_among(many.groupBy("k").count(), ["k"], "count", 249).keys == 8_000


@pytest.mark.parametrize("kind", ["int", "bigint", "float", "double", "decimal(15,2)"])
def test_types_do_not_depend_on_size(spark, kind):
    rows = spark.range(300).selectExpr("id % 3 as k", "id % 7 as step", "id as __from", "id as _from", f"cast(id as {kind}) as v")
    plain, split = (running_totals(rows, "k", "step", "v", group_rows=n) for n in (10**9, 1))
    assert plain.dtypes == split.dtypes and rows_of(plain) == rows_of(split)
    plain, split = (totals_over(rows, "k", "v", form="window", group_rows=n) for n in (10**9, 1))
    assert plain.dtypes == split.dtypes and rows_of(plain) == rows_of(split)
    plain, split = (rank_within(rows, "k", ["step", "_from"], group_rows=n) for n in (10**9, 1))
    assert plain.dtypes == split.dtypes and rows_of(plain) == rows_of(split)


@pytest.mark.parametrize("group_rows", [1, 300, 10_000])
def test_rank_in_pieces(skewed, group_rows):
    plain = rank_within(skewed, "k", ["step", "id"], "r", hot={})
    split = rank_within(skewed, "k", ["step", "id"], "r", group_rows=group_rows)
    assert split.dtypes == plain.dtypes
    assert rows_of(split) == rows_of(plain)


def test_rank_of_copies_in_pieces(spark):
    copies = spark.range(8000).selectExpr("'hot' as k", "case when id < 6000 then 0 else id end as v").repartition(8)
    ranked = rank_within(copies, "k", "v", "r", group_rows=100)
    assert sorted(row["r"] for row in ranked.collect()) == list(range(1, 8001))
    assert {row["v"] for row in ranked.where("r <= 6000").select("v").distinct().collect()} == {0}
    spans = _sorted_spans(copies, ["k"], ["v"], 8000).groupBy("__tapeloom_span").count().collect()
    assert max(row["count"] for row in spans) < 3000


@pytest.mark.parametrize("group_rows", [1, 30, 300, 10_000])
def test_running_totals_in_pieces(skewed, group_rows):
    plain = running_totals(skewed, "k", "step", "v", group_rows=10**9)
    split = running_totals(skewed, "k", "step", "v", group_rows=group_rows, spread_by=["id"])
    assert split.columns == plain.columns
    assert rows_of(split) == rows_of(plain)


def test_running_totals_are_those_of_sql(skewed):
    con = duckdb.connect()
    frame = skewed.toPandas()
    frame["step"] = frame["step"].astype("Int32")
    con.register("frame", frame)
    sql = """select id, k, step, v, sum(v) over w as total, avg(v) over w as average
             from (select * replace (case when isnan(v) then null else v end as v) from frame)
             window w as (partition by k order by step nulls first)"""
    for group_rows in (1, 10_000):
        assert_equal(running_totals(skewed, "k", "step", "v", group_rows=group_rows), con, sql)


@pytest.mark.parametrize("form", ["join", "window"])
@pytest.mark.parametrize("limits", [{}, {"group_rows": 250, "broadcast_bytes": 0}])
def test_forms_of_totals_agree(skewed, form, limits):
    want = {k: (t, a) for k, t, a in skewed.groupBy("k").agg(F.sum("v"), F.avg("v")).collect()}
    got = totals_over(skewed, "k", "v", form=form, **limits).collect()
    assert len(got) == skewed.count()
    assert all((row["total"], row["average"]) == want[row["k"]] for row in got)


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 20}])
def test_lookup_join_is_a_plain_join(spark, skewed, null_safe, how, limits):
    lookup = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("hot", 3), ("a", 4), (None, 5), ("none", 6), ("b", 7), ("hot", 8)], "k string, x int"
    )
    right = lookup.withColumnRenamed("k", "rk")
    same = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    want = skewed.join(right, same, how).select("k", "id", "step", "v", "x")
    got = join_lookup(skewed, lookup, "k", how, null_safe, spread_by=["id"], **limits)
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)


def cells_of(df):
    return {tuple(row)[:2]: row["count"] for row in df.groupBy(*CELL).count().collect()}


def test_copies_of_one_row_are_spread(spark):
    copies = spark.range(20_000).selectExpr("'hot' as k", "1 as v").repartition(16)
    lookup = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, x int")
    grid = gridded(copies, lookup, ["k"], 1000, ["k", "v"])
    assert grid.lookup.where("k = 'hot'").count() == 20
    per_cell = cells_of(grid.rows)
    assert sum(per_cell.values()) == 20_000 and max(per_cell.values()) < 10_000


@pytest.mark.parametrize(("left", "right"), [(2, 10_000), (10_000, 2), (150, 150), (1, 20_000), (20_000, 0)])
def test_a_key_hot_on_either_side_becomes_a_grid(spark, left, right):
    rows = spark.range(left).selectExpr("'hot' as k", "id").union(spark.sql("select 'cold', -1L"))
    lookup = spark.range(right).selectExpr("'hot' as k", "id as x").union(spark.sql("select 'cold', -1L")).union(spark.sql("select 'other', -2L"))
    grid = gridded(rows, lookup, ["k"], 100, ["id"])
    cells = -(-left * max(right, 1) // 100)
    dealt, met = grid.rows.where("k = 'hot'"), grid.lookup.where("k = 'hot'")
    parts = [max([1, *(row[0] + 1 for row in dealt.select(name).distinct().collect())]) for name in CELL]
    assert 0.7 * cells <= parts[0] * parts[1] <= 1.5 * cells + 2
    # Each side is copied once for each part of the other one, and the copies are as few as they can be.
    assert dealt.count() == left * parts[1] and met.count() == right * parts[0]
    assert dealt.count() + met.count() <= 2.5 * (left + right) + 3 * (cells * left * right) ** 0.5
    assert grid.rows.where("k = 'cold'").count() == grid.lookup.where("k = 'cold'").count() == grid.lookup.where("k = 'other'").count() == 1
    for how in ("left", "inner"):
        got = join_lookup(rows, lookup, "k", how, spread_by=["id"], broadcast_bytes=0, hot_rows=100)
        assert rows_of(got) == rows_of(rows.join(lookup, "k", how))


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_a_lookup_too_large_to_send_is_never_sent(spark, hot_rows, capsys):
    """The planner's own estimate of a grid's copies is that of the few rows they are copied from."""
    rows = spark.range(5000).selectExpr("id % 2 as k", "id")
    lookup = spark.range(10).selectExpr("id % 2 as k", "id as x")
    got = join_lookup(rows, lookup, "k", spread_by=["id"], broadcast_bytes=0, hot_rows=hot_rows)
    assert len(rows_of(got)) == 25_000
    got.explain()
    plan = capsys.readouterr().out
    top = min(plan.index(kind) for kind in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if kind in plan)
    assert plan[top:].startswith("SortMergeJoin")


def test_one_hot_key_among_many_is_dealt_out_before_it_is_multiplied(spark, capsys):
    lookup = spark.range(2000).selectExpr("if(id < 100, -1, id) as k", "id as x")
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) as k", "id")
    got = join_lookup(rows, lookup, "k", "inner")
    got.explain()
    assert "REPARTITION" in capsys.readouterr().out
    assert got.count() == 1000 * 100 + rows.join(lookup.where("k >= 0"), "k").count()


def test_rows_of_a_join_are_foretold(spark, skewed):
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 4), (None, 5), ("none", 6)], "k string, x int")
    for how in ("left", "inner"):
        assert join_rows(skewed, lookup, "k", how) == skewed.join(lookup, "k", how).count()
    assert join_rows(skewed.limit(0), lookup, "k") == 0
    with pytest.raises(ValueError, match="full"):
        join_rows(skewed, lookup, "k", "full")


def test_nothing_is_written_where_nothing_is_hot(spark, skewed, monkeypatch):
    monkeypatch.setattr("tapeloom.scratch.keep", lambda *_: pytest.fail("a table was written"))
    assert hot_keys(skewed, ["k"], 10_000) is None


@pytest.mark.parametrize("group_rows", [1, 50, 10**9])
def test_exact_sums_do_not_depend_on_the_split(spark, group_rows):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot", "hot", "a", None]), rng.randint(1, 40), rng.choice([None, 0.1, 1e-7, 1234567.891, -0.3, 1 / 3])) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, k string, step int, v double").repartition(5)
    wide = lambda v: Decimal(repr(v)).quantize(Decimal(1).scaleb(-18), ROUND_HALF_UP)
    got = running_totals(df, "k", "step", "v", group_rows=group_rows, exact=True)
    for row in got.collect():
        met = [wide(v) for _, k, step, v in rows if k == row["k"] and step <= row["step"] and v is not None]
        assert row["total"] == (float(sum(met)) if met else None) and row["average"] == (float(sum(met)) / len(met) if met else None)
    for form in ("join", "window"):
        for row in totals_over(df, "k", "v", form=form, group_rows=group_rows, exact=True).collect():
            met = [wide(v) for _, k, _, v in rows if k == row["k"] and v is not None]
            assert (row["total"], row["average"]) == (float(sum(met)), float(sum(met)) / len(met))


@pytest.mark.parametrize("spread_by", [None, ["id"]])
def test_rows_are_dealt_out_before_they_are_multiplied(spark, skewed, spread_by):
    lookup = spark.createDataFrame([(k, x) for k in ("hot", "a") for x in range(10)], "k string, x int")
    got = join_lookup(skewed, lookup, "k", "inner", spread_by=spread_by)
    assert rows_of(got) == rows_of(skewed.join(lookup, "k").select("k", "id", "step", "v", "x"))


@pytest.mark.parametrize("limits", [{}, SPLIT, {"group_rows": 40}, {"group_rows": 400}])
def test_silver_with_nulls(trades, db, limits):
    got = silver(trades, options=SilverOptions(**BOUNDS, **limits))
    assert assert_equal(got, db, f"with {SILVER}") > trades.count()


@pytest.mark.parametrize("limits", [{}, SPLIT])
def test_silver_without_a_row_key(trades, limits):
    options = SilverOptions(**BOUNDS, **limits)
    plain = trades.drop("trade_id")
    copies = plain.unionAll(plain.limit(1).join(plain.selectExpr("1 as one"), how="cross").drop("one"))
    got, keyed = silver(copies, (), options), silver(copies.withColumn("trade_id", F.rand(1)), options=options)
    assert rows_of(got.drop("COMPANY_RANK")) == rows_of(keyed.drop("COMPANY_RANK"))
    for group in got.groupBy("COMPANY").agg(F.sort_array(F.collect_list("COMPANY_RANK")).alias("ranks")).collect():
        assert group["ranks"] == list(range(1, len(group["ranks"]) + 1))


@pytest.mark.parametrize("limits", [{}, SPLIT])
def test_silver_by_company_with_nulls(trades, db, limits):
    got = silver_by_company(trades, options=SilverOptions(**BOUNDS, **limits))
    assert assert_equal(got, db, f"with {SILVER_BY_COMPANY}") == trades.count()


def test_a_rank_that_would_overflow_is_refused():
    checked_rank("bigint", 2**31)
    with pytest.raises(ValueError, match="bigint"):
        checked_rank("int", 2**31)


@pytest.mark.parametrize("group_rows", [5, 20, 10_000])
def test_flat_with_nulls(trades, db, group_rows):
    got = flat(trades, group_rows=group_rows)
    got = got.withColumn("Time", F.col("Time").cast("timestamp_ntz"))
    assert assert_equal(got, db, f"with {FLAT}") == trades.count()
