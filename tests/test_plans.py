"""The pipelines: shape, what they cost, and jobs from table to table."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.testing import assertDataFrameEqual

from tapeloom.operators import ceil_sum, fanout_report, in_order, join_lookup
from tapeloom.plans import Job, run, silver, silver_by_company
from tapeloom.plans.silver_table import SILVER_SCHEMA, SilverOptions, silver_rows
from tapeloom.registry.inputs import trades_raw
from tapeloom.sinks import Refused, folders, write_judged


@pytest.fixture(scope="module")
def trades(spark, testdata):
    return trades_raw(spark, str(testdata / "sf0.001"))


@pytest.mark.parametrize("build", [silver, silver_by_company])
def test_silver_schema(trades, build):
    want = [(f.name, f.dataType) for f in StructType.fromDDL(SILVER_SCHEMA).fields]
    assert [(f.name, f.dataType) for f in build(trades).schema.fields] == want


def test_silver_has_the_rows_the_report_foretells(trades):
    totals = ceil_sum(trades, ["Company", "Exchange"], "Price")
    foretold = fanout_report(trades, totals, "Exchange").agg(F.sum("output_rows")).first()[0]
    assert silver(trades).count() == foretold


def test_silver_is_sorted_before_it_is_multiplied(trades, capsys):
    silver(trades).explain()
    plan = capsys.readouterr().out
    top = plan.index("BroadcastHashJoin")
    assert plan.count("Window ") == 1
    assert top < plan.index("Window ") < plan.index("FileScan")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_own_company_needs_no_join(spark):
    rows = [(1, "1999-12-31 23:59:59", "A", "X", "10", "1%"), (2, "1999-12-31 23:59:59", "A", None, "20", "1%"),
            (3, "2000-01-01 00:00:00", None, "X", "30", "1%"), (4, "2000-01-01 00:00:00", "B", "X", "40", "x")]
    schema = "trade_id bigint, Time string, Company string, Exchange string, Price string, percentage_change string"
    trades = spark.createDataFrame(rows, schema)
    totals = ceil_sum(trades, ["Company", "Exchange"], "Price", "t").withColumn("own", F.col("Company"))
    joined = join_lookup(in_order(trades, [("Stock", F.col("Company"))]), totals, ["Company", "Exchange"])
    want = {(r["Stock"], r["Exchange"], r["own"]) for r in joined.collect()}
    got = {(r["STOCK"], r["EXCHANGE"], r["COMPANY"]) for r in silver_by_company(trades).collect()}
    assert got == want


def test_null_label_and_mask_are_options(spark):
    rows = [(1, "1999-12-31 23:59:59", "A", "X", "n/a", "1%")]
    schema = "trade_id bigint, Time string, Company string, Exchange string, Price string, percentage_change string"
    got = silver(spark.createDataFrame(rows, schema), options=SilverOptions(null_label="Unknown", mask="#")).first()
    assert (got["PRICE_CATEGORY"], got["EARNING_RATIO"], got["TOTAL_PRICE"]) == ("Unknown", "#", None)


@pytest.fixture
def source(spark, trades):
    trades.createOrReplaceTempView("trades_source")
    yield "trades_source"
    spark.catalog.dropTempView("trades_source")


def test_job_to_a_table(spark, trades, source):
    some = trades.withColumn("Price", F.when(F.col("trade_id") % 10 != 0, F.col("Price")))
    some.createOrReplaceTempView("trades_source")
    rules = {"no price": F.col("PRICE").isNotNull(), "over 100": F.col("PRICE") <= 100}
    seen = run(spark, Job(source, target_table="silver_target", rules=rules))
    written = spark.table("silver_target")
    rows, open_ones = written.count(), written.where("PRICE is null").count()
    assert 0 < open_ones < rows
    assert seen == {
        "rows": rows, "no price": open_ones, "no price undecided": 0, "over 100": rows - open_ones, "over 100 undecided": open_ones
    }
    assertDataFrameEqual(written, silver(some))
    spark.sql("drop table silver_target")


def test_a_refused_job_leaves_its_target(spark, source, trades, tmp_path):
    table = Job(source, target_table="judged_target", plan="silver_by_company", rules={"cheap": F.col("PRICE") < 400_000})
    run(spark, table)
    before = sorted(map(tuple, spark.table("judged_target").collect()))
    for change in (
        {"most_failing": {"cheap": 0.0}}, {"most_rows": 1499}, {"schema": StructType.fromDDL("Price double, Time string")},
        {"schema": StructType.fromDDL("Currency string")},
    ):
        with pytest.raises(Refused):
            run(spark, replace(table, predicate="trade_id % 2 >= 0", **change))
        assert sorted(map(tuple, spark.table("judged_target").collect())) == before
    assert run(spark, replace(table, most_failing={"cheap": 0.9}, most_rows=1500, predicate="trade_id < 100"))["rows foreseen"] == 100
    assert spark.table("judged_target").count() == 100
    run(spark, replace(table, most_failing={"cheap": 1.0}, mode="append", predicate="trade_id < 10"))
    assert spark.table("judged_target").count() == 110
    spark.sql("drop table judged_target")

    root = str(tmp_path / "files")
    files = Job(source, target_root=root, day=date(2025, 3, 9), plan="flat")
    run(spark, files)
    with pytest.raises(Refused, match="cheap"):
        run(spark, replace(files, rules={"cheap": F.col("Price") < 1}, most_failing={"cheap": 0.5}))
    assert spark.read.parquet(f"{root}/2025-03-09").count() == 1500 and folders.names(spark, root) == ["2025-03-09"]


def test_a_join_too_large_is_refused_without_running_it(spark, trades, source):
    assert silver_rows(trades) == 37_500
    with pytest.raises(Refused, match="37500") as refused:
        run(spark, Job(source, target_table="never_made", most_rows=30_000))
    assert refused.value.seen == {"rows foreseen": 37_500} and not spark.catalog.tableExists("never_made")


def test_rows_that_fail_go_to_a_folder_of_their_own(spark, source, tmp_path):
    rules = {"early": F.col("trade") < 1000, "even": F.col("trade") % 2 == 0}
    df = spark.range(1500).select(F.when(F.col("id") != 5, F.col("id")).alias("trade"), F.lit("x").alias("name"))
    target, rejects = str(tmp_path / "good"), str(tmp_path / "bad")
    for mode, times in (("overwrite", 1), ("append", 2), ("overwrite", 1)):
        seen = write_judged(df, rules, target, rejects=rejects, mode=mode)
        assert seen == {"rows": 1500, "early": 500, "early undecided": 1, "even": 749, "even undecided": 1}
        good = spark.read.schema(df.schema).parquet(target)
        bad = {row["failed_rules"]: row["count"] for row in spark.read.parquet(rejects).groupBy("failed_rules").count().collect()}
        assert good.count() == 500 * times and good.where("trade >= 1000 or trade % 2 = 1 or trade is null").isEmpty()
        assert bad == {name: n * times for name, n in {"early": 250, "even": 499, "early,even": 250, "early undecided,even undecided": 1}.items()}
    assert write_judged(df, rules, target, mode="ignore") == {}
    with pytest.raises(FileExistsError):
        write_judged(df, rules, target, mode="error")
    none = write_judged(df, {"none": F.lit(False)}, target, rejects=rejects)
    assert none["none"] == 1500 and spark.read.schema(df.schema).parquet(target).isEmpty()
    all_of_them = write_judged(df, {"any": F.lit(True)}, target, rejects=rejects, format="csv")
    assert all_of_them["any"] == 0 and spark.read.csv(target).count() == 1500 and folders.names(spark, rejects) == ["_SUCCESS"]
    assert folders.names(spark, str(tmp_path)) == ["bad", "good"]
    for bad_call in ({"rules": {}}, {"rules": rules, "most_failing": {"late": 0.1}}, {"rules": {"passed": F.lit(True)}}):
        with pytest.raises(ValueError):
            write_judged(df, path=target, **bad_call)


def test_rows_are_not_sorted_by_the_rules_they_fail(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    target, rejects = str(tmp_path / "good"), str(tmp_path / "bad")
    df = spark.range(0, 4000, 1, 1).selectExpr("id", "id % 7 as k")
    runs = spark._jsparkSession.sharedState().statusStore()
    seen = runs.executionsCount()
    write_judged(df, {"even": F.col("id") % 2 == 0}, target, rejects=rejects)
    plans = [runs.executionsList().apply(i).physicalPlanDescription() for i in range(seen, runs.executionsCount())]
    assert any("WriteFiles" in plan for plan in plans) and not any("Sort" in plan for plan in plans)
    many = {f"over {n}": F.col("k") > n for n in range(9)}  # more folders than a task holds open
    write_judged(df, many, str(tmp_path / "none"), rejects=str(tmp_path / "many"))
    assert [row["id"] for row in spark.read.parquet(target).collect()] == list(range(0, 4000, 2))
    assert [row["id"] for row in spark.read.parquet(rejects).collect()] == list(range(1, 4000, 2))
    assert spark.read.parquet(str(tmp_path / "many")).groupBy("failed_rules").count().count() == 7
    assert spark.read.parquet(str(tmp_path / "many")).count() == 4000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_job_of_one_day_of_a_table(spark, source):
    first, second = date(2025, 3, 9), date(2025, 3, 10)
    job = Job(source, target_table="days_target", plan="silver_by_company", day_column="RUN_DAY", predicate="trade_id < 700")
    assert run(spark, replace(job, day=first))["rows"] == 700
    run(spark, replace(job, day=second))
    before = sorted(map(tuple, spark.table("days_target").collect()), key=repr)
    run(spark, replace(job, day=second))
    assert sorted(map(tuple, spark.table("days_target").collect()), key=repr) == before
    run(spark, replace(job, day=first, predicate="trade_id < 10"))
    counts = lambda: {row["RUN_DAY"]: row["count"] for row in spark.table("days_target").groupBy("RUN_DAY").count().collect()}
    assert counts() == {first: 10, second: 700}
    assert run(spark, replace(job, day=first, predicate="false"))["rows"] == 0 and counts() == {second: 700}
    spark.sql("drop table days_target")


def test_job_to_dated_files(spark, source, tmp_path):
    job = Job(source, target_root=str(tmp_path), day=date(2025, 3, 9), plan="flat", predicate="trade_id < 500")
    assert run(spark, job)["rows"] == 500
    assert spark.read.parquet(str(tmp_path / "2025-03-09")).count() == 500


def test_files_of_text_are_compressed_unless_told_otherwise(spark, source, tmp_path):
    def written(name, **options):
        target = tmp_path / name
        run(spark, Job(source, target_root=str(target), day=date(2025, 3, 9), format="csv", writer_options={"header": "true", **options}))
        files = [path for path in (target / "2025-03-09").iterdir() if path.name.startswith("part-")]
        rows = spark.read.schema(SILVER_SCHEMA).csv(str(target / "2025-03-09"), header=True)
        return files, sum(path.stat().st_size for path in files), rows

    files, small, rows = written("packed", maxrecordsperfile=9000)
    plain_files, large, plain = written("plain", Compression="none")
    assert {path.suffix for path in files} == {".gz"} and {path.suffix for path in plain_files} == {".csv"}
    assert 6 * small < large and len(files) >= 37_500 / 9000
    assertDataFrameEqual(rows, plain)


def test_the_source_is_read_once(spark, trades):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    got = silver(trades.mapInArrow(seen, trades.schema), options=SilverOptions(group_rows=100))
    assert got.count() == 37_500 and read.value == 1500


def test_job_of_own_company(spark, source):
    assert run(spark, Job(source, target_table="own_target", plan="silver_by_company"))["rows"] == 1500
    spark.sql("drop table own_target")


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"source_table": "no_such_table"}, "no such table"),
        ({"target_table": None}, "target"),
        ({"plan": "gold"}, "plan"),
        ({"row_key": ("no_key",)}, "no_key"),
        ({"target_table": None, "target_root": "/x"}, "day"),
        ({"day_column": "d"}, "day"),
        ({"day_column": "d", "day": date(2025, 3, 9), "most_failing": {"x": 0}}, "judged"),
        ({"most_failing": {"x": 0}}, "no rules"),
    ],
)
def test_a_job_that_cannot_run_says_so(spark, source, change, message):
    with pytest.raises(ValueError, match=message):
        run(spark, Job(**{"source_table": source, "target_table": "t", **change}))
