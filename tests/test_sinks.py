"""Writers: each format read back, in a fresh folder."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tapeloom import scratch
from tapeloom.sinks import dated_path, folders, write_days, write_files, write_table
from tapeloom.sources import days_in, read_dated


@pytest.fixture(scope="module")
def trades(spark):
    rows = [(1, "a,b", 1.5), (2, None, None), (3, 'q"uote', -2.0)]
    return spark.createDataFrame(rows, "id bigint, name string, price double")


@pytest.mark.parametrize(
    ("format", "options"),
    [("parquet", {}), ("orc", {}), ("json", {}), ("csv", {"header": "true", "delimiter": "|", "escape": '"'})],
)
def test_files_come_back(spark, trades, tmp_path, format, options):
    path = str(tmp_path / format)
    assert write_files(trades, path, "overwrite", format, options) == {}
    back = spark.read.format(format).schema(trades.schema).options(**options).load(path)
    assertDataFrameEqual(back, trades)


def test_append_and_overwrite(spark, trades, tmp_path):
    path = str(tmp_path / "files")
    for mode, rows in [("overwrite", 3), ("append", 6), ("overwrite", 3), ("ignore", 3)]:
        write_files(trades, path, mode)
        assert spark.read.parquet(path).count() == rows
    with pytest.raises(AnalysisException):
        write_files(trades, path, "error")
    counted = {"n": F.count(F.lit(1))}
    assert write_files(trades, path, "ignore", observe=counted) == {}
    assert write_files(trades, f"{path}_new", "ignore", observe=counted) == {"n": 3}


def test_table(spark, trades):
    write_table(trades, "written_trades")
    write_table(trades, "written_trades", "append")
    assert spark.table("written_trades").count() == 6
    write_table(trades, "written_trades", "overwrite", "parquet", {"compression": "zstd"})
    assertDataFrameEqual(spark.table("written_trades"), trades)
    spark.sql("drop table written_trades")


def test_counts_ride_on_the_write(spark, trades, tmp_path):
    seen = write_files(
        trades, str(tmp_path / "o"), observe={"rows": F.count(F.lit(1)), "priced": F.count("price")}
    )
    assert seen == {"rows": 3, "priced": 2}


def test_dated_path():
    assert dated_path("s3a://lake/silver/", date(2025, 3, 9)) == "s3a://lake/silver/2025-03-09"


def test_arguments_are_checked_first(trades, tmp_path):
    with pytest.raises(ValueError, match="mode"):
        write_files(trades, str(tmp_path / "x"), "replace")
    with pytest.raises(ValueError, match="target"):
        write_table(trades, "")
    assert not (tmp_path / "x").exists()


def test_scratch_is_in_the_shared_folder(spark, trades, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or scratch.folder(spark).startswith(before)
    kept, size, largest = scratch.keep_measured(trades, "t", ["id"], largest="id")
    assertDataFrameEqual(kept, trades)
    assert (size.rows, size.keys, largest) == (3, 3, 3)
    assert size.bytes == 3 * 3 * 16 + len("a,b") + len('q"uote')


def test_size_of_nothing(spark):
    _, size, largest = scratch.keep_measured(spark.sql("select 'x' as a where false"), "none", ["a"])
    assert (size, largest) == (scratch.Size(0, 0, 0), 0)


def test_a_cluster_must_name_its_shared_folder():
    class Elsewhere:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.folder(Elsewhere)


def day_rows(spark, *rows):
    return spark.createDataFrame([(day and date.fromisoformat(day), n) for day, n in rows], "day date, n int")


def test_days_of_a_table_are_replaced(spark):
    counts = lambda: {str(row["day"]): row["n"] for row in spark.table("day_table").groupBy("day").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    first = day_rows(spark, ("2024-02-28", 1), ("2024-02-29", 2), ("2024-02-29", 3))
    assert write_days(first, "day_table", "DAY", observe={"n": F.sum("n")}) == {"n": 6}
    assert counts() == {"2024-02-28": 1, "2024-02-29": 5}
    for _ in range(2):
        write_days(day_rows(spark, ("2024-02-29", 7), ("2024-03-01", 9)).select("n", "day"), "day_table", "day")
        assert counts() == {"2024-02-28": 1, "2024-02-29": 7, "2024-03-01": 9}
    days = [date(2024, 2, 28), date(2024, 3, 1)]
    assert write_days(day_rows(spark, ("2024-03-01", 4)), "day_table", "day", days) == {}
    assert counts() == {"2024-02-29": 7, "2024-03-01": 4}
    for other in ("2024-02-29", None):
        with pytest.raises(Exception, match="none of the days"):
            write_days(day_rows(spark, ("2024-03-01", 1), (other, 1)), "day_table", "day", days)
    with pytest.raises(ValueError, match="other columns"):
        write_days(first.withColumn("m", F.lit(1)), "day_table", "day")
    assert counts() == {"2024-02-29": 7, "2024-03-01": 4}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "static"
    spark.sql("drop table day_table")
    with pytest.raises(TypeError, match="no date"):
        write_days(first.withColumn("day", F.lit("x")), "day_table", "day")
    write_table(first, "day_table")
    with pytest.raises(ValueError, match="partitioned"):
        write_days(first, "day_table", "day")
    spark.sql("drop table day_table")


def test_dated_folders_are_one_source(spark, trades, tmp_path, capsys):
    root = str(tmp_path / "2001-01-01" / "lake")
    days = [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    for i, day in enumerate(days):
        part = trades.withColumn("id", F.col("id") + 10 * i)
        write_files(part, dated_path(root, day))
    for other in ("notes", "2024-13-01", "20240302"):
        (tmp_path / "2001-01-01" / "lake" / other).mkdir()
    assert days_in(spark, root) == days and days_in(spark, f"{root}/nothing") == []
    got = read_dated(spark, root, schema=trades.schema)
    assert {(row["id"], str(row["day"])) for row in got.collect()} == {(n + 10 * i, str(day)) for i, day in enumerate(days) for n in (1, 2, 3)}
    some = read_dated(spark, root, "day > '2024-02-28' and day < '2024-03-01'", schema=trades.schema)
    assert len(some.inputFiles()) > 0 and all("/2024-02-29/" in path for path in some.inputFiles())
    assert {row["id"] for row in some.collect()} == {11, 12, 13}
    assert read_dated(spark, root, "false", schema=trades.schema).columns == ["id", "name", "price", "day"]
    assert read_dated(spark, root, "day is null", schema=trades.schema).isEmpty()
    with pytest.raises(ValueError, match="no schema"):
        read_dated(spark, root, "false")
    with pytest.raises(ValueError, match="column name"):
        read_dated(spark, root, schema=trades.schema, day_column="name")


def test_a_folder_that_cannot_be_put_in_place(spark, trades, tmp_path, monkeypatch):
    target, staged = str(tmp_path / "t"), str(tmp_path / "s")
    write_files(trades, target)
    write_files(trades.limit(1), staged)
    real = folders.move

    def failing(spark, source, wanted):
        if source == staged:
            raise OSError("no")
        real(spark, source, wanted)

    monkeypatch.setattr(folders, "move", failing)
    with pytest.raises(OSError):
        folders.swap_in(spark, staged, target)
    assert spark.read.parquet(target).count() == 3
    monkeypatch.undo()
    folders.swap_in(spark, staged, target)
    assert spark.read.parquet(target).count() == 1 and folders.names(spark, str(tmp_path)) == ["t"]
