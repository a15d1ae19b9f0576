"""Writes. A count or a rule check rides on the write as an observation, so no second pass is needed."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tapeloom.sinks import folders

# The write modes Spark knows.
MODES = {"append", "overwrite", "error", "errorifexists", "ignore"}


def dated_path(root: str, day: date) -> str:
    """``<root>/yyyy-MM-dd``."""
    return f"{root.rstrip('/')}/{day.isoformat()}"


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    format: str | None = None,
    options: Mapping[str, object] | None = None,
    observe: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Save as a catalog table; returns the observed values, if any were asked for.

    With ``ignore`` and a table that exists nothing is written and nothing observed: an empty result.
    """
    if mode.lower() == "ignore" and table and df.sparkSession.catalog.tableExists(table):
        return {}
    return _write(df, mode, format, options, observe, table, lambda writer: writer.saveAsTable(table))


def write_files(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    format: str = "parquet",
    options: Mapping[str, object] | None = None,
    observe: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Save as files under a path; returns the observed values, if any were asked for.

    With ``ignore`` and a path that exists nothing is written and nothing observed: an empty result.
    """
    if mode.lower() == "ignore" and path and folders.exists(df.sparkSession, path):
        return {}
    return _write(df, mode, format, options, observe, path, lambda writer: writer.save(path))


def write_days(
    df: DataFrame,
    table: str,
    day_column: str,
    days: Sequence[date] | None = None,
    format: str = "parquet",
    options: Mapping[str, object] | None = None,
    observe: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Replace whole days of a table that is partitioned by ``day_column``, a date; other days stay.

    The table is made if it is not there. Without ``days`` those that ``df`` has rows of are replaced. With
    them exactly those are, so a day without rows is emptied, and a row of another day or of none is an
    error that leaves the table as it was. A second run of the same rows changes nothing.
    """
    spark = df.sparkSession
    place = {name.lower(): name for name in df.columns}
    if day_column.lower() not in place:
        raise ValueError(f"no column {day_column}")
    own = place.pop(day_column.lower())
    if not isinstance(df.schema[own].dataType, DateType):
        raise TypeError(f"{day_column} is no date")
    there = spark.catalog.tableExists(table)
    order = list(place.values())
    if there:
        columns = spark.catalog.listColumns(table)
        keys = [column.name.lower() for column in columns if column.isPartition]
        if keys != [day_column.lower()]:
            raise ValueError(f"{table} is not partitioned by {day_column} alone")
        order = [column.name for column in columns if not column.isPartition]
        if sorted(name.lower() for name in order) != sorted(place):
            raise ValueError(f"{table} has other columns")
    day = F.col(f"`{own}`")
    counts = dict(observe or {})
    per_day = {f"__tapeloom_{one.isoformat()}": F.count_if(day == F.lit(one)) for one in days or ()}
    rows = df
    if days is not None:
        other = F.raise_error(F.concat(F.lit(f"{day_column} is none of the days to be written: "), F.coalesce(day.cast("string"), F.lit("NULL"))))
        rows = df.withColumn(own, F.when(day.isin(list(days)), day).otherwise(other.cast("date")))
    observation = None
    if counts or per_day:
        observation = Observation()
        rows = rows.observe(observation, *[c.alias(name) for name, c in {**counts, **per_day}.items()])
    rows = rows.select(*[F.col(f"`{name}`") for name in [*order, own]])
    if there:
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.write.options(**(options or {})).insertInto(table, overwrite=True)
    else:
        rows.write.format(format).options(**(options or {})).partitionBy(own).saveAsTable(table)
    seen = observation.get if observation else {}
    for one in days or ():
        if not seen[f"__tapeloom_{one.isoformat()}"]:
            spark.sql(f"alter table {table} drop if exists partition (`{own}` = date'{one.isoformat()}')")
    return {name: seen[name] for name in counts}


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for as long as the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _write(df, mode, format, options, observe, target, save) -> dict[str, object]:
    if not target:
        raise ValueError("no target given")
    if mode.lower() not in MODES:
        raise ValueError(f"unknown write mode: {mode}")
    observation = None
    if observe:
        observation = Observation()
        df = df.observe(observation, *[c.alias(name) for name, c in observe.items()])
    writer: DataFrameWriter = df.write.mode(mode).options(**(options or {}))
    save(writer.format(format) if format else writer)
    return observation.get if observation else {}
