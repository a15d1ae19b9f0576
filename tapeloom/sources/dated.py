"""Folders named by day, as one table with a column of the day."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom.sinks import folders
from tapeloom.sinks.writers import dated_path

# The folder a file is in.
_DAY_OF_FILE = r"/(\d{4}-\d{2}-\d{2})/[^/]+$"


def days_in(spark: SparkSession, root: str) -> list[date]:
    """The days that have a folder ``<root>/yyyy-MM-dd``, in order; other names are passed over."""
    found = []
    for name in folders.names(spark, root):
        try:
            day = date.fromisoformat(name)
        except ValueError:
            continue
        if day.isoformat() == name:
            found.append(day)
    return found


def read_dated(
    spark: SparkSession,
    root: str,
    predicate: str | None = None,
    format: str = "parquet",
    schema: StructType | str | None = None,
    options: Mapping[str, object] | None = None,
    day_column: str = "day",
) -> DataFrame:
    """The rows of all day folders below ``root`` with their day as a column, or of the days that meet ``predicate``.

    ``predicate`` is SQL on the day column alone, such as ``day between '2024-01-01' and '2024-01-31'``. It is
    held against the names of the folders, and the scan lists no file of any other day. All days are one
    scan, however many; their folders hold files, no folders of partitions. With no such day the result is
    empty, for which ``schema`` must be given.
    """
    listed = spark.createDataFrame([(day,) for day in days_in(spark, root)], f"`{day_column}` date")
    chosen = sorted(row[0] for row in (listed.where(predicate) if predicate else listed).collect())
    if not chosen and schema is None:
        raise ValueError(f"{root} has no folder of such a day, and no schema is given")
    reader = spark.read.format(format).options(**(options or {}))
    reader = reader.schema(schema) if schema is not None else reader
    if chosen:
        rows = reader.load([dated_path(root, day) for day in chosen])
        day = F.to_date(F.regexp_extract("_metadata.file_path", _DAY_OF_FILE, 1), "yyyy-MM-dd")
    else:
        rows = spark.createDataFrame([], schema)
        day = F.lit(None).cast("date")
    if day_column.lower() in {name.lower() for name in rows.columns}:
        raise ValueError(f"rows have a column {day_column}; name another day_column")
    return rows.withColumn(day_column, day)
