"""Tables by name, with or without a predicate."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Spark's error conditions for a catalog or namespace that is not there.
_NOT_THERE = {
    "REQUIRES_SINGLE_PART_NAMESPACE",
    "CATALOG_NOT_FOUND",
    "SCHEMA_NOT_FOUND",
    "TABLE_OR_VIEW_NOT_FOUND",
}


def read_table(spark: SparkSession, name: str, predicate: str | None = None) -> DataFrame:
    """Scan a table; a predicate is pushed to the scan. ``None`` and ``""`` mean every row."""
    table = spark.read.table(name)
    return table.where(predicate) if predicate else table


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the name resolves; an unknown catalog or schema is a plain no."""
    try:
        return spark.catalog.tableExists(name)
    except AnalysisException as error:
        if error.getCondition() in _NOT_THERE:
            return False
        raise


def sql_query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` in it stands for a DataFrame passed by that name."""
    return spark.sql(text, **tables)
