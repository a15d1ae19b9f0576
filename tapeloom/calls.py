"""The operators under the call names and parameter names that existing notebooks use (fixed values)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom import operators, sinks, sources


def check_table_exists(spark: SparkSession, three_level_namespace: str) -> bool:
    """Whether the name resolves."""
    return sources.table_exists(spark, three_level_namespace)


def ingest_data(spark: SparkSession, source_table: str, filter_condition: str | None = None) -> DataFrame:
    """A table, with a predicate or whole."""
    return sources.read_table(spark, source_table, filter_condition)


def ingest_data_from_table(source_table: str, filter_condition: str | None = None) -> DataFrame:
    """The same in the active session."""
    return sources.read_table(SparkSession.getActiveSession(), source_table, filter_condition)


def convert_timestamp_to_date(df: DataFrame, timestamp_col: str, date_format_str: str) -> DataFrame:
    """Add ``Date``, the timestamp as formatted text."""
    return operators.format_date(df, timestamp_col, date_format_str)


def change_name_case(df: DataFrame, case: str = "upper") -> DataFrame:
    """Column names in upper or lower case."""
    return operators.name_case(df, case)


def apply_transformations(df: DataFrame, transformations: list) -> DataFrame:
    """Set columns one after the other."""
    return operators.in_order(df, transformations)


def transform_data(df: DataFrame, group_column: str, agg_column: str) -> DataFrame:
    """Sum of a column per group."""
    return operators.sum_by(df, group_column, agg_column)


def aggregate_data(df: DataFrame, groupby_cols: list, agg_col: str, alias: str) -> DataFrame:
    """Sum of values rounded up, per group."""
    return operators.ceil_sum(df, groupby_cols, agg_col, alias)


def mask_sensitive_data(df: DataFrame, sensitive_columns: list) -> DataFrame:
    """Columns replaced by a constant text."""
    return operators.mask(df, sensitive_columns)


def write_data(df: DataFrame, path: str, writing_mode: str, writing_format: str, options_dict: dict) -> None:
    """A catalog table for ``delta``, files under a path for any other format."""
    write = sinks.write_table if writing_format == "delta" else sinks.write_files
    write(df, path, writing_mode, writing_format, options_dict)
