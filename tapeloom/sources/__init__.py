"""Reading tables."""

from tapeloom.sources.dated import days_in, read_dated
from tapeloom.sources.tables import read_table, sql_query, table_exists

__all__ = ["days_in", "read_dated", "read_table", "sql_query", "table_exists"]
