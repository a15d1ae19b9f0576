"""Writing tables and files."""

from tapeloom.sinks.judged import Refused, write_judged
from tapeloom.sinks.writers import dated_path, write_days, write_files, write_table

__all__ = ["Refused", "dated_path", "write_days", "write_files", "write_judged", "write_table"]
