"""Sources and sinks: table scans, CSV/Parquet directories, report files, models."""

from .files import read_csv, read_table, write_table
from .reports import read_report, write_report
from .tables import TABLES, load_table

__all__ = ["TABLES", "load_table", "read_csv", "read_table", "write_table",
           "read_report", "write_report"]
