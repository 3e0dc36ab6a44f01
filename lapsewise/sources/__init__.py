"""Readers and writers of logs, feature tables and report tables."""

from lapsewise.sources.activity import activity_log
from lapsewise.sources.tables import (
    read_csv_table,
    read_feature_table,
    read_json_log,
    read_parquet_log,
    unreadable_lines,
    write_csv_table,
    write_json_table,
    write_parquet_table,
)

__all__ = [
    "activity_log",
    "read_csv_table",
    "read_feature_table",
    "read_json_log",
    "read_parquet_log",
    "unreadable_lines",
    "write_csv_table",
    "write_json_table",
    "write_parquet_table",
]
