"""Readers for the raw feeds and reference files, and table sinks."""

from wattframe.sources.files import read_csv, read_csv_columns, read_feed_json, read_parquet_table
from wattframe.sources.sinks import write_csv, write_days, write_json_lines, write_table

__all__ = [
    "read_csv",
    "read_csv_columns",
    "read_feed_json",
    "read_parquet_table",
    "write_csv",
    "write_days",
    "write_json_lines",
    "write_table",
]
