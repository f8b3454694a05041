"""Delimited-text ingestion on PySpark DataFrames."""

from sheaftext.options import ReadOptions, WriteOptions
from sheaftext.sinks.delimited import insert_overwrite, save_with_options, write_delimited
from sheaftext.sources.delimited import (
    create_delimited_view,
    parse_lines,
    read_delimited,
    read_tsv,
    read_with_options,
    read_with_quarantine,
)

__all__ = [
    "ReadOptions",
    "WriteOptions",
    "create_delimited_view",
    "insert_overwrite",
    "parse_lines",
    "read_delimited",
    "read_tsv",
    "read_with_options",
    "read_with_quarantine",
    "save_with_options",
    "write_delimited",
]
