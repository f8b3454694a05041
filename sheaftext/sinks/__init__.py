"""Sinks: delimited text and partitioned Parquet."""
