"""Operators for training-data pipelines. Nothing outside this folder imports it except ``__spark_entry__.py``."""
