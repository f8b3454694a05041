"""Shared pieces of the query catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(delimiter: str, *parts) -> Column:
    """Columns as one line of text; timestamps in full."""
    return F.concat_ws(delimiter, *parts)


def stamp(column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(column, pattern)


def orders_line(delimiter: str = ",") -> Column:
    return joined(delimiter, "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", stamp("o_orderdate"), "o_orderpriority")


def divides(key: str, n: int) -> Column:
    return F.col(key) % n == 0
