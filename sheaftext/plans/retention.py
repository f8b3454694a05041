"""Dropping load-date partitions that have outlived their retention."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaftext.functions.dates import is_expired
from sheaftext.operators.schema_docs import LOAD_DATE_COLUMN
from sheaftext.sinks.folders import delete_folder, file_system
from sheaftext.sinks.parquet import quoted_table, sql_text

log = logging.getLogger(__name__)


def with_expiry(rows: DataFrame, day: str, today: Column, days: int | Column) -> DataFrame:
    """Mark rows (or partitions) older than ``today`` minus ``days`` as expired."""
    return rows.withColumn("expired", is_expired(F.col(day), today, days))


def retained(rows: DataFrame, day: str, today: Column, days: int | Column) -> DataFrame:
    return rows.where(~is_expired(F.col(day), today, days))


def partition_dates(spark: SparkSession, table: str, column: str = LOAD_DATE_COLUMN) -> DataFrame:
    """The partition values of a table partitioned by one date column."""
    listed = spark.sql(f"SHOW PARTITIONS {quoted_table(table)}")
    return listed.select(F.split_part(F.col("partition"), F.lit("="), F.lit(2)).alias(column))


def purge(spark: SparkSession, table: str, today: Column, days: int, column: str = LOAD_DATE_COLUMN, root: str | None = None, dry_run: bool = False) -> list[str]:
    """Drop every expired partition in one statement and return their dates.

    Dropping a partition of a managed table deletes its files. For an external table give its ``root``: the
    folders ``root/column=date`` are then deleted too, also those that the catalog does not know. ``dry_run`` only
    reports. A partition whose value is no date stays and is logged. The list is one entry per load date.
    """
    dates = partition_dates(spark, table, column)
    if root is not None:
        dates = dates.union(spark.createDataFrame([(day,) for day in _folder_dates(spark, root, column)], dates.schema)).distinct()
    marked = with_expiry(dates, column, today, days).withColumn("odd", F.col(column).try_cast("date").isNull())
    found = marked.where("expired or odd").orderBy(column).collect()
    expired = [row[column] for row in found if row["expired"]]
    for row in found:
        if row["odd"]:
            log.warning("%s: partition %s=%s is no date and stays", table, column, row[column])
    if not expired or dry_run:
        return expired
    specs = ", ".join(f"PARTITION (`{column}` = {sql_text(day)})" for day in expired)
    spark.sql(f"ALTER TABLE {quoted_table(table)} DROP IF EXISTS {specs}")
    if root is not None:
        for day in expired:
            delete_folder(spark, f"{root.rstrip('/')}/{column}={day}")
    return expired


def _folder_dates(spark: SparkSession, root: str, column: str) -> list[str]:
    """The values in the names of the folders ``root/column=value``, registered or not."""
    target, files = file_system(spark, root)
    if not files.exists(target):
        return []
    names = [found.getPath().getName() for found in files.listStatus(target) if found.isDirectory()]
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")]
