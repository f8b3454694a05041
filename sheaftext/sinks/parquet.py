"""Writing Parquet partitions and registering them in the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sheaftext.sinks.folders import delete_folder, file_system


def append_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Append snappy-compressed Parquet, in one folder per value of ``by``; running it twice stores the rows twice."""
    df.write.mode("append").option("compression", "snappy").partitionBy(*(by or [])).parquet(path)


def write_partitions(df: DataFrame, path: str, partition: str, replace: bool = True, rebalance: bool = False) -> None:
    """Write Parquet under ``path/partition=value``.

    With ``replace`` only the partitions present in ``df`` are replaced, so a rerun of a load leaves no doubles.
    ``rebalance`` adds one shuffle by partition value, whose large groups Spark splits and small ones it
    merges at run time; use it when a load covers many values, and leave it off for a load of one date.
    """
    rows = df.hint("rebalance", partition) if rebalance else df
    writer = rows.write.option("compression", "snappy").partitionBy(partition)
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def sql_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def quoted_table(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _spec(values: dict[str, str]) -> str:
    return ", ".join(f"`{name}` = {sql_text(value)}" for name, value in values.items())


def add_partition(spark: SparkSession, table: str, values: dict[str, str], location: str) -> None:
    """Register one partition at a location; a partition that exists already is left as it is."""
    spark.sql(f"ALTER TABLE {quoted_table(table)} ADD IF NOT EXISTS PARTITION ({_spec(values)}) LOCATION {sql_text(location)}")


def partition_folder(root: str, values: dict[str, str]) -> str:
    return "/".join([root.rstrip("/"), *(f"{name}={value}" for name, value in values.items())])


def run_folder(root: str, values: dict[str, str]) -> str:
    """A new folder for the rows of one load, inside the partition's folder; scans of ``root`` pass over its name."""
    return f"{partition_folder(root, values)}/_run-{uuid.uuid4().hex}"


def partition_location(spark: SparkSession, table: str, values: dict[str, str]) -> str | None:
    """Where the catalog has a partition, None if it has none."""
    if not spark.sql(f"SHOW PARTITIONS {quoted_table(table)} PARTITION ({_spec(values)})").limit(1).count():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)} PARTITION ({_spec(values)})")
    return next(row.data_type for row in described.collect() if row.col_name == "Location")


def publish_partition(spark: SparkSession, table: str, values: dict[str, str], location: str) -> None:
    """Make ``location``, a finished :func:`run_folder`, the partition's rows, in one step of the catalog.

    Readers see the old rows until then and the new ones afterwards. What the partition held before goes last, if
    it lies in the partition's folder: a crash on the way leaves a folder too many, never a row too few.
    """
    before = partition_location(spark, table, values)
    if before is None:
        add_partition(spark, table, values, location)
    else:
        spark.sql(f"ALTER TABLE {quoted_table(table)} PARTITION ({_spec(values)}) SET LOCATION {sql_text(location)}")
    spark.catalog.refreshTable(quoted_table(table))
    if before is None:
        return
    new, files = file_system(spark, location)
    old, home = file_system(spark, before)[0], new.getParent()
    if old == home:  # written by other means, straight into the partition's folder
        for found in files.listStatus(home):
            if not found.getPath().getName().startswith("_run-"):
                files.delete(found.getPath(), True)
    elif old.getParent() == home and old != new:
        delete_folder(spark, before)


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    """Whether the catalog holds the table; names are compared in lower case."""
    return spark.catalog.tableExists(f"{quoted_table(database.lower())}.{quoted_table(table.lower())}")
