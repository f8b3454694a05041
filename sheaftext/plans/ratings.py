"""Loading ratings text into a dated Parquet partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sheaftext.sinks.folders import delete_folder, exists, make_folder, replace_folder
from sheaftext.sinks.parquet import partition_folder, publish_partition, run_folder
from sheaftext.sources.ratings import RATING_COLUMNS, read_ratings

REJECTED = "rejected"


def load_ratings(spark: SparkSession, source: str | list[str], save_path: str, table: str, day: str) -> int:
    """Load the ratings of one day in one pass and return the number of short lines.

    Complete ratings become the partition ``data=day``, in a folder of that day; short lines are kept beside them, by day, see
    :func:`rejected_ratings`. A rerun replaces both. A load that raises leaves both as they were.
    """
    partition, seen = {"data": day}, Observation()
    ratings = read_ratings(spark, source).observe(seen, F.count_if("is_short").alias("short"))
    written = run_folder(save_path, partition)
    try:
        ratings.write.option("compression", "snappy").partitionBy("is_short").parquet(written)
        location = f"{written}-ratings"
        replace_folder(spark, f"{written}/is_short=false", location)
        make_folder(spark, location)  # also when no rating is complete
        publish_partition(spark, table.lower(), partition, location)
        replace_folder(spark, f"{written}/is_short=true", partition_folder(f"{save_path.rstrip('/')}/{REJECTED}", partition))
    finally:
        delete_folder(spark, written)
    return seen.get["short"]


def rejected_ratings(spark: SparkSession, save_path: str) -> DataFrame:
    """The short lines of all loads into ``save_path``, as they came, with their day."""
    schema = ", ".join(f"{name} string" for name in (*RATING_COLUMNS, "line")) + ", data string"
    root = f"{save_path.rstrip('/')}/{REJECTED}"
    if not exists(spark, root):
        return spark.createDataFrame([], schema).select("line", "data")
    return spark.read.schema(schema).parquet(root).select("line", "data")
