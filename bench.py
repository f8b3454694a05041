"""Times the headline queries and prints one JSON line.

Text inputs are written once, before the clock starts. Each query is run three times and the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from sheaftext import parse_lines, read_delimited, write_delimited
from sheaftext.catalog.common import ORDERS, orders_line, stamp, table
from sheaftext.operators.stitch import numbered_lines, stitch_lines
from sheaftext.session import local_session, scratch_path
from sheaftext.sinks.parquet import write_partitions
from sheaftext.sources.delimited import open_files

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = local_session("bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    lineitem, orders = table(spark, SF_DIR, "lineitem"), table(spark, SF_DIR, "orders")
    text, whole, cut = (scratch_path(spark, label) for label in ("lineitem", "orders", "orders-cut"))
    write_delimited(lineitem.repartition(int(CPUS)), text, date_format="yyyy-MM-dd HH:mm:ss", header=True)
    orders.select(orders_line(";").alias("value")).write.text(whole)
    orders.select(F.regexp_replace(orders_line(";"), "^([^;]*;[^;]*;)", "$1\n").alias("value")).write.text(cut)

    def dropmalformed():
        rows = read_delimited(spark, text, LINEITEM, header=True, mode="DROPMALFORMED")
        return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)), F.sum("l_extendedprice"))

    def load_by_month():
        rows = read_delimited(spark, whole, ORDERS, delimiter=";").withColumn("month", stamp("o_orderdate", "yyyy-MM-01"))
        write_partitions(rows, scratch_path(spark, "loaded"), "month", rebalance=True)

    reading = lambda **options: read_delimited(spark, text, LINEITEM, header=True, **options)
    queries = {
        "scan_dropmalformed_aggregate": lambda: drain(dropmalformed()),
        "scan_dropmalformed": lambda: drain(reading(mode="DROPMALFORMED")),
        "scan_dropmalformed_one_column": lambda: drain(reading(mode="DROPMALFORMED").select("l_shipdate")),
        "scan_permissive": lambda: drain(reading()),
        "scan_permissive_nulls": lambda: drain(reading(on_bad_cast="null")),
        "scan_failfast": lambda: drain(reading(mode="FAILFAST")),
        "scan_legacy": lambda: drain(reading(profile="legacy")),
        "scan_quarantine": lambda: drain(open_files(spark, text, LINEITEM, header=True).good_and_rejected()[1]),
        "infer_schema": lambda: read_delimited(spark, text, header=True, infer_schema=True),
        "parse_lines_of_a_frame": lambda: drain(parse_lines(orders.select(orders_line().alias("value")), ORDERS)),
        "write_minimal": lambda: write_delimited(lineitem, scratch_path(spark, "minimal")),
        "write_non_numeric": lambda: write_delimited(lineitem, scratch_path(spark, "non-numeric"), quote_mode="NON_NUMERIC", header=True),
        "load_by_month": load_by_month,
        "stitch_records": lambda: drain(stitch_lines(numbered_lines(spark, cut))),
        "spark_csv_reader": lambda: drain(spark.read.schema(LINEITEM).option("header", True).csv(text)),
        "spark_csv_writer": lambda: lineitem.write.csv(scratch_path(spark, "plain")),
    }
    only = sys.argv[1:]
    seconds = {}
    for name, run in queries.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            taken = time.perf_counter() - start
            best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
    ours = sum(t for name, t in seconds.items() if not name.startswith("spark_"))
    print(json.dumps({"metric": "total_query_seconds", "value": round(ours, 3), "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
