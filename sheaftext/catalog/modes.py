"""Malformed rows, stitching and split-and-cast."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext import create_delimited_view, parse_lines
from sheaftext.catalog.common import ORDERS, divides, joined, orders_line, stamp, table
from sheaftext.operators.split_cast import split_and_cast
from sheaftext.operators.stitch import numbered_lines, stitch_lines
from sheaftext.session import scratch_path
from sheaftext.sources.delimited import open_lines


def damaged_orders(spark, sf_dir):
    """Order lines of which some lack fields, have too many, hold a bad number, or never close a quote."""
    whole = orders_line()
    short = joined(",", "o_orderkey", "o_custkey", "o_orderstatus")
    bad = joined(",", "o_orderkey", "o_custkey", "o_orderstatus", F.lit("n/a"), stamp("o_orderdate"), "o_orderpriority")
    line = (
        F.when(divides("o_orderkey", 7), short)
        .when(divides("o_orderkey", 11), joined(",", whole, F.lit("x"), F.lit("")))
        .when(divides("o_orderkey", 13), bad)
        .when(divides("o_orderkey", 17), joined(",", short, F.concat(F.lit('"'), "o_orderpriority")))
        .otherwise(whole)
    )
    return table(spark, sf_dir, "orders").select(line.alias("value"))


def mode_permissive(spark, sf_dir):
    return parse_lines(damaged_orders(spark, sf_dir), ORDERS, on_bad_cast="null")


def mode_dropmalformed(spark, sf_dir):
    rows = parse_lines(damaged_orders(spark, sf_dir), ORDERS, mode="DROPMALFORMED")
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(22,2)").alias("total")
    )


def mode_dropmalformed_rows(spark, sf_dir):
    return parse_lines(damaged_orders(spark, sf_dir), ORDERS, mode="DROPMALFORMED")


def csv_view_dropmalformed(spark, sf_dir):
    """The same rows from SQL, over files."""
    path = scratch_path(spark, "damaged-orders")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    damaged_orders(spark, sf_dir).write.text(path)
    create_delimited_view(spark, name, path, ORDERS, mode="DROPMALFORMED")
    return spark.sql(f"SELECT * FROM `{name}`")


def mode_dropmalformed_one_column(spark, sf_dir):
    return parse_lines(damaged_orders(spark, sf_dir), ORDERS, mode="DROPMALFORMED").select("o_orderpriority")


def mode_dropmalformed_count(spark, sf_dir):
    return parse_lines(damaged_orders(spark, sf_dir), ORDERS, mode="DROPMALFORMED").agg(F.count(F.lit(1)).alias("orders"))


def mode_failfast_clean(spark, sf_dir):
    lines = table(spark, sf_dir, "orders").select(orders_line().alias("value"))
    return parse_lines(lines, ORDERS, mode="FAILFAST")


def mode_quarantine(spark, sf_dir):
    good, rejected = open_lines(damaged_orders(spark, sf_dir), ORDERS).good_and_rejected()
    counted = rejected.groupBy("reason", "bad_column", "token_count").agg(F.count(F.lit(1)).alias("lines"))
    kept = good.agg(F.lit("kept").alias("reason"), F.lit(None).cast("string").alias("bad_column"), F.lit(6).alias("token_count"), F.count(F.lit(1)).alias("lines"))
    return counted.unionByName(kept)


def mode_quarantine_lines(spark, sf_dir):
    rejected = open_lines(damaged_orders(spark, sf_dir), ORDERS).good_and_rejected()[1]
    return rejected.select(F.split_part(F.col("line"), F.lit(","), F.lit(1)).cast("bigint").alias("o_orderkey"), "reason")


def split_cast_lines(spark, sf_dir):
    comma = lambda c: F.translate(F.format_number(c, 2), ".,", ",")
    lines = table(spark, sf_dir, "lineitem").select(
        joined(
            ";",
            "l_orderkey",
            "l_linenumber",
            F.concat(F.lit('"'), "l_returnflag", F.lit('"')),
            comma("l_extendedprice"),
            comma("l_discount"),
            stamp("l_shipdate", "yyyy-MM-dd"),
            stamp("l_shipdate", "yyyy-MM-dd-HH.mm.ss.SSSSSS"),
        ).alias("value")
    )
    schema = T.StructType.fromDDL(
        "l_orderkey bigint, l_linenumber int, l_returnflag string, price decimal(12,2), discount decimal(4,2), shipdate date, shipped timestamp_ntz"
    )
    return split_and_cast(lines, schema)


def stitch_records(spark, sf_dir):
    """Order records cut in two inside their fields, written to files, read in file order and re-joined."""
    path = scratch_path(spark, "orders-cut")
    head = F.concat(joined(";", "o_orderkey", "o_custkey", "o_orderstatus"), F.lit(";"))
    tail = joined(";", "o_totalprice", stamp("o_orderdate"), "o_orderpriority")
    cut = F.when(divides("o_orderkey", 3), F.concat(head, tail)).otherwise(F.concat(head, F.lit("\n"), tail))
    table(spark, sf_dir, "orders").select(cut.alias("value")).write.text(path)
    whole = stitch_lines(numbered_lines(spark, path), block_bits=10)
    return parse_lines(whole, ORDERS, delimiter=";")


KEPT = "o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0"
REASONS = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'too_few_tokens' WHEN o_orderkey % 11 = 0 THEN 'too_many_tokens'
    WHEN o_orderkey % 13 = 0 THEN 'bad_value' WHEN o_orderkey % 17 = 0 THEN 'unbalanced_quote' ELSE 'kept' END AS reason FROM orders"""

def mode_dropmalformed_numbers(spark, sf_dir):
    """No text column at all: whole numbers, a boolean and a decimal, one value in seven unfit."""
    number = F.when(divides("l_orderkey", 7), F.lit("none")).otherwise(F.col("l_linenumber").cast("string"))
    even = (F.col("l_partkey") % 2 == 0).cast("string")
    line = joined(",", "l_orderkey", "l_partkey", number, even, F.col("l_quantity").cast("decimal(12,2)").cast("string"))
    schema = "l_orderkey bigint, l_partkey bigint, l_linenumber int, even boolean, l_quantity decimal(12,2)"
    rows = parse_lines(table(spark, sf_dir, "lineitem").select(line.alias("value")), schema, mode="DROPMALFORMED")
    return rows.withColumn("l_quantity", F.col("l_quantity").cast("double"))


QUERIES = {
    "mode_dropmalformed_numbers": (
        mode_dropmalformed_numbers,
        """SELECT l_orderkey, l_partkey, l_linenumber, l_partkey % 2 = 0 AS even, CAST(l_quantity AS DOUBLE) AS l_quantity
        FROM lineitem WHERE l_orderkey % 7 <> 0""",
    ),
    "mode_permissive": (
        mode_permissive,
        """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderkey % 7 = 0 OR (o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0) THEN NULL ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
        FROM orders WHERE o_orderkey % 17 <> 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0""",
    ),
    "mode_dropmalformed": (
        mode_dropmalformed,
        f"SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total FROM orders WHERE {KEPT} GROUP BY o_orderstatus",
    ),
    "mode_dropmalformed_rows": (mode_dropmalformed_rows, f"SELECT * FROM orders WHERE {KEPT}"),
    "csv_view_dropmalformed": (csv_view_dropmalformed, f"SELECT * FROM orders WHERE {KEPT}"),
    "mode_dropmalformed_one_column": (mode_dropmalformed_one_column, f"SELECT o_orderpriority FROM orders WHERE {KEPT}"),
    "mode_dropmalformed_count": (mode_dropmalformed_count, f"SELECT count(*) AS orders FROM orders WHERE {KEPT}"),
    "mode_failfast_clean": (mode_failfast_clean, "SELECT * FROM orders"),
    "mode_quarantine": (
        mode_quarantine,
        f"""SELECT reason, CASE WHEN reason = 'bad_value' THEN 'o_totalprice' END AS bad_column,
        CAST(CASE reason WHEN 'too_few_tokens' THEN 3 WHEN 'bad_value' THEN 6 WHEN 'kept' THEN 6 END AS INTEGER) AS token_count, count(*) AS lines
        FROM ({REASONS}) GROUP BY reason""",
    ),
    "mode_quarantine_lines": (mode_quarantine_lines, f"SELECT * FROM ({REASONS}) WHERE reason <> 'kept'"),
    "split_cast_lines": (
        split_cast_lines,
        """SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
        CAST(l_discount AS DECIMAL(4,2)) AS discount, CAST(l_shipdate AS DATE) AS shipdate, l_shipdate AS shipped FROM lineitem""",
    ),
    "stitch_records": (stitch_records, "SELECT * FROM orders"),
}
