"""Casts, null rules and inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaftext import parse_lines
from sheaftext.catalog.common import divides, joined, orders_line, stamp, table
from sheaftext.functions.dates import business_date, business_date_text, file_date, is_expired, retention_cutoff
from sheaftext.operators.infer import inferred_types
from sheaftext.options import ReadOptions
from sheaftext.sources.delimited import open_lines

INFERRED = ("l_orderkey", "l_linenumber", "l_extendedprice", "half", "big", "l_shipdate", "flag", "mixed", "l_returnflag", "nothing")


def infer_types(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber")
    lines = lineitem.select(
        joined(
            ",",
            "l_orderkey",
            number,
            "l_extendedprice",
            # whole on most lines, with a half on some
            F.when(number == 1, "0.5").otherwise(number.cast("string")),
            F.when(number == 1, "3000000000").otherwise(number.cast("string")),
            stamp("l_shipdate"),
            F.when(number % 2 == 0, "True").otherwise("FALSE"),
            F.when(number == 1, stamp("l_shipdate")).otherwise(number.cast("string")),
            "l_returnflag",
            F.lit(""),
        ).alias("value")
    )
    text = ", ".join(f"{name} string" for name in INFERRED)
    options = ReadOptions(timestamp_ntz=True)
    return inferred_types(open_lines(lines, text, options).tokens, list(INFERRED), options)


def infer_and_read(spark, sf_dir):
    """Types inferred from the lines, then the lines read with them and aggregated."""
    lines = table(spark, sf_dir, "orders").select(orders_line().alias("value"))
    rows = parse_lines(lines, None, infer_schema=True, timestamp_ntz=True)
    return rows.where("C3 > 250000").groupBy("C2").agg(F.count(F.lit(1)).alias("orders"), F.max("C4").alias("latest"), F.max("C0").cast("bigint").alias("top_key"))


def cast_numbers(spark, sf_dir):
    """Amounts printed with comma thousands, with decimal commas, and in a continental notation."""
    english = F.format_number("l_extendedprice", 2)
    lineitem = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    lines = lineitem.select(
        joined(",", *keys, quoted(english), quoted(F.translate(english, ".,", ",."))).alias("standard"),
        joined(";", *keys, F.translate(english, ".,", ",")).alias("legacy"),
    )
    prefix = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint"
    standard = parse_lines(lines, f"{prefix}, thousands decimal(12,2), continental double", column="standard", locale="da-DK")
    legacy = parse_lines(lines, f"{prefix}, comma decimal(12,2)", column="legacy", profile="legacy", delimiter=";")
    both = [standard.select(*keys, "thousands", F.col("continental").cast("decimal(12,2)").alias("amount")), legacy.select(*keys, F.lit(None).cast("decimal(12,2)").alias("thousands"), F.col("comma").alias("amount"))]
    return both[0].unionByName(both[1])


def cast_small_types(spark, sf_dir):
    line = joined(",", "p_size", "p_size", "p_partkey", "p_retailprice", F.when(divides("p_partkey", 2), "TRUE").otherwise("false"), "p_name")
    lines = table(spark, sf_dir, "part").select(line.alias("value"))
    return parse_lines(lines, "tiny tinyint, small smallint, p_partkey bigint, price float, even boolean, p_name string").select(
        F.col("tiny").cast("int").alias("tiny"), F.col("small").cast("int").alias("small"), "p_partkey", F.col("price").cast("decimal(10,1)").alias("price"), "even", "p_name"
    )


def cast_db2_timestamp(spark, sf_dir):
    line = joined(";", "event_id", stamp("ts", "yyyy-MM-dd-HH.mm.ss.SSSSSS"), stamp("ts", "yyyy/MM/dd-HH:mm:ss"))
    lines = table(spark, sf_dir, "events").select(line.alias("value"))
    return parse_lines(lines, "event_id bigint, dotted timestamp_ntz, slashed timestamp_ntz", profile="legacy", delimiter=";")


def cast_dates_format(spark, sf_dir):
    line = joined(",", "o_orderkey", stamp("o_orderdate", "dd/MM/yyyy HH:mm"), stamp("o_orderdate", "dd/MM/yyyy HH:mm"), stamp("o_orderdate", "ddMMyy"))
    lines = table(spark, sf_dir, "orders").select(line.alias("value"))
    rows = parse_lines(lines, "o_orderkey bigint, ordered timestamp_ntz, order_day date, odate string", date_format="dd/MM/yyyy HH:mm")
    today = F.lit("2001-08-01").cast("date")
    return rows.select(
        "o_orderkey",
        "ordered",
        "order_day",
        business_date("odate").alias("business_day"),
        business_date_text("odate").alias("business_text"),
        file_date("order_day").alias("odate"),
        retention_cutoff(F.col("order_day"), 30).alias("kept_from"),
        is_expired(F.col("order_day"), today, 365).alias("expired"),
    )


def null_lines(spark, sf_dir):
    """Customer lines whose name and balance are the word null, empty, a dash, or a value."""
    key = F.col("c_custkey")
    text = F.when(key % 4 == 0, "null").when(key % 4 == 1, "").when(key % 4 == 2, "-").otherwise(F.col("c_name"))
    number = F.when(key % 4 == 0, "null").when(key % 4 == 1, "").when(key % 4 == 2, "-").otherwise(F.col("c_acctbal").cast("string"))
    return table(spark, sf_dir, "customer").select(joined(",", "c_custkey", text, number).alias("value"))


def null_rules(spark, sf_dir):
    lines = null_lines(spark, sf_dir)
    schema = "c_custkey bigint, name string, balance double"
    variants = {
        "default": {"on_bad_cast": "null"},
        "dash": {"null_value": "-", "on_bad_cast": "null"},
        "dash_and_empty": {"null_value": "-", "treat_empty_values_as_nulls": True, "on_bad_cast": "null"},
        "legacy": {"profile": "legacy", "on_bad_cast": "null"},
    }
    frames = [parse_lines(lines, schema, **options).select(F.lit(name).alias("rule"), "*") for name, options in variants.items()]
    return frames[0].union(frames[1]).union(frames[2]).union(frames[3])


def _constant_type(position: int, name: str, expression: str, source: str = " FROM lineitem") -> str:
    return f"SELECT {position} AS position, '{name}' AS column_name, {expression} AS data_type{source}"


_INT_OR_LONG = "CASE WHEN max(l_orderkey) > 2147483647 THEN 'bigint' ELSE 'int' END"
_HAS_ONE = "CASE WHEN count(*) FILTER (l_linenumber = 1) > 0 THEN '{}' ELSE 'int' END"
_MIXED = "CASE WHEN count(*) FILTER (l_linenumber = 1) = 0 THEN 'int' WHEN count(*) FILTER (l_linenumber <> 1) = 0 THEN 'timestamp_ntz' ELSE 'string' END"

INFER_SQL = " UNION ALL ".join(
    _constant_type(i, name, expression)
    for i, (name, expression) in enumerate(
        zip(
            INFERRED,
            (
                _INT_OR_LONG,
                "CASE WHEN max(l_linenumber) > 2147483647 THEN 'bigint' ELSE 'int' END",
                "CASE WHEN count(l_extendedprice) > 0 THEN 'double' END",
                _HAS_ONE.format("double"),
                _HAS_ONE.format("bigint"),
                "CASE WHEN count(l_shipdate) > 0 THEN 'timestamp_ntz' END",
                "CASE WHEN count(l_linenumber) > 0 THEN 'boolean' END",
                _MIXED,
                "CASE WHEN count(l_returnflag) > 0 THEN 'string' END",
                "CASE WHEN count(*) > 0 THEN 'string' END",
            ),
        )
    )
)


def _null_sql(rule: str, name: str, balance: str) -> str:
    return f"SELECT '{rule}' AS rule, c_custkey, {name} AS name, {balance} AS balance FROM customer"


_BALANCE = "CASE WHEN c_custkey % 4 = 3 THEN c_acctbal END"
NULL_SQL = " UNION ALL ".join(
    [
        _null_sql("default", "CASE c_custkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN NULL WHEN 2 THEN '-' ELSE c_name END", _BALANCE),
        _null_sql("dash", "CASE c_custkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE c_name END", _BALANCE),
        _null_sql("dash_and_empty", "CASE c_custkey % 4 WHEN 0 THEN 'null' WHEN 3 THEN c_name END", _BALANCE),
        _null_sql("legacy", "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '-' ELSE c_name END", _BALANCE),
    ]
)

QUERIES = {
    "infer_types": (infer_types, INFER_SQL),
    "infer_and_read": (
        infer_and_read,
        """SELECT o_orderstatus AS "C2", count(*) AS orders, max(o_orderdate) AS latest, max(o_orderkey) AS top_key
        FROM orders WHERE o_totalprice > 250000 GROUP BY o_orderstatus""",
    ),
    "cast_numbers": (
        cast_numbers,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS thousands, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL, CAST(l_extendedprice AS DECIMAL(12,2)) FROM lineitem""",
    ),
    "cast_small_types": (
        cast_small_types,
        """SELECT p_size AS tiny, p_size AS small, p_partkey, CAST(CAST(p_retailprice AS FLOAT) AS DECIMAL(10,1)) AS price, p_partkey % 2 = 0 AS even, p_name FROM part""",
    ),
    "cast_db2_timestamp": (
        cast_db2_timestamp,
        "SELECT event_id, date_trunc('second', ts) AS dotted, date_trunc('second', ts) AS slashed FROM events",
    ),
    "cast_dates_format": (
        cast_dates_format,
        """SELECT o_orderkey, o_orderdate AS ordered, CAST(o_orderdate AS DATE) AS order_day,
        make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate)) AS business_day,
        strftime(make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate)), '%Y-%m-%d') AS business_text,
        strftime(o_orderdate, '%d%m%y') AS odate,
        CAST(o_orderdate AS DATE) - 30 AS kept_from,
        CAST(o_orderdate AS DATE) < DATE '2001-08-01' - 365 AS expired FROM orders""",
    ),
    "null_rules": (null_rules, NULL_SQL),
}
