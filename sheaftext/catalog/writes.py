"""Sinks: quoting modes, null and date text, codecs, save modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaftext import create_delimited_view, insert_overwrite, read_delimited, write_delimited
from sheaftext.catalog.common import CUSTOMER, table
from sheaftext.options import CODECS
from sheaftext.session import scratch_path


def _event_texts(spark, sf_dir):
    """Events with a delimiter, quotes and nulls in their text columns."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 4 != 0, F.concat("event_type", F.lit(", "), F.col("user_id").cast("string"))).alias("label"),
        "props",
    )


def _written_lines(spark, df, label, **options):
    path = scratch_path(spark, label)
    write_delimited(df, path, **options)
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_non_numeric(spark, sf_dir):
    return _written_lines(spark, _event_texts(spark, sf_dir), "non-numeric", quote_mode="NON_NUMERIC")


def write_quote_all(spark, sf_dir):
    return _written_lines(spark, _event_texts(spark, sf_dir), "quote-all", quote_mode="ALL")


def write_quote_minimal(spark, sf_dir):
    return _written_lines(spark, _event_texts(spark, sf_dir), "quote-minimal")


def write_quote_none(spark, sf_dir):
    return _written_lines(spark, _event_texts(spark, sf_dir), "quote-none", quote_mode="NONE", escape="\\")


def write_null_and_date_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    dated = orders.select(
        "o_orderkey",
        "o_orderdate",
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")).alias("sometimes"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("status"),
    )
    return _written_lines(spark, dated, "null-dates")


def write_custom_dates(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.col("ts").cast("date").alias("day"))
    return _written_lines(spark, events, "custom-dates", date_format="MM/dd/yyyy HH:mm:ss", delimiter="|", null_value="-")


def write_headers(spark, sf_dir):
    """Non-numeric quoting with a header in every part file, also of an empty first part and under a record limit, read back under that header."""
    path, texts = scratch_path(spark, "headers"), _event_texts(spark, sf_dir)
    write_delimited(texts.limit(0).unionByName(texts), path, quote_mode="NON_NUMERIC", header=True, max_records_per_file=500)
    return read_delimited(spark, path, "event_id bigint, value double, label string, props string", header=True, null_value="null")


def write_compressed(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    frames = []
    for codec in CODECS:
        path = scratch_path(spark, codec)
        write_delimited(customer, path, codec=codec.upper(), header=True)
        back = read_delimited(spark, path, CUSTOMER, header=True)
        frames.append(back.select(F.lit(codec).alias("codec"), "*"))
    return frames[0].union(frames[1]).union(frames[2]).union(frames[3])


def write_save_modes(spark, sf_dir):
    """Overwritten once, ignored once, appended once: the rows of the second and the last write."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    first, second = supplier.selectExpr("s_suppkey AS id", "s_name AS name"), customer.selectExpr("c_custkey AS id", "c_name AS name")
    path = scratch_path(spark, "save-modes")
    write_delimited(first, path, header=True)
    write_delimited(second, path, header=True, save_mode="overwrite")
    write_delimited(first, path, header=True, save_mode="ignore")
    write_delimited(first, path, header=True, save_mode="append")
    return read_delimited(spark, path, "id bigint, name string", header=True)


def insert_overwrite_csv(spark, sf_dir):
    path = scratch_path(spark, "insert")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    customer = table(spark, sf_dir, "customer")
    write_delimited(customer.where("c_custkey < 0"), path, header=True)
    create_delimited_view(spark, name, path, CUSTOMER, header=True, writable=True, on_bad_cast="null")
    source = f"{name}_source"
    customer.createOrReplaceTempView(source)
    spark.sql(f"INSERT OVERWRITE TABLE `{name}` SELECT * FROM `{source}`")
    # once more, by the rows of the table itself
    insert_overwrite(read_delimited(spark, path, CUSTOMER, header=True), path, header=True)
    spark.catalog.refreshTable(name)
    return spark.table(name)


_VALUE = "CASE WHEN event_id % 3 <> 0 THEN CAST(value AS VARCHAR) ELSE {} END"
_LABEL = "CASE WHEN event_id % 4 <> 0 THEN {} ELSE {} END"
_TEXT = "event_type || ', ' || CAST(user_id AS VARCHAR)"
_QUOTED_PROPS = "'\"' || replace(props, '\"', '\"\"') || '\"'"
_QUOTED_LABEL = _LABEL.format(f"'\"' || {_TEXT} || '\"'", "'\"null\"'")


def _line_sql(*parts: str) -> str:
    return "SELECT " + " || ',' || ".join(parts) + " AS line FROM events"


QUERIES = {
    "write_non_numeric": (
        write_non_numeric,
        _line_sql("CAST(event_id AS VARCHAR)", _VALUE.format("'\"null\"'"), _QUOTED_LABEL, _QUOTED_PROPS),
    ),
    "write_quote_all": (
        write_quote_all,
        _line_sql(
            "'\"' || CAST(event_id AS VARCHAR) || '\"'",
            "CASE WHEN event_id % 3 <> 0 THEN '\"' || CAST(value AS VARCHAR) || '\"' ELSE '\"null\"' END",
            _QUOTED_LABEL,
            _QUOTED_PROPS,
        ),
    ),
    "write_quote_minimal": (
        write_quote_minimal,
        _line_sql(
            "CAST(event_id AS VARCHAR)", _VALUE.format("'null'"), _LABEL.format(f"'\"' || {_TEXT} || '\"'", "'null'"), _QUOTED_PROPS
        ),
    ),
    "write_quote_none": (
        write_quote_none,
        _line_sql(
            "CAST(event_id AS VARCHAR)",
            _VALUE.format("'null'"),
            _LABEL.format("event_type || '\\, ' || CAST(user_id AS VARCHAR)", "'null'"),
            "replace(props, ',', '\\,')",
        ),
    ),
    "write_null_and_date_text": (
        write_null_and_date_text,
        """SELECT CAST(o_orderkey AS VARCHAR) || ',' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.0') || ',' || strftime(o_orderdate, '%Y-%m-%d 00:00:00.0') || ','
        || CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.0') ELSE 'null' END || ','
        || CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'null' END AS line FROM orders""",
    ),
    "write_custom_dates": (
        write_custom_dates,
        "SELECT CAST(event_id AS VARCHAR) || '|' || strftime(ts, '%m/%d/%Y %H:%M:%S') || '|' || strftime(ts, '%m/%d/%Y 00:00:00') AS line FROM events",
    ),
    "write_headers": (
        write_headers,
        f"SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value, CASE WHEN event_id % 4 <> 0 THEN {_TEXT} END AS label, props FROM events",
    ),
    "write_compressed": (
        write_compressed,
        "SELECT codec, customer.* FROM customer CROSS JOIN (SELECT unnest(['bzip2', 'gzip', 'lz4', 'snappy']) AS codec)",
    ),
    "write_save_modes": (
        write_save_modes,
        "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
    ),
    "insert_overwrite_csv": (insert_overwrite_csv, "SELECT * FROM customer"),
}
