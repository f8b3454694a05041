"""Casts, null rules and dates."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compare import rows
from sheaftext import parse_lines
from sheaftext.functions import casts
from sheaftext.functions.dates import business_date, business_date_text, file_date, is_expired, retention_cutoff
from sheaftext.operators.split_cast import split_and_cast


def one(spark, column):
    return spark.range(1).select(column).head()[0]


def lines_of(spark, *lines):
    return spark.createDataFrame([(l,) for l in lines], "value string")


def test_whole_numbers_are_strict(spark):
    cast = lambda text: one(spark, casts.to_integral(F.lit(text), T.IntegerType()))
    assert [cast(t) for t in ("10", "-7", "+7", " 5", "5 ", "5.0", "", "x", "2147483648")] == [10, -7, 7, None, None, None, None, None, None]


def test_floating_locales(spark):
    cast = lambda text, locale: one(spark, casts.to_floating(F.lit(text), T.DoubleType(), locale))
    assert cast("1.00", "en") == 1.0 and cast("41,307.25", "en") == 41307.25
    assert cast("1,00", "fr-FR") == 1.0 and cast("1 234,5", "fr") == 1234.5
    assert cast("1.234,56", "pt-BR") == 1234.56 and cast("10.5", "pt-BR") == 10.5 and cast("1.234.567", "de") == 1234567.0
    assert cast("x", "pt") is None
    assert cast("1,234.5", "es-MX") == 1234.5 and cast("1’234.5", "de_CH") == 1234.5 and cast("1.234,5", "es-ES") == 1234.5
    # locales that no list names: the marks come from the JVM
    assert cast("1\u00a0234,5", "sv-SE") == 1234.5 and cast("1.234,5", "da-DK") == 1234.5 and cast("1.234,5", "tr") == 1234.5 and cast("1’234.5", "rm-CH") == 1234.5
    with pytest.raises(ValueError, match="pt-XX"):
        cast("1", "pt-XX")


@pytest.mark.parametrize("zone, text", [("America/New_York", "2021-03-14 02:30:00"), ("America/Sao_Paulo", "2018-11-04 00:15:00")])
def test_times_without_zone_do_not_depend_on_the_session(spark, zone, text, tmp_path):
    """Wall-clock times that the session zone skips, parsed and written."""
    from sheaftext import write_delimited
    from sheaftext.operators.split_cast import cast_piece

    before, ntz = spark.conf.get("spark.sql.session.timeZone"), T.TimestampNTZType()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        shown = lambda column: spark.range(1).select(column.cast("string")).head()[0]
        day, clock = text.split(" ")
        compact = f"{day}-{clock.replace(':', '.')}"
        assert shown(casts.to_timestamp(F.lit(text), ntz, "yyyy-MM-dd HH:mm:ss")) == text
        assert shown(casts.to_timestamp(F.lit(text.replace(clock, "12:05:00")), ntz, "yyyy-MM-dd hh:mm:ss")) == f"{day} 00:05:00"
        assert shown(casts.to_compact_timestamp(F.lit(compact + ".123456"), ntz)) == text
        assert shown(cast_piece(F.lit(compact + ".123456"), ntz)) == text + ".123456"
        assert shown(casts.to_timestamp(F.lit("no time"), ntz, "yyyy-MM-dd HH:mm:ss")) is None
        frame = spark.range(1).select(F.expr(f"TIMESTAMP_NTZ'{text}'").alias("t"))
        for mode in ("ALL", "NON_NUMERIC"):
            write_delimited(frame, str(tmp_path / mode), date_format="dd/MM/yyyy HH:mm:ss", quote_mode=mode)
            written = "/".join(reversed(day.split("-"))) + " " + clock
            assert [r[0] for r in spark.read.text(str(tmp_path / mode)).collect()] == [f'"{written}"']
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_boolean(spark):
    cast = lambda text: one(spark, casts.to_boolean(F.lit(text)))
    assert [cast(t) for t in ("true", "FALSE", "t", "yes", "1")] == [True, False, None, None, None]


def test_decimals(spark):
    cast = lambda text, profile: one(spark, casts.to_decimal(F.lit(text), T.DecimalType(20, 3), profile))
    assert [cast(t, "standard") for t in ("7.25", "3,406.5", "91,002,118.75")] == [Decimal("7.250"), Decimal("3406.500"), Decimal("91002118.750")]
    assert cast("10,5", "legacy") == Decimal("10.500") and cast("1.234,5", "legacy") is None


def test_compact_timestamps(spark):
    cast = lambda text: one(spark, casts.to_compact_timestamp(F.lit(text)))
    whole = datetime(2019, 6, 19, 10, 11, 12)
    assert cast("2019-06-19-10.11.12.123456") == whole
    assert cast("20190619101112") == whole and cast("2019/06/19-10:11:12") == whole
    assert cast("2019-06-19 10:11:12") == whole
    assert cast("2019-06-19") is None


def test_timestamps_and_dates_are_strict(spark):
    stamp = lambda text: one(spark, casts.to_timestamp(F.lit(text)))
    assert stamp("2015-01-01 00:00:00") == datetime(2015, 1, 1) and stamp("2015-1-1 1:2:3.5") == datetime(2015, 1, 1, 1, 2, 3, 500000)
    assert stamp("2015") is None and stamp("2015-01-01") is None and stamp("2015-01-01T00:00:00") is None
    day = lambda text: one(spark, casts.to_date(F.lit(text)))
    assert day("2015-01-01") == date(2015, 1, 1) and day("2015") is None


def test_patterns(spark):
    stamp = lambda text, pattern: one(spark, casts.to_timestamp(F.lit(text), pattern=pattern))
    assert stamp("17/09/2022 00:00", "dd/MM/yyyy hh:mm") == datetime(2022, 9, 17)
    assert stamp("17/09/2022 18:30", "dd/MM/yyyy hh:mm") == datetime(2022, 9, 17, 18, 30)
    assert stamp("17/09/2022 12:30", "dd/MM/yyyy hh:mm") == datetime(2022, 9, 17, 0, 30)
    assert stamp("17/09/2022 12:30 PM", "dd/MM/yyyy hh:mm a") == datetime(2022, 9, 17, 12, 30)
    assert stamp("2015", "yyyy") == datetime(2015, 1, 1)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "decimal(5,2)", "timestamp", "date", "string"])
def test_null_text_in_every_type(spark, kind):
    assert rows(parse_lines(lines_of(spark, "-,k"), f"v {kind}, k string", null_value="-")) == [(None, "k")]
    assert rows(parse_lines(lines_of(spark, ",k"), f"v {kind}, k string")) == [(None, "k")]
    assert rows(parse_lines(lines_of(spark, "null,k"), f"v {kind}, k string", profile="legacy")) == [(None, "k")]


NAMED = T.StructType([T.StructField("tree", T.StringType(), False), T.StructField("rings", T.IntegerType(), True)])


@pytest.mark.parametrize("text, null", [("null", "null"), ("\\N", "\\N"), ("", "")])
def test_columns_that_are_not_nullable_keep_the_text(spark, text, null):
    lines = lines_of(spark, f"{text},7", "oak,120", f"elm,{text}")
    assert set(rows(parse_lines(lines, NAMED, null_value=null))) == {(text, 7), ("oak", 120), ("elm", None)}


def test_empty_in_a_number_that_is_not_nullable(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("k", T.StringType())])
    with pytest.raises(Exception, match="does not fit type int"):
        parse_lines(lines_of(spark, ",k"), schema).collect()
    assert parse_lines(lines_of(spark, ",k", "1,k"), schema, mode="DROPMALFORMED").count() == 1


def test_empty_values_as_nulls(spark):
    lines = lines_of(spark, "a,,")
    schema = "k string, s string, n int"
    assert rows(parse_lines(lines, schema, null_value="-", treat_empty_values_as_nulls=True)) == [("a", None, None)]
    assert rows(parse_lines(lines, schema, null_value="-", on_bad_cast="null")) == [("a", "", None)]
    assert rows(parse_lines(lines, schema, profile="legacy")) == [("a", "", None)]


def test_split_and_cast(spark):
    schema = T.StructType.fromDDL("s string, i int, d decimal(8,2), day date, ts timestamp_ntz")
    lines = lines_of(spark, '"a b";12;1234,5;2019-06-19;"2019-06-19-10.11.12.120000"', "x;y", 'p;3;1,0;20190619;2019-06-19-10.11.12;extra')
    assert rows(split_and_cast(lines, schema)) == [
        ("a b", 12, Decimal("1234.50"), date(2019, 6, 19), datetime(2019, 6, 19, 10, 11, 12, 120000)),
        ("x", None, None, None, None),
        ("p", 3, Decimal("1.00"), date(2019, 6, 19), datetime(2019, 6, 19, 10, 11, 12)),
    ]


def test_business_dates(spark):
    assert one(spark, business_date(F.lit("190616"))) == date(2016, 6, 19)
    assert one(spark, business_date_text(F.lit("010199"), 19)) == "1999-01-01"
    assert one(spark, business_date(F.lit("320199"))) is None and one(spark, business_date(F.lit("1"))) is None
    assert one(spark, file_date(F.lit("2016-06-19").cast("date"))) == "190616"
    today = F.lit("2016-06-19").cast("date")
    assert one(spark, retention_cutoff(today, 10)) == date(2016, 6, 9)
    assert [one(spark, is_expired(F.lit(d), today, 10)) for d in ("2016-06-08", "2016-06-09")] == [True, False]
