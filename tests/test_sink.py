"""Writing delimited text."""

import gzip
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compare import rows
from sheaftext import WriteOptions, create_delimited_view, insert_overwrite, read_delimited, save_with_options, write_delimited


def test_header_in_every_file_whatever_the_row_limit(spark, tmp_path):
    path = tmp_path / "limited"
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        write_delimited(spark.range(0, 10, 1, 2), str(path), header=True, quote_mode="NON_NUMERIC")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    files = [p.read_text().splitlines() for p in path.glob("part-*")]
    assert sum(len(f) - 1 for f in files) == 10 and all(f[0] == '"id"' for f in files)


def texts(path):
    return [p.read_text() for p in sorted(Path(path).glob("part-*"))]


def lines(path):
    return [line for text in texts(path) for line in text.splitlines()]


@pytest.fixture
def people(spark):
    data = [(1, "Ann", 1.5, True), (2, 'say "x", y', None, False), (3, None, -2.0, None), (4, "", 0.0, True)]
    return spark.createDataFrame(data, "id int, name string, score double, ok boolean").coalesce(1)


SCHEMA = "id int, name string, score double, ok boolean"


def test_minimal(people, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(people, path, header=True)
    assert lines(path) == ["id,name,score,ok", "1,Ann,1.5,true", '2,"say ""x"", y",null,false', "3,null,-2.0,null", '4,"",0.0,true']


def test_all(people, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(people, path, header=True, quote_mode="ALL")
    assert lines(path)[:3] == ['"id","name","score","ok"', '"1","Ann","1.5","true"', '"2","say ""x"", y","null","false"']


def test_non_numeric(people, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(people, path, header=True, quote_mode="non_numeric")
    assert lines(path) == [
        '"id","name","score","ok"',
        '1,"Ann",1.5,"true"',
        '2,"say ""x"", y","null","false"',
        '3,"null",-2.0,"null"',
        '4,"",0.0,"true"',
    ]


def test_none_escapes_and_needs_an_escape(people, spark, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(people, path, quote_mode="NONE", escape="\\")
    assert lines(path)[:2] == ["1,Ann,1.5,true", '2,say "x"\\, y,null,false']
    broken = spark.createDataFrame([("a\nb\rc\\",)], "t string").coalesce(1)
    write_delimited(broken, str(tmp_path / "lf"), quote_mode="NONE", escape="\\")
    assert texts(tmp_path / "lf") == ["a\\nb\\rc\\\\\n"]
    with pytest.raises(ValueError, match="escape"):
        WriteOptions(quote_mode="NONE")


def test_null_quote_mode_is_minimal_and_null_quote_writes_raw(people, tmp_path):
    write_delimited(people, str(tmp_path / "a"), quote_mode=None)
    assert lines(tmp_path / "a")[1] == '2,"say ""x"", y",null,false'
    write_delimited(people.where("id = 1"), str(tmp_path / "b"), quote=None, header=True)
    assert lines(tmp_path / "b") == ["id,name,score,ok", "1,Ann,1.5,true"]


@pytest.mark.parametrize("quote_mode, extra", [("MINIMAL", {}), ("ALL", {}), ("NON_NUMERIC", {})])
@pytest.mark.parametrize("delimiter, quote", [(",", '"'), ("|", "'"), ("\t", "!"), (";", '"')])
def test_round_trips(people, spark, tmp_path, quote_mode, extra, delimiter, quote):
    path = str(tmp_path / "out")
    write_delimited(people.repartition(3), path, header=True, quote_mode=quote_mode, delimiter=delimiter, quote=quote, **extra)
    back = read_delimited(spark, path, SCHEMA, header=True, delimiter=delimiter, quote=quote, null_value="null")
    assert sorted(rows(back)) == sorted(rows(people))


@pytest.mark.parametrize("quote_mode", ["MINIMAL", "ALL", "NON_NUMERIC"])
def test_round_trip_with_an_escape_character(spark, tmp_path, quote_mode):
    df = spark.createDataFrame([(1, 'a "b" \\ c'), (2, "x\\"), (3, '\\"')], "id int, t string").coalesce(1)
    path = str(tmp_path / "out")
    write_delimited(df, path, quote_mode=quote_mode, escape="\\")
    assert sorted(rows(read_delimited(spark, path, "id int, t string", escape="\\"))) == sorted(rows(df))


def test_empty_null_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("oak", 120), ("elm", None), (None, 7), (None, None)], "tree string, rings int")
    path = str(tmp_path / "out")
    write_delimited(df, path, header=True, null_value="")
    for options in ({"treat_empty_values_as_nulls": True}, {"null_value": ""}):
        assert set(rows(read_delimited(spark, path, "tree string, rings int", header=True, **options))) == set(rows(df))


def test_blanks_are_kept(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "\tb")], "x string, y string")
    write_delimited(df, str(tmp_path / "out"))
    assert rows(read_delimited(spark, str(tmp_path / "out"), "x string, y string")) == [(" a ", "\tb")]


@pytest.mark.parametrize("quote_mode", ["MINIMAL", "NON_NUMERIC"])
def test_every_part_file_has_the_header(spark, tmp_path, quote_mode):
    path = str(tmp_path / "out")
    write_delimited(spark.range(0, 8, 1, 4), path, header=True, quote_mode=quote_mode)
    heads = [t.splitlines()[0].strip('"') for t in texts(path)]
    assert heads == ["id"] * 4
    empty = str(tmp_path / "empty")
    write_delimited(spark.range(0).selectExpr("id", "'x' AS t"), empty, header=True, quote_mode=quote_mode)
    assert [line.replace('"', "") for line in lines(empty)] == ["id,t"]
    assert read_delimited(spark, empty, "id bigint, t string", header=True).count() == 0


def test_dates_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2022, 11, 5, 6, 7), date(2023, 2, 14)), (None, None)], "ts timestamp, day date").coalesce(1)
    write_delimited(df, str(tmp_path / "a"))
    assert lines(tmp_path / "a") == ["2022-11-05 06:07:00.0,2023-02-14 00:00:00.0", "null,null"]
    write_delimited(df, str(tmp_path / "b"), date_format="MM/dd/yyyy HH:mm:ss", null_value="-", quote_mode="NON_NUMERIC")
    assert lines(tmp_path / "b") == ['"11/05/2022 06:07:00","02/14/2023 00:00:00"', '"-","-"']


@pytest.mark.parametrize("codec, suffix", [("gZiP", ".gz"), ("bzip2", ".bz2"), ("lz4", ".lz4"), ("snappy", ".snappy"), ("org.apache.hadoop.io.compress.GzipCodec", ".gz")])
@pytest.mark.parametrize("quote_mode", ["MINIMAL", "NON_NUMERIC"])
def test_codecs(people, spark, tmp_path, codec, suffix, quote_mode):
    path = str(tmp_path / "out")
    save_with_options(people, {"path": path, "header": "true", "codec": codec, "quoteMode": quote_mode})
    assert {p.suffix for p in Path(path).glob("part-*")} == {suffix}
    assert read_delimited(spark, path, SCHEMA, header=True).count() == 4


def test_option_errors(people, tmp_path):
    for bad in ({"quoteMode": "SOME"}, {"codec": "zap"}, {"delimiter": "ab"}, {"header": "maybe"}, {"quote": "ab"}):
        with pytest.raises(ValueError):
            WriteOptions.from_map(bad)
    with pytest.raises(ValueError, match="path"):
        save_with_options(people, {})


@pytest.mark.parametrize("quote_mode", ["MINIMAL", "NON_NUMERIC"])
def test_save_modes(spark, tmp_path, quote_mode):
    path, one = str(tmp_path / "out"), spark.range(1)
    write_delimited(one, path, quote_mode=quote_mode, header=True)
    with pytest.raises(Exception, match="(?i)exists"):
        write_delimited(one, path, quote_mode=quote_mode, header=True)
    write_delimited(spark.range(5), path, save_mode="ignore", quote_mode=quote_mode, header=True)
    assert read_delimited(spark, path, header=True).count() == 1
    write_delimited(spark.range(5), path, save_mode="overwrite", quote_mode=quote_mode, header=True)
    write_delimited(one, path, save_mode="append", quote_mode=quote_mode, header=True)
    assert read_delimited(spark, path, header=True).count() == 6


def test_nested_columns_are_refused(spark, tmp_path):
    with pytest.raises(TypeError, match="tags"):
        write_delimited(spark.sql("SELECT 1 AS id, array(1) AS tags"), str(tmp_path / "out"))
    assert isinstance(T.ArrayType(T.IntegerType()), T.DataType)


def test_insert_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(spark.range(3), path, header=True)
    create_delimited_view(spark, "ids", path, "id bigint", header=True, writable=True, on_bad_cast="null")
    spark.range(7).createOrReplaceTempView("more_ids")
    spark.sql("INSERT OVERWRITE TABLE ids SELECT id FROM more_ids")
    assert spark.table("ids").count() == 7
    insert_overwrite(spark.range(2), path, header=True)
    assert read_delimited(spark, path, "id bigint", header=True).count() == 2
    with pytest.raises(ValueError, match="no path"):
        insert_overwrite(spark.range(1), None)


@pytest.mark.parametrize("quote_mode", ["MINIMAL", "NON_NUMERIC", "NONE"])
@pytest.mark.parametrize("codec", [None, "gzip"])
def test_header_of_empty_parts_and_under_a_record_limit(spark, tmp_path, quote_mode, codec):
    path = str(tmp_path / "out")
    df = spark.range(0, 40, 1, 4).where("id >= 10").select("id", F.concat(F.lit("a\n"), F.col("id").cast("string")).alias("t"))  # the first part is empty
    write_delimited(df, path, header=True, quote_mode=quote_mode, escape="\\", codec=codec, max_records_per_file=7)
    parts = sorted(Path(path).glob("part-*"))
    assert len(parts) == 7
    for part in parts:
        text = (gzip.decompress(part.read_bytes()) if codec else part.read_bytes()).decode()
        assert text.splitlines()[0].replace('"', "") == "id,t" and text.replace('"', "").count("id,t") == 1
    assert spark.read.option("header", True).option("multiLine", True).option("escape", "\\").csv(path).count() == 30


def test_overwrite_by_rows_of_the_same_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_delimited(spark.range(10), path, header=True)
    read = lambda: read_delimited(spark, path, "id bigint", header=True)
    insert_overwrite(read().where("id < 4").select((F.col("id") * 2).alias("id")), path, header=True)
    assert sorted(rows(read())) == [(0,), (2,), (4,), (6,)]
    with pytest.raises(Exception, match="(?i)divide"):
        insert_overwrite(read().select(F.expr("1 div (id - id)").alias("id")), path, header=True)
    assert read().count() == 4 and [p.name for p in tmp_path.iterdir()] == ["t"]
