"""Scans of files and lines, in the shapes of FIXTURES.md."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compare import rows
from sheaftext import ReadOptions, create_delimited_view, parse_lines, read_delimited, read_tsv, read_with_options
from sheaftext.sources.lines import text_lines

LAMPS = 'id,colour,room,remark,spare\n7,red,"hall","bright, but warm",x\n\n"8","blue",attic\n9,"green",cellar,"no bulb",\n'


def test_header_names_all_strings(spark, put):
    df = read_delimited(spark, put(LAMPS), header=True)
    assert df.columns == ["id", "colour", "room", "remark", "spare"]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert sorted(rows(df.select("id", "remark"))) == [("7", "bright, but warm"), ("8", None), ("9", "no bulb")]


def test_positional_names(spark, put):
    df = read_delimited(spark, put(LAMPS))
    assert df.columns == ["C0", "C1", "C2", "C3", "C4"]
    assert df.count() == 4


def test_no_null_text_keeps_empty_apart_from_missing(spark, put):
    df = read_delimited(spark, put(LAMPS), header=True, null_value=None)
    assert sorted(rows(df.select("id", "spare"))) == [("7", "x"), ("8", None), ("9", "")]


def test_more_tokens_than_header_are_ignored(spark, put):
    df = read_delimited(spark, put('a,b\n1,2,null\n3,,,,\n"4","5",x\n'), header=True)
    assert sorted(rows(df), key=str) == [("1", "2"), ("3", None), ("4", "5")]


def test_header_line_is_dropped_wherever_it_recurs(spark, put):
    put("a,b\n1,2\na,b\n3,4\n", "many/x.csv")
    put("a,b\n5,6\n", "many/y.csv")
    path = put("a,b\n7,8\n", "many/z.csv").rsplit("/", 1)[0]
    assert sorted(rows(read_delimited(spark, path, "a int, b int", header=True))) == [(1, 2), (3, 4), (5, 6), (7, 8)]


def test_schema_replaces_header_names(spark, put):
    df = read_delimited(spark, put(LAMPS), "y double, mk string, md string, n string, b string", header=True)
    assert df.agg(F.avg("y")).head()[0] == pytest.approx(8)


def test_alternative_dialect(spark, put):
    text = "id;colour;remark\n~7~;~red~;~a;b~\n8;blue\n\n9;~green~; ~c~\n"
    df = read_delimited(spark, put(text), header=True, delimiter=";", quote="~")
    assert sorted(rows(df), key=str) == [("7", "red", "a;b"), ("8", "blue", None), ("9", "green", " ~c~")]
    double = read_delimited(spark, put(text), header=True, delimiter=";")
    assert sorted(r[0] for r in rows(double)) == ["8", "9", "~7~"]


def test_wrong_delimiter_leaves_no_such_column(spark, put):
    with pytest.raises(Exception, match="(?i)code"):
        read_delimited(spark, put("code|room\n1|2\n"), header=True, delimiter=",").select("code").collect()


def test_quote_switched_off(spark, put):
    df = read_delimited(spark, put('a,b\n"1,x\n2,y"\n"3,"z"\n'), header=True, quote=None)
    assert sorted(rows(df)) == [('"1', "x"), ('"3', '"z"'), ("2", 'y"')]


def test_escape_character(spark, put):
    assert rows(read_delimited(spark, put('"motto"\n"run ^"slowly^", then rest"\n'), header=True, escape="^")) == [('run "slowly", then rest',)]
    assert rows(read_delimited(spark, put('"column"\n"say ""x"""\n'), header=True)) == [('say "x"',)]


def test_comment_lines(spark, put):
    text = "; depth soundings\n12,0.5,2003-11-04 06:10:30,true\n;13,oops\n14,7,2003-11-05 23:59:59,false\n"
    df = read_delimited(spark, put(text), comment=";", infer_schema=True)
    assert rows(df.orderBy("C0")) == [(12, 0.5, datetime(2003, 11, 4, 6, 10, 30), True), (14, 7.0, datetime(2003, 11, 5, 23, 59, 59), False)]


def test_comments_switched_off(spark, put):
    assert sorted(rows(read_delimited(spark, put("#tag,blue\nplain,#red\n"), comment=None))) == [("#tag", "blue"), ("plain", "#red")]


def test_only_delimiters_is_a_row_of_empties(spark, put):
    assert sorted(rows(read_delimited(spark, put("a\tb\n\t\n1\t2\n"), header=True, delimiter="\t", null_value=None))) == [("", ""), ("1", "2")]


def test_tsv_preset_and_thousands(spark, put):
    text = 'harbour\tvisitors\tfee\nEsbjerg\t"1,204"\t"3,310.25"\nPiran\t960\t78\n'
    df = read_tsv(spark, put(text, "b.tsv"), "harbour string, visitors string, fee decimal(12,2)")
    assert sorted(rows(df)) == [("Esbjerg", "1,204", Decimal("3310.25")), ("Piran", "960", Decimal("78.00"))]
    assert df.where("fee > 1000").count() == 1


def test_charsets(spark, put):
    path = put("nameþn\nJoséþ1\n", encoding="iso-8859-1")
    for charset in ("iso-8859-1", "8859_1", "latin1"):
        assert rows(read_delimited(spark, path, header=True, charset=charset, delimiter="þ")) == [("José", "1")]
    euro = put("n,p\nx,5 €\n", encoding="windows-1252")
    assert rows(read_delimited(spark, euro, header=True, charset="windows-1252")) == [("x", "5 €")]
    assert "þ" not in text_lines(spark, path, "utf-8").head()[0]
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    with pytest.raises(ValueError, match="no-such-charset"):
        read_delimited(spark, path, charset="no-such-charset")


def test_trim_flags(spark, put):
    text = " a , b \n x , y \n"
    assert rows(read_delimited(spark, put(text), header=True)) == [(" x ", " y ")]
    trimmed = read_delimited(spark, put(text), header=True, ignore_leading_white_space=True, ignore_trailing_white_space=True)
    assert trimmed.columns == ["a", "b"] and rows(trimmed) == [("x", "y")]


def test_empty_file(spark, put):
    path = put("")
    assert read_delimited(spark, path, "a string").count() == 0
    with pytest.raises(ValueError, match="schema"):
        read_delimited(spark, path)


def test_globs_lists_and_compressed_files(spark, put, tmp_path):
    import gzip

    first = put("1,a\n", "g/one.csv")
    second = put("2,b\n", "g/two.csv")
    (tmp_path / "g" / "three.csv.gz").write_bytes(gzip.compress(b"3,c\n"))
    assert read_delimited(spark, str(tmp_path / "g" / "*.csv*"), "n int, t string").count() == 3
    assert read_delimited(spark, [first, second], "n int, t string").count() == 2


def test_multiline_fields(spark, put):
    text = 'id,text\n1,"two\nlines, and ""quotes"""\n2,plain\n3\n'
    df = read_delimited(spark, put(text), "id int, text string", header=True, multi_line=True)
    assert sorted(rows(df)) == [(1, 'two\nlines, and "quotes"'), (2, "plain"), (3, None)]
    strict = read_delimited(spark, put(text), "id int, text string", header=True, multi_line=True, mode="DROPMALFORMED")
    assert strict.count() == 2 and strict.select("text").count() == 2
    named = read_delimited(spark, put(text), header=True, multi_line=True, infer_schema=True)
    assert [f.dataType.simpleString() for f in named.schema] == ["int", "string"]


def test_lines_frame_with_header(spark):
    lines = spark.createDataFrame([("moon,radius",), ("Io,1821",), ("Mimas,198",)], "entry string").coalesce(1)
    assert sorted(rows(parse_lines(lines, header=True, column="entry"))) == [("Io", "1821"), ("Mimas", "198")]


def test_carried_columns(spark, put):
    df = read_delimited(spark, put("1\n2\n"), "n int", carry={"file": F.col("_metadata.file_name")})
    assert sorted(rows(df)) == [(1, "data.csv"), (2, "data.csv")]


def test_sql_view_honours_modes(spark, put):
    path = put("1,a\nx,b\n3\n4,d\n")
    create_delimited_view(spark, "kept_lines", path, "n int, t string", mode="DROPMALFORMED")
    assert rows(spark.sql("SELECT n FROM kept_lines ORDER BY n")) == [(1,), (4,)]
    for options in ({"mode": "DROPMALFORMED"}, {"profile": "legacy"}, {}):
        with pytest.raises(ValueError, match="cannot honour"):
            create_delimited_view(spark, "never", path, "n int, t string", writable=True, **options)


def test_sql_view(spark, put):
    create_delimited_view(spark, "lamps", put(LAMPS), header=True, infer_schema=True)
    assert rows(spark.sql("SELECT id FROM lamps WHERE room = 'attic'")) == [(8,)]
    create_delimited_view(spark, "typed", put(LAMPS), "y double, mk string, md string, n string, b string", header=True)
    assert spark.sql("SELECT count(*) FROM typed WHERE y > 7").head()[0] == 2


def test_string_option_map(spark, put):
    path = put("a;b\n1;2\n")
    df = read_with_options(spark, {"path": path, "header": "true", "delimiter": ";", "inferSchema": "true", "parserLib": "x"})
    assert rows(df) == [(1, 2)]
    with pytest.raises(ValueError, match="path"):
        read_with_options(spark, {"header": "true"})


@pytest.mark.parametrize(
    "bad",
    [
        {"delimiter": "ab"},
        {"delimiter": "\\1"},
        {"quote": "''"},
        {"escape": "xx"},
        {"comment": "//"},
        {"header": "yes"},
        {"inferSchema": "1"},
        {"treatEmptyValuesAsNulls": "no"},
        {"maxCharsPerCol": "many"},
        {"locale": "xx"},
    ],
)
def test_option_errors(bad):
    with pytest.raises(ValueError):
        ReadOptions.from_map(bad)


def test_named_delimiters():
    named = {"\\t": "\t", "\\r": "\r", "\\b": "\b", "\\f": "\f", '\\"': '"', "\\'": "'", "\\u0000": "\u0000"}
    for text, char in named.items():
        assert ReadOptions(delimiter=text).delimiter == char


def test_unknown_mode_is_permissive(caplog):
    assert ReadOptions(mode="LENIENT").mode == "PERMISSIVE"
    assert "not a valid parse mode" in caplog.text


def test_nested_schema_is_refused(spark, put):
    with pytest.raises(TypeError, match="Unsupported type"):
        read_delimited(spark, put("1\n"), T.StructType([T.StructField("a", T.ArrayType(T.IntegerType()))]))


def test_custom_date_format(spark, put):
    path = put("seen\n03.07.1999 09:05\n-\n30.12.2001 21:40\n")
    options = {"header": True, "date_format": "dd.MM.yyyy hh:mm", "null_value": "-"}
    inferred = read_delimited(spark, path, infer_schema=True, **options)
    assert inferred.schema[0].dataType == T.TimestampType()
    assert set(rows(inferred)) == {(datetime(1999, 7, 3, 9, 5),), (None,), (datetime(2001, 12, 30, 21, 40),)}
    days = read_delimited(spark, path, "seen date", **options)
    assert set(rows(days)) == {(date(1999, 7, 3),), (None,), (date(2001, 12, 30),)}
