"""Malformed rows."""

import pytest
from pyspark.sql import functions as F

from compare import rows
from sheaftext import parse_lines, read_delimited, read_with_quarantine
from sheaftext.sources.delimited import open_lines

STOCK = "Item,Pieces,Weight,Packed\nbolt,12,0.35,2021-03-04 07:08:09\nnut,many,0.2,2021-03-05 00:00:00\nrivet,7,heavy,2022-11-30 23:59:59\nscrew,40,1.5,2020-02-29 12:00:00\nwasher,3,2,soon\n"
SCHEMA = "Item string, Pieces int, Weight double, Packed timestamp"
RAGGED = "a,b,c\n1,x,y\n2,x\n3,x,y,z\n4,\"x,y\n,,\n"


def lines_of(spark, *lines):
    return spark.createDataFrame([(l,) for l in lines], "value string")


def test_drop_malformed_does_not_depend_on_the_selection(spark, put):
    df = read_delimited(spark, put(STOCK), SCHEMA, header=True, mode="DROPMALFORMED")
    assert sorted(r[0] for r in rows(df)) == ["bolt", "screw"]
    assert sorted(rows(df.select("Item"))) == [("bolt",), ("screw",)]
    assert df.count() == 2 and df.agg(F.count("*")).head()[0] == 2


def test_drop_malformed_all_strings_keeps_every_whole_row(spark, put):
    df = read_delimited(spark, put(STOCK), "n string, a string, h string, b string", header=True, mode="dropmalformed")
    assert df.count() == 5


def test_drop_malformed_ragged_and_unbalanced(spark, put):
    df = read_delimited(spark, put(RAGGED), header=True, mode="DROPMALFORMED")
    assert sorted(rows(df), key=str) == [("1", "x", "y"), (None, None, None)]


def test_typed_parse_agrees_with_token_casts(spark):
    """The parser's own types and the token casts must drop the same lines."""
    tokens = ["5", "-5", "+5", "05", " 5", "5 ", "5.0", "2147483648", "9223372036854775808", "300", "x", "", '""', "1e3", "true", "TRUE", "yes", "1,5", "5\t", "NaN"]
    lines = lines_of(spark, *[f'"{t}",k{i}' if "," in t else f"{t},k{i}" for i, t in enumerate(tokens)])
    for kind in ("tinyint", "smallint", "int", "bigint", "boolean", "float", "double", "decimal(5,1)"):
        schema = f"v {kind}, k string"
        fast = parse_lines(lines, schema, mode="DROPMALFORMED")
        slow = open_lines(lines, schema, mode="DROPMALFORMED").good_and_rejected()[0]
        assert sorted(map(repr, rows(fast))) == sorted(map(repr, rows(slow))), kind


def test_failfast_names_the_line(spark, put):
    df = read_delimited(spark, put("a,b,c\n1,2,3\n2015,Cube,\n2016,Cube\n"), header=True, mode="FAILFAST")
    with pytest.raises(Exception, match="Malformed line in FAILFAST mode: 2016,Cube"):
        df.select("a").collect()


def test_failfast_long_field(spark, put):
    text = "id,text\n1,short\n2," + "x" * 300 + "\n"
    df = read_delimited(spark, put(text), header=True, mode="FAILFAST", max_chars_per_col=200)
    with pytest.raises(Exception, match="Malformed line in FAILFAST mode: 2,xxx"):
        df.collect()
    assert read_delimited(spark, put(text), header=True, max_chars_per_col=300).count() == 2
    assert read_delimited(spark, put(text), header=True, mode="DROPMALFORMED").count() == 2
    with pytest.raises(Exception, match="longer than 200"):
        read_delimited(spark, put(text), header=True, mode="DROPMALFORMED", max_chars_per_col=200).collect()
    with pytest.raises(Exception, match="longer than 200"):
        read_delimited(spark, put(text), header=True, max_chars_per_col=200).collect()
    with pytest.raises(Exception, match="longer than 200"):
        read_delimited(spark, put(text), header=True, max_chars_per_col=200, on_bad_cast="null").collect()


def test_no_limit_unless_set(spark, put):
    long = "x" * 200_000
    assert rows(read_delimited(spark, put(f"{long},b\n1,{long}\n"), header=True)) == [("1", long)]
    assert read_delimited(spark, put(f"{long},b\n1,{long}\n"), "a string, b string", mode="DROPMALFORMED").count() == 2


def test_more_fields_than_the_parser_takes(spark):
    crowd, quoted = "," * 21_000, '"' + "," * 30_000 + '",z'
    lines = lines_of(spark, crowd, "1,2", quoted)
    assert sorted(rows(parse_lines(lines, "a string, b string", mode="DROPMALFORMED"))) == [(quoted[1:-3], "z"), ("1", "2")]
    assert parse_lines(lines, "a string, b string").count() == 3
    rejected = open_lines(lines, "a string, b string").good_and_rejected()[1].collect()
    assert [(r.reason, r.line) for r in rejected] == [("too_many_tokens", crowd)]


def test_drop_malformed_without_text_columns(spark):
    lines = lines_of(spark, "1,true,2.50", "x,true,1", "3,false", "4,false,7")
    df = parse_lines(lines, "a int, b boolean, c decimal(5,2)", mode="DROPMALFORMED")
    assert sorted(r[0] for r in rows(df)) == [1, 4]
    assert parse_lines(lines_of(spark, "1,2", "3,4"), infer_schema=True, mode="DROPMALFORMED").count() == 2


def test_permissive_bad_cast_fails_only_when_selected(spark, put):
    df = read_delimited(spark, put(STOCK), SCHEMA, header=True)
    assert df.select("Item").count() == 5
    with pytest.raises(Exception, match="column Pieces does not fit type int"):
        df.select("Pieces").collect()
    nulled = read_delimited(spark, put(STOCK), SCHEMA, header=True, on_bad_cast="null")
    assert sorted(r[1] for r in rows(nulled) if r[1] is not None) == [3, 7, 12, 40]


def test_permissive_keeps_ragged_and_drops_unclosed_quotes(spark, put):
    df = read_delimited(spark, put(RAGGED), header=True)
    assert sorted(rows(df), key=str) == [("1", "x", "y"), ("2", "x", None), ("3", "x", "y"), (None, None, None)]


@pytest.mark.parametrize(
    "line, unbalanced",
    [
        ('a,"b', True),
        ('a,b,c,d,"e', True),
        ('a,b,c,d,"e"', False),
        ('a,b,c,d,"e""', True),
        ('a,b,c,d,e"f', False),
        ('"a""b",c,d,e', False),
        ('a,"b,c"', False),
        ('"', True),
    ],
)
def test_unclosed_quotes(spark, line, unbalanced):
    assert parse_lines(lines_of(spark, line), "a string, b string").count() == (0 if unbalanced else 1)


def test_unclosed_quotes_under_an_escape_character(spark):
    lines = lines_of(spark, 'a,b,c,"d\\"', 'a,b,c,"d\\\\"', 'a,"b\\",c"', 'a,"b\\"')
    kept = parse_lines(lines, "a string, b string", escape="\\")
    assert sorted(rows(kept)) == [("a", "b"), ("a", 'b",c')]


def test_quarantine(spark, put):
    text = STOCK + "Short,1\nLong,1,2,1990-02-24 00:00:00,x\nOpen,1,2,\"x\n"
    good, rejected = read_with_quarantine(spark, put(text), SCHEMA, header=True)
    assert sorted(r[0] for r in rows(good)) == ["bolt", "screw"]
    found = {r.line.split(",")[0]: (r.reason, r.token_count, r.bad_column) for r in rejected.collect()}
    assert found == {
        "nut": ("bad_value", 4, "Pieces"),
        "rivet": ("bad_value", 4, "Weight"),
        "washer": ("bad_value", 4, "Packed"),
        "Short": ("too_few_tokens", 2, None),
        "Long": ("too_many_tokens", None, None),
        "Open": ("unbalanced_quote", None, None),
    }
    assert good.count() + rejected.count() == 8
    assert rejected.select("reason").count() == 6


def test_quarantine_long_field(spark):
    rejected = open_lines(lines_of(spark, "1," + "x" * 30, "2,y"), "a int, b string", max_chars_per_col=20).good_and_rejected()[1]
    assert [r.reason for r in rejected.collect()] == ["field_too_long"]


def test_many_columns(spark):
    width = 150
    schema = ", ".join(f"c{i} {('int', 'double', 'string')[i % 3]}" for i in range(width))
    line = ",".join(str(i) for i in range(width))
    lines = lines_of(spark, line, line + ",1", line.rsplit(",", 1)[0])
    assert parse_lines(lines, schema, mode="DROPMALFORMED").count() == 1
    assert parse_lines(lines, schema).select("c149").count() == 3
    assert sorted(str(r[0]) for r in rows(parse_lines(lines, schema).select("c148"))) == ["148.0", "148.0", "148.0"]
