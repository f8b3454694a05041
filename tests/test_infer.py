"""Inference: kinds, merging, freedom from row order."""

import itertools

import pytest

from compare import rows
from sheaftext import parse_lines, read_delimited
from sheaftext.sources.delimited import open_lines


def inferred(spark, tokens, partitions=1, **options):
    lines = spark.createDataFrame([(f'k,"{t}"',) for t in tokens], "value string").repartition(partitions)
    return open_lines(lines, None, infer_schema=True, **options).schema[1].dataType.simpleString()


@pytest.mark.parametrize(
    "token, kind",
    [
        ("17", "int"),
        ("-2147483648", "int"),
        ("2147483648", "bigint"),
        ("7000000000", "bigint"),
        ("9223372036854775808", "double"),
        ("0.125", "double"),
        (" 8 ", "double"),
        ("2e-3", "double"),
        ("NaN", "double"),
        ("nan", "string"),
        ("word", "string"),
        ("Inf", "string"),
        ("2021-03-04 05:06:07", "timestamp"),
        ("2021-03-04 05", "string"),
        ("2021-03-04 05:06", "string"),
        ("2021-03 05:06:07", "string"),
        ("1999", "int"),
        ("TRUE", "boolean"),
        ("faLse", "boolean"),
        ("Truth", "string"),
        ("f", "string"),
        ("", "string"),
    ],
)
def test_single_tokens(spark, token, kind):
    assert inferred(spark, [token]) == kind


@pytest.mark.parametrize(
    "tokens, kind",
    [
        (["1", "2.5"], "double"),
        (["1", "3000000000"], "bigint"),
        (["3000000000", "1.0"], "double"),
        (["1", "", "2"], "int"),
        (["1", "x"], "string"),
        (["1", "true"], "string"),
        (["2021-03-04 05:06:07", "FALSE"], "string"),
        (["1.5", "2021-03-04 05:06:07"], "string"),
        (["", ""], "string"),
    ],
)
def test_merging_does_not_depend_on_order(spark, tokens, kind):
    for order in itertools.permutations(tokens):
        for partitions in (1, 3):
            assert inferred(spark, order, partitions) == kind


def test_null_text_says_nothing(spark):
    assert inferred(spark, ["\\N", "5"], null_value="\\N") == "int"
    assert inferred(spark, ["null", "True"], null_value="null") == "boolean"


def test_pattern(spark):
    assert inferred(spark, ["2021-03"], date_format="yyyy-MM") == "timestamp"
    assert inferred(spark, ["04/03/2021 19:30"], date_format="dd/MM/yyyy hh:mm") == "timestamp"


RAGGED = "\nCode,Level,Grade,Seen\nk1,4,2.5,2023-05-06 07:08:09\nk2,9,3,2023-05-06 07:08:10\nk3,7\nk4,1,2,3,4,5\n"


def test_ragged_lines(spark, put):
    strict = read_delimited(spark, put(RAGGED), header=True, infer_schema=True, mode="DROPMALFORMED")
    assert [f.dataType.simpleString() for f in strict.schema] == ["string", "int", "double", "timestamp"] and strict.count() == 2
    lenient = read_delimited(spark, put(RAGGED), header=True, infer_schema=True)
    assert [f.dataType.simpleString() for f in lenient.schema] == ["string", "int", "double", "string"] and lenient.count() == 4


def test_sparse_columns(spark, put):
    df = read_delimited(spark, put("P,Q,R\n7,,\n,8,\n7,,9\n"), header=True, infer_schema=True)
    assert [f.dataType.simpleString() for f in df.schema] == ["int"] * 3
    assert sorted(map(str, rows(df)))[0] == "(7, None, 9)"


def test_header_without_rows(spark, put):
    df = read_delimited(spark, put("a,b\n"), header=True, infer_schema=True)
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string"] and df.count() == 0


def test_inferred_lines_parse(spark):
    lines = spark.createDataFrame([("1,true,2.5",), ("2,False,3",)], "value string")
    assert sorted(rows(parse_lines(lines, infer_schema=True))) == [(1, True, 2.5), (2, False, 3.0)]
