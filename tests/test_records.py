"""Records that span lines, and lines of wide charsets, cut into many splits."""

import csv
import io
import random

import pytest

from compare import rows
from sheaftext import read_delimited, read_with_quarantine
from sheaftext.sources.lines import text_lines


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, "300")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def random_records(seed, n=150):
    draw = random.Random(seed)
    part = lambda: draw.choice(["a", "bc", "\n", ",", '"', " ", "x\ny", "\n\n", "#", "é", '""'])
    return [(str(i), "".join(part() for _ in range(draw.randint(0, 12))), draw.choice(["k", ""])) for i in range(n)]


def as_csv(records, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL).writerows(records)
    return out.getvalue()


@pytest.mark.parametrize("seed", range(3))
def test_quoted_line_ends_across_splits(spark, put, small_splits, seed):
    records = random_records(seed)
    path = put(as_csv(records))
    assert text_lines(spark, path).rdd.getNumPartitions() > 5
    got = read_delimited(spark, path, "i int, t string, k string", multi_line=True, comment=None, null_value=None)
    assert sorted(rows(got)) == sorted((int(i), t, k) for i, t, k in records)


def test_one_record_over_many_splits(spark, put, small_splits):
    long = "\n".join(f"line {k}, of a long text" for k in range(400))
    path = put(as_csv([("1", "a"), ("2", long), ("3", "b")]))
    assert sorted(rows(read_delimited(spark, path, "i int, t string", multi_line=True))) == [(1, "a"), (2, long), (3, "b")]


def test_headers_comments_and_ragged_records(spark, put, small_splits):
    text = 'id,"two\nlines"\n# a "comment\n1,"x\ny"\nid,"two\nlines"\n\n2\n3,"a\n",4\n5" pipe,plain\n6,"open\nto the end'
    path = put(text)
    df = read_delimited(spark, path, header=True, multi_line=True)
    assert df.columns == ["id", "two\nlines"]
    assert sorted(rows(df)) == [("1", "x\ny"), ("2", None), ("3", "a\n"), ('5" pipe', "plain")]
    good, rejected = read_with_quarantine(spark, path, "id string, t string", header=True, multi_line=True)
    assert sorted(rows(good)) == [("1", "x\ny"), ('5" pipe', "plain")]
    assert sorted(rows(rejected.select("line", "reason", "token_count"))) == [("2", "too_few_tokens", 1), ('3,"a\n",4', "too_many_tokens", None), ('6,"open\nto the end', "unbalanced_quote", None)]


def test_carriage_returns(spark, put, small_splits):
    records = [(str(i), f"a\r\nb{i}") for i in range(50)]
    crlf = read_delimited(spark, put(as_csv(records, "\r\n")), "i string, t string", multi_line=True)
    assert sorted(rows(crlf)) == sorted((i, t.replace("\r", "")) for i, t in records)
    plain = read_delimited(spark, put(as_csv(records), "lf.csv"), "i string, t string", multi_line=True)
    assert sorted(rows(plain)) == sorted(records)


def test_escape_character_and_charset(spark, put, small_splits):
    text = "".join(f'{i},"say \\"€\n{i}\\" and \\\\"\n' for i in range(40))
    path = put(text, encoding="windows-1252")
    got = read_delimited(spark, path, "i int, t string", multi_line=True, escape="\\", charset="windows-1252")
    assert sorted(rows(got)) == [(i, f'say "€\n{i}" and \\') for i in range(40)]


ODD_LETTERS = ["\u0a06", "\u0100", "\u0a00", "\u010a", "a", "é", "\U0001f600", "\u0d0a", "\u000b"]


@pytest.mark.parametrize("charset", ["UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE"])
def test_wide_charsets(spark, put, small_splits, charset):
    draw = random.Random(1)
    records = [(i, "".join(draw.choice(ODD_LETTERS) for _ in range(draw.randint(1, 9)))) for i in range(120)]
    path = put("".join(f"{i};{t}\n" for i, t in records), encoding=charset)
    assert text_lines(spark, path, charset).count() == 120
    assert sorted(rows(read_delimited(spark, path, "i int, t string", delimiter=";", charset=charset))) == records


def test_marks_of_byte_order(spark, put, small_splits):
    for order, first in (("LE", 0), ("BE", 100)):
        text = "\ufeff" + "".join(f"{i},\u0a06\u0100{i}\r\n" for i in range(first, first + 60))
        put(text, f"both/x {order}.csv", encoding=f"UTF-16{order}")
    folder = put("7,no mark\n", "both/plain.csv", encoding="UTF-16BE").rsplit("/", 1)[0]
    got = sorted(rows(read_delimited(spark, folder, "i int, t string", charset="UTF-16")))
    assert got == sorted([(7, "no mark"), *((i, f"\u0a06\u0100{i}") for f in (0, 100) for i in range(f, f + 60))])
    empty = put("", "none.csv")
    assert read_delimited(spark, empty, "i int", charset="UTF-16").count() == 0


def test_multi_line_in_utf16(spark, put, small_splits):
    records = random_records(5, 40)
    path = put(as_csv(records), encoding="UTF-16LE")
    got = read_delimited(spark, path, "i int, t string, k string", multi_line=True, comment=None, null_value=None, charset="UTF-16LE")
    assert sorted(rows(got)) == sorted((int(i), t, k) for i, t, k in records)
