"""Lines of text files as a DataFrame: charset, blank and comment lines, header line."""

from __future__ import annotations

import codecs
import csv
import re
import sys
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaftext.operators.records import LINE, ROW, SOURCE, SPLIT, join_lines, place_columns
from sheaftext.options import ReadOptions

JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"


@contextmanager
def _any_java_charset(spark: SparkSession):
    """Expressions built inside accept every charset of the JVM; the session setting is put back after."""
    before = spark.conf.get(JAVA_CHARSETS, "false")
    spark.conf.set(JAVA_CHARSETS, "true")
    try:
        yield
    finally:
        spark.conf.set(JAVA_CHARSETS, before)


def is_utf8(charset: str) -> bool:
    try:
        return codecs.lookup(charset).name == "utf-8"
    except LookupError:
        return False


def check_charset(spark: SparkSession, charset: str) -> None:
    """Raise for a charset the JVM does not know, before any file is read."""
    if not is_utf8(charset):
        try:
            known = spark._jvm.java.nio.charset.Charset.isSupported(charset)
        except Exception:  # an illegal name
            known = False
        if not known:
            raise ValueError(f"unsupported charset: {charset}")


#: Bytes of a code unit of the charsets that have wide ones, by the JVM's name of the charset.
WIDE_UNITS = {"UTF-16": 2, "UTF-32": 4}


def wide_charset(spark: SparkSession, charset: str) -> tuple[int, str | None] | None:
    """(bytes of a code unit, LE or BE, None where a mark in each file says which) of UTF-16 and UTF-32; None for other charsets."""
    name = "UTF-8" if is_utf8(charset) else spark._jvm.java.nio.charset.Charset.forName(charset).name().upper()
    for family, unit in WIDE_UNITS.items():
        if family in name:
            return unit, next((order for order in ("LE", "BE") if order in name), None)
    return None


def text_lines(spark: SparkSession, path: str | list[str], charset: str = "UTF-8", carry: dict[str, Column] | None = None, line_end: str | None = None) -> DataFrame:
    """One row per line, read as splittable text; ``carry`` adds columns, e.g. of ``_metadata``.

    Files of charsets with wide code units are cut at encoded line ends, see :func:`wide_lines`; all others at newline bytes,
    and decoded after that. ``line_end`` makes that the only line end; otherwise a carriage return ends a line too.
    """
    check_charset(spark, charset)
    wide = wide_charset(spark, charset)
    if wide:
        return wide_lines(spark, path, *wide, carry)
    reader = spark.read if line_end is None else spark.read.option("lineSep", line_end)
    raw = reader.text(path)
    extra = [column.alias(name) for name, column in (carry or {}).items()]
    if is_utf8(charset):
        return raw.select(LINE, *extra) if extra else raw.select(LINE)
    with _any_java_charset(spark):
        return raw.select(F.decode(F.col(LINE).cast("binary"), charset).alias(LINE), *extra)


def wide_lines(spark: SparkSession, path: str | list[str], unit: int, order: str | None, carry: dict[str, Column] | None = None) -> DataFrame:
    """Lines of UTF-16 or UTF-32 files, read by splits like any others.

    The scan cuts at the bytes of an encoded newline wherever they are. Such bytes may also end one character and begin the next;
    then the bytes before them are no whole number of characters, counted from the start of the file, and the
    line goes on. Where no byte order is named, each file's mark decides (without one the order is BE), which costs a look at all files.
    """
    if order is None:
        found = _byte_orders(spark, path, unit)
        if not found:
            return spark.read.text(path).select(LINE, *[column.alias(name) for name, column in (carry or {}).items()]).limit(0)
        frames = [wide_lines(spark, names, unit, each, carry) for each, names in sorted(found.items())]
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    places = place_columns()
    extra = {name: column for name, column in (carry or {}).items() if name not in places}
    charset = f"UTF-{8 * unit}{order}"
    raw = spark.read.option("encoding", charset).option("lineSep", "\n").text(path)
    as_letters = F.decode(F.col(LINE).cast("binary"), "ISO-8859-1").alias(LINE)  # a letter per byte
    lines = raw.select(as_letters, *[column.alias(name) for name, column in (places | extra).items()])
    glue = "\n".encode(charset).decode("latin-1")
    whole = join_lines(lines, F.lit(False), F.length(LINE) % unit, glue, list(extra), modulus=unit)
    with _any_java_charset(spark):
        decoded = whole.withColumn(LINE, F.decode(F.encode(LINE, "ISO-8859-1"), charset))
    text = F.when(F.col(SPLIT) == 0, F.regexp_replace(LINE, "^\ufeff", "")).otherwise(F.col(LINE))
    return decoded.select(F.regexp_replace(text, "\r$", "").alias(LINE), *(carry or {}))


def _byte_orders(spark: SparkSession, path: str | list[str], unit: int) -> dict[str, list[str]]:
    """The names of the files of either byte order, by the mark at their start; as many names as a scan's file index holds."""
    places = place_columns()
    raw = spark.read.option("lineSep", "\n").text(path).select(F.substring(F.col(LINE).cast("binary"), 1, unit).alias("mark"), *[c.alias(n) for n, c in places.items()])
    marks = raw.groupBy(SOURCE).agg(F.min_by("mark", F.struct(SPLIT, ROW)).alias("mark")).collect()
    little = "\ufeff".encode("UTF-16LE" if unit == 2 else "UTF-32LE")
    out: dict[str, list[str]] = {}
    for r in marks:
        out.setdefault("LE" if bytes(r["mark"]) == little else "BE", []).append(unquote(r[SOURCE]))
    return out


def record_lines(spark: SparkSession, path: str | list[str], options: ReadOptions, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per record of files whose quoted fields may hold line ends, read by splits.

    Whether a line begins inside quotes is a state of :mod:`sheaftext.operators.records`. Line ends are a newline, with or without
    a carriage return before it; inside a record of the second kind they become plain newlines.
    """
    places = place_columns()
    lines = text_lines(spark, path, options.charset, {**places, **{n: c for n, c in (carry or {}).items() if n not in places}}, line_end="\n")
    whole = join_records(lines, options, [name for name in (carry or {}) if name not in places])
    return whole.select(*(carry or {}), LINE)


def join_records(lines: DataFrame, options: ReadOptions, carry: list[str]) -> DataFrame:
    line = F.col(LINE)
    if options.quote is None:
        return lines
    quoted = F.contains(line, F.lit(options.quote))
    # from outside: a comment or a line without quotes opens nothing; from inside, the line goes on a field that a quote has opened
    outside = F.when(quoted & is_data_line(line, options), opens_unclosed_quote(line, options).cast("int")).otherwise(0)
    inside = F.when(quoted, opens_unclosed_quote(F.concat(F.lit(options.quote + "\ue000"), line), options).cast("int")).otherwise(1)
    whole = join_lines(lines, outside == inside, outside, "\n", carry)
    plain = F.regexp_replace(F.regexp_replace(line, "\r$", ""), "\r\n", "\n")
    return whole.withColumn(LINE, F.when(F.endswith(line, F.lit("\r")), plain).otherwise(line))


#: Lines at the start of a file that may hold its header record.
HEADER_LINES = 256


def first_record(spark: SparkSession, path: str | list[str], options: ReadOptions) -> str | None:
    """The first record that is neither blank nor a comment, from the first lines of a scan."""
    lines = text_lines(spark, path, options.charset, place_columns(), line_end="\n").limit(HEADER_LINES)
    rows = [tuple(r) for r in lines.select(SOURCE, SPLIT, ROW, LINE).collect()]
    few = spark.createDataFrame(rows, f"{SOURCE} string, {SPLIT} bigint, {ROW} bigint, {LINE} string").coalesce(1)
    order = {key[:3]: k for k, key in enumerate(rows)}
    line = F.col(LINE)
    found = join_records(few, options, []).where(is_data_line(line, options) & (F.trim(line) != "")).collect()
    return min(found, key=lambda r: order[(r[SOURCE], r[SPLIT], r[ROW])])[LINE] if found else None


def is_data_line(line: Column, options: ReadOptions) -> Column:
    """Neither empty nor a comment."""
    keep = line != ""
    if options.comment is not None:
        keep = keep & ~line.startswith(options.comment)
    return keep


def opens_unclosed_quote(line: Column, options: ReadOptions) -> Column:
    """Whether a field opens a quote that the line never closes; meant for the few lines that are not complete.

    Escaped characters go first, then every closed field; an opening quote that is left over never closes.
    """
    if options.quote is None:
        return F.lit(False)
    q, s, e = (re.escape(c) for c in (options.quote, options.delimiter, options.escape_char))
    escaped = q + q if options.escape_char == options.quote else f"{e}[{q}{e}]"
    lead = r"[ \t]*" if options.ignore_leading_white_space else ""
    plain = F.regexp_replace(line, escaped, "")
    closed = F.regexp_replace(plain, f"(^|{s}){lead}{q}[^{q}]*{q}[^{q}{s}]*(?={s}|$)", "$1")
    return closed.rlike(f"(^|{s}){lead}{q}")


def first_line(lines: DataFrame, options: ReadOptions) -> str | None:
    """The first line that is neither blank nor a comment; a head job that stops at the first hit."""
    keep = is_data_line(F.col(LINE), options) & (F.trim(F.col(LINE)) != "")
    row = lines.where(keep).select(LINE).head()
    return None if row is None else row[0]


def header_names(line: str, options: ReadOptions) -> list[str]:
    """Field texts of one header line under the dialect (a single line, on the driver), whatever its length."""
    csv.field_size_limit(sys.maxsize)
    delimiter = options.delimiter
    if delimiter in "\r\n":  # the csv module takes these for line ends only
        delimiter = "\ue000"
        line = line.replace(options.delimiter, delimiter)
    if options.quote is None:
        dialect = {"quoting": csv.QUOTE_NONE}
    elif options.escape_char == options.quote:
        dialect = {"quotechar": options.quote, "doublequote": True}
    else:
        dialect = {"quotechar": options.quote, "doublequote": False, "escapechar": options.escape_char}
    names = next(csv.reader([line], delimiter=delimiter, **dialect))
    if options.ignore_leading_white_space:
        names = [name.lstrip() for name in names]
    if options.ignore_trailing_white_space:
        names = [name.rstrip() for name in names]
    return names


def positional_names(width: int) -> list[str]:
    return [f"C{i}" for i in range(width)]


def data_lines(lines: DataFrame, options: ReadOptions, header_line: str | None = None) -> DataFrame:
    """Lines to parse: not empty, no comment, and not equal to the header line wherever that line recurs."""
    kept = lines.where(is_data_line(F.col(LINE), options))
    return kept if header_line is None else kept.where(F.col(LINE) != header_line)
