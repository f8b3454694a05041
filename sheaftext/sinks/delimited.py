"""Writing delimited text.

``MINIMAL`` and ``ALL`` quoting go through Spark's CSV writer. ``NON_NUMERIC``, ``NONE`` and unquoted output are
formatted to lines by expressions and written as text, since Spark's writer has no such modes.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.options import WriteOptions, merged, required_path
from sheaftext.session import scratch_path
from sheaftext.sinks.folders import delete_folder, exists, file_system, files_of, replace_folder, swap_folder

NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
DATED = (T.DateType, T.TimestampType, T.TimestampNTZType)


def check_flat(schema: T.StructType) -> None:
    nested = [f.name for f in schema.fields if isinstance(f.dataType, NESTED)]
    if nested:
        raise TypeError(f"columns without a text form: {', '.join(nested)}; convert them first, e.g. with to_json")


def text_of(field: T.StructField, options: WriteOptions) -> Column:
    """A column as text; dates and timestamps share one pattern."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampNTZType):
        # date_format would take the time through the session zone
        pattern = {"timestampNTZFormat": options.date_format, "sep": "\ue000", "quote": "\uf8ff", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        return F.when(column.isNotNull(), F.to_csv(F.struct(column), pattern))
    if isinstance(field.dataType, DATED):
        return F.date_format(column, options.date_format)
    return column.cast("string")


def _quoted(text: Column, options: WriteOptions) -> Column:
    """The text between quotes; the escape goes before quotes inside, and before itself when it is no quote."""
    q, e = options.quote, options.escape_char
    body = text if e == q else F.replace(text, F.lit(e), F.lit(e + e))
    return F.concat(F.lit(q), F.replace(body, F.lit(q), F.lit(e + q)), F.lit(q))


def _escaped(text: Column, options: WriteOptions) -> Column:
    """The text without quotes; the escape goes before delimiters and itself, line breaks become letters."""
    e = options.escape
    if e is None:
        return text
    steps = [(e, e + e), (options.delimiter, e + options.delimiter), ("\r", e + "r"), ("\n", e + "n")]
    for old, new in steps:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def format_field(field: T.StructField, options: WriteOptions) -> Column:
    text = F.coalesce(text_of(field, options), F.lit(options.null_value))
    if options.quote is None or options.quote_mode == "NONE":
        return _escaped(text, options)
    bare = options.quote_mode == "NON_NUMERIC" and isinstance(field.dataType, T.NumericType)
    if options.quote_mode == "ALL" or (options.quote_mode == "NON_NUMERIC" and not bare):
        return _quoted(text, options)
    special = [options.delimiter, options.quote, "\r", "\n"]
    if bare:
        # a null among numbers is text, and text is quoted
        return F.when(F.col(f"`{field.name}`").isNull(), _quoted(text, options)).otherwise(text)
    needs = F.lit(False)
    for mark in special:
        needs = needs | F.contains(text, F.lit(mark))
    return F.when(needs, _quoted(text, options)).otherwise(text)


def format_lines(df: DataFrame, options: WriteOptions | Mapping | None = None, **overrides) -> DataFrame:
    """One ``value`` column with the finished lines."""
    opts = merged(WriteOptions, options, overrides)
    check_flat(df.schema)
    return df.select(F.concat_ws(opts.delimiter, *[format_field(f, opts) for f in df.schema.fields]).alias("value"))


def header_line(schema: T.StructType, options: WriteOptions) -> Column:
    """The header as a literal line under the same quoting."""
    names = [F.lit(f.name) for f in schema.fields]
    if options.quote is None or options.quote_mode == "NONE":
        names = [_escaped(n, options) for n in names]
    else:
        names = [_quoted(n, options) for n in names]
    return F.concat_ws(options.delimiter, *names)


def _with_header(lines: DataFrame, header: Column, limit: int) -> DataFrame:
    """Put the header in front of the first row of each part file: of a partition, and after every ``limit`` rows if there is a limit."""
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    first = row % limit == 0 if limit else row == 0
    return lines.select(F.when(first, F.concat(header, F.lit("\n"), F.col("value"))).otherwise(F.col("value")).alias("value"))


def _rows_per_file(spark: SparkSession, opts: WriteOptions) -> int:
    """The most records of a file, 0 for any number; the session's limit holds where the options have none."""
    limit = opts.max_records_per_file
    return max(0, int(spark.conf.get("spark.sql.files.maxRecordsPerFile", "0")) if limit is None else limit)


def write_delimited(
    df: DataFrame,
    path: str,
    options: WriteOptions | Mapping | None = None,
    save_mode: str = "errorifexists",
    **overrides,
) -> None:
    """Write ``df`` as delimited text; every part file starts with the header if one is asked for.

    ``save_mode`` is one of errorifexists, overwrite, ignore, append.
    """
    opts = merged(WriteOptions, options, overrides)
    check_flat(df.schema)
    if opts.quote is not None and opts.quote_mode in ("MINIMAL", "ALL"):
        _write_csv(df, path, opts, save_mode)
    else:
        _write_text(df, path, opts, save_mode)


def _write_csv(df: DataFrame, path: str, opts: WriteOptions, save_mode: str) -> None:
    dated = {f.name: F.date_format(f"`{f.name}`", opts.date_format) for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType))}
    writer = df.withColumns(dated).write.mode(save_mode).options(
        sep=opts.delimiter,
        quote=opts.quote,
        escape=opts.escape_char,
        header=opts.header,
        nullValue=opts.null_value,
        emptyValue=opts.quote * 2,
        quoteAll=opts.quote_mode == "ALL",
        timestampNTZFormat=opts.date_format,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=_rows_per_file(df.sparkSession, opts),
    )
    if opts.codec:
        writer = writer.option("compression", opts.codec)
    writer.csv(path)


def _write_text(df: DataFrame, path: str, opts: WriteOptions, save_mode: str) -> None:
    lines, spark = format_lines(df, opts), df.sparkSession
    codec, limit = {"compression": opts.codec} if opts.codec else {}, _rows_per_file(spark, opts)
    write = lambda rows: rows.write.mode(save_mode).options(maxRecordsPerFile=str(limit), **codec).text(path)
    if not opts.header:
        write(lines)
        return
    if save_mode == "ignore" and exists(spark, path):
        return
    header = header_line(df.schema, opts)
    write(_with_header(lines, header, limit))
    _fill_empty_part(spark, path, header, codec)


def _fill_empty_part(spark: SparkSession, path: str, header: Column, codec: dict[str, str]) -> None:
    """The header for a part file without rows, which had no row to carry it. Only the first partition writes such a file."""
    root, files = file_system(spark, path)
    for found in files.globStatus(file_system(spark, f"{root.toString()}/part-00000*")[0]):
        name = found.getPath().getName()
        if not spark.read.text(f"{path}/{name}").isEmpty():
            continue
        made = scratch_path(spark, "header")
        spark.range(1, numPartitions=1).select(header.alias("value")).write.options(**codec).text(made)
        part = files_of(spark, made)[0]
        replace_folder(spark, part, f"{path}/{name}")
        delete_folder(spark, made)


def save_with_options(df: DataFrame, options: Mapping[str, str], save_mode: str = "errorifexists") -> None:
    """Everything, the path included, from a map of strings."""
    write_delimited(df, required_path(options), WriteOptions.from_map(options), save_mode)


def insert_overwrite(df: DataFrame, path: str | None, options: WriteOptions | Mapping | None = None, **overrides) -> None:
    """Replace the contents of a delimited table at ``path``, also by rows that were read from it.

    The rows are written beside the table first; only then do they take the place of the old files. A view made over the path before
    holds the names of the old files until ``REFRESH TABLE``.
    """
    if not path:
        raise ValueError("Cannot INSERT into table with no path defined")
    spark, place = df.sparkSession, path.rstrip("/")
    staged = f"{place}-staged-{uuid.uuid4().hex}"
    try:
        write_delimited(df, staged, options, "errorifexists", **overrides)
        swap_folder(spark, staged, place)
    finally:
        delete_folder(spark, staged)
    spark.catalog.refreshByPath(place)
