"""Reading delimited text: files, TSV files, columns of lines, SQL views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.functions.casts import check_castable
from sheaftext.operators import typed_parse
from sheaftext.operators.infer import infer_schema
from sheaftext.operators.modes import apply_mode, quarantine
from sheaftext.options import DROPMALFORMED, FAILFAST, ReadOptions, merged, required_path
from sheaftext.sources.lines import LINE, data_lines, first_line, first_record, header_names, positional_names, record_lines, text_lines
from sheaftext.sources.tokens import Tokens, parser_options, tokenise

Schema = T.StructType | str | None


def as_schema(schema: Schema) -> T.StructType | None:
    if schema is None:
        return None
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    check_castable(struct)
    return struct


class DelimitedLines:
    """Lines bound to a dialect and a schema, from which rows, rejected lines or types are derived."""

    def __init__(self, lines: DataFrame, schema: Schema, options: ReadOptions, carry: list[str] | None = None, find_head: Callable[[], str | None] | None = None):
        self.options = options
        self.carry = carry or []
        given = as_schema(schema)
        find_head = find_head or (lambda: first_line(lines, options))
        head = find_head() if options.header or given is None else None
        if given is None and head is None:
            raise ValueError("no line to take column names from; give a schema")
        self.names = given.fieldNames() if given else self._names(head)
        self.lines = data_lines(lines, options, head if options.header else None)
        self.schema = given or self._derived()

    @cached_property
    def tokens(self) -> Tokens:
        return tokenise(self.lines, len(self.names), self.options, self.carry)

    def _names(self, head: str) -> list[str]:
        names = header_names(head, self.options)
        return names if self.options.header else positional_names(len(names))

    def _derived(self) -> T.StructType:
        if self.options.infer_schema:
            return infer_schema(self.tokens, self.names, self.options)
        return T.StructType([T.StructField(name, T.StringType(), True) for name in self.names])

    def rows(self) -> DataFrame:
        if typed_parse.applies(self.options):
            return typed_parse.parse_well_formed(self.lines, self.schema, self.options, self.carry)
        return apply_mode(self.tokens, self.schema, self.options, self.carry)

    def good_and_rejected(self) -> tuple[DataFrame, DataFrame]:
        return quarantine(self.tokens, self.schema, self.options, self.carry)


def open_files(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema = None,
    options: ReadOptions | Mapping | None = None,
    carry: dict[str, Column] | None = None,
    **overrides,
) -> DelimitedLines:
    opts = merged(ReadOptions, options, overrides)
    if opts.multi_line:
        return DelimitedLines(record_lines(spark, path, opts, carry), schema, opts, list(carry or {}), lambda: first_record(spark, path, opts))
    lines = text_lines(spark, path, opts.charset, carry)
    return DelimitedLines(lines, schema, opts, list(carry or {}))


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema = None,
    options: ReadOptions | Mapping | None = None,
    carry: dict[str, Column] | None = None,
    **overrides,
) -> DataFrame:
    """Typed rows of delimited files. ``path`` may be a folder, a glob or a list; compressed files are read too.

    Without a schema the columns are strings named by the header or ``C0, C1, ...``; with ``infer_schema`` their
    types come from one extra pass. ``multi_line`` takes records whose quoted fields hold line ends; files are read by
    splits then as well. ``carry`` adds columns such as ``{"source": F.col("_metadata.file_path")}``.
    """
    return open_files(spark, path, schema, options, carry, **overrides).rows()


def read_with_options(spark: SparkSession, options: Mapping[str, str], schema: Schema = None) -> DataFrame:
    """Everything, the path included, from a map of strings."""
    return read_delimited(spark, required_path(options), schema, ReadOptions.from_map(options))


def read_tsv(spark: SparkSession, path: str | list[str], schema: Schema = None, **overrides) -> DataFrame:
    """Tab-separated files with a header line, ``\\`` as escape and ``#`` comments."""
    preset = {"delimiter": "\t", "quote": '"', "escape": "\\", "comment": "#", "header": True}
    return read_delimited(spark, path, schema, ReadOptions(**(preset | overrides)))


def parse_lines(
    lines: DataFrame,
    schema: Schema = None,
    options: ReadOptions | Mapping | None = None,
    column: str = LINE,
    carry: list[str] | None = None,
    **overrides,
) -> DataFrame:
    """Typed rows from a column of lines that already is a DataFrame."""
    return open_lines(lines, schema, options, column, carry, **overrides).rows()


def open_lines(
    lines: DataFrame,
    schema: Schema = None,
    options: ReadOptions | Mapping | None = None,
    column: str = LINE,
    carry: list[str] | None = None,
    **overrides,
) -> DelimitedLines:
    opts = merged(ReadOptions, options, overrides)
    source = lines.select(*(carry or []), F.col(column).alias(LINE))
    return DelimitedLines(source, schema, opts, carry)


def read_with_quarantine(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema,
    options: ReadOptions | Mapping | None = None,
    carry: dict[str, Column] | None = None,
    **overrides,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with reasons) of delimited files."""
    return open_files(spark, path, schema, options, carry, **overrides).good_and_rejected()


def create_delimited_view(
    spark: SparkSession, name: str, path: str, schema: str | None = None, options: ReadOptions | Mapping | None = None, writable: bool = False, **overrides
) -> None:
    """A temporary view over delimited files for SQL, with the rows that :func:`read_delimited` gives.

    ``writable`` declares it with ``USING csv`` instead, so that ``INSERT OVERWRITE`` works. That is Spark's own
    source, which lacks some of the options; asking for one of those raises, and only the first line of a file
    can be a header.
    """
    opts = merged(ReadOptions, options, overrides)
    if not writable:
        read_delimited(spark, path, schema, opts).createOrReplaceTempView(name)
        return
    lacking = _not_writable(schema, opts)
    if lacking:
        raise ValueError(f"a writable view cannot honour {', '.join(lacking)}")
    settings = parser_options(opts) | {
        "path": path,
        "header": str(opts.header).lower(),
        "mode": "FAILFAST" if opts.mode == FAILFAST else "PERMISSIVE",
        "inferSchema": str(opts.infer_schema).lower(),
        "preferDate": "false",
        "multiLine": str(opts.multi_line).lower(),
        "encoding": opts.charset,
        "nullValue": opts.null_value or "",
    }
    if opts.comment is not None:
        settings["comment"] = opts.comment
    if opts.date_format is not None:
        settings |= {"dateFormat": opts.date_format, "timestampFormat": opts.date_format}
    quoted = ", ".join(f"{_sql_text(k)} {_sql_text(v)}" for k, v in settings.items())
    columns = f" ({schema})" if schema else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}`{columns} USING csv OPTIONS ({quoted})")


def _not_writable(schema: str | None, opts: ReadOptions) -> list[str]:
    """The options that Spark's own source would read otherwise or not at all."""
    plain = ReadOptions()
    lacking = [f"{label}={value!r}" for label in ("profile", "locale", "treat_empty_values_as_nulls", "max_chars_per_col") if (value := getattr(opts, label)) != getattr(plain, label)]
    if opts.mode == DROPMALFORMED:
        lacking.append("mode='DROPMALFORMED'")
    elif opts.mode != FAILFAST and opts.on_bad_cast == "error" and (opts.infer_schema or not _all_text(schema)):
        lacking.append("on_bad_cast='error'")
    if schema is None and not opts.header:
        lacking.append("names C0, C1, ... (give a schema or a header)")
    return lacking


def _all_text(schema: str | None) -> bool:
    return all(isinstance(f.dataType, T.StringType) for f in (as_schema(schema) or T.StructType()).fields)


def _sql_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
