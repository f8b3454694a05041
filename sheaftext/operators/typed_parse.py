"""DROPMALFORMED in one parse: whole numbers, booleans and decimals typed by Spark's CSV parser itself.

Spark's parser reads these types exactly as the standard profile does and reports a misfit in its corrupt-record
column, so the query needs no cast per column. It applies when empty text is the null text of a nullable column;
all other columns, and all other rules, are cast from their tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.functions.casts import INTEGRAL, Cell, cell, token_of
from sheaftext.operators.modes import keep_where, within_limit
from sheaftext.options import DROPMALFORMED, ReadOptions
from sheaftext.sources.lines import LINE
from sheaftext.sources.tokens import CORRUPT, END_MARK, has_long_field, marked_line, parser_options, slot


def applies(options: ReadOptions) -> bool:
    return options.mode == DROPMALFORMED and options.profile == "standard" and options.null_value == ""


def by_parser(field: T.StructField) -> bool:
    return field.nullable and isinstance(field.dataType, (*INTEGRAL, T.BooleanType, T.DecimalType))


def parse_well_formed(lines: DataFrame, schema: T.StructType, options: ReadOptions, carry: list[str] | None = None) -> DataFrame:
    """Typed rows of the lines that have the schema's shape and types."""
    fields = schema.fields
    width = len(fields)
    kinds = [f.dataType.simpleString() if by_parser(f) else "string" for f in fields]
    slots = ", ".join(f"{slot(i)} {kind}" for i, kind in enumerate(kinds))
    settings = parser_options(options, width) | {"columnNameOfCorruptRecord": CORRUPT, "locale": "en-US"}
    parsed = F.from_csv(marked_line(options, width), f"{slots}, {slot(width)} string, {CORRUPT} string", settings)
    frame = lines.select(*(carry or []), LINE, F.inline(F.array(parsed)))
    texts = [F.col(slot(i)) for i, f in enumerate(fields) if not by_parser(f)]
    limit = within_limit(has_long_field(F.col(LINE), texts, options), options)
    good = limit & (F.col(slot(width)) == END_MARK) & F.col(CORRUPT).isNull()
    values = []
    for i, field in enumerate(fields):
        if by_parser(field):
            values.append(F.col(slot(i)).alias(field.name))
            continue
        text: Cell = cell(token_of(F.col(slot(i)), field, options), field, options)
        values.append(text.typed("null"))
        if not text.is_text:
            good = good & ~text.is_bad()
    return keep_where(frame, good, values, carry)
