"""Splitting a line on a delimiter, without quoting rules, and casting the pieces by schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.functions.casts import INTEGRAL, by_pattern, to_decimal, to_integral
from sheaftext.sources.lines import LINE


def cast_piece(piece: Column, dtype: T.DataType) -> Column:
    """One piece as ``dtype``; null when it does not fit.

    Strings lose a pair of outer double quotes, decimals take a comma, dates and timestamps are read from their
    digits. A timestamp keeps up to six digits of its fraction.
    """
    if isinstance(dtype, T.StringType):
        quoted = piece.startswith('"') & piece.endswith('"') & (F.length(piece) >= 2)
        return F.when(quoted, F.substring(piece, 2, F.length(piece) - 2)).otherwise(piece)
    if isinstance(dtype, INTEGRAL):
        return to_integral(F.trim(piece), dtype)
    if isinstance(dtype, T.DecimalType):
        return to_decimal(piece, dtype, "legacy")
    if isinstance(dtype, T.DateType):
        digits = F.translate(piece, "-", "")
        return F.try_to_timestamp(F.substring(digits, 1, 8), F.lit("yyyyMMdd")).cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        digits = F.translate(piece, '-."', "")
        whole = F.substring(digits, 1, 14)
        fraction = F.rpad(F.substring(digits, 15, 6), 6, "0")
        return by_pattern(F.concat_ws(".", whole, fraction), "yyyyMMddHHmmss.SSSSSS", dtype)
    return piece.try_cast(dtype)


def split_and_cast(lines: DataFrame, schema: T.StructType, delimiter: str = ";", column: str = LINE, carry: list[str] | None = None) -> DataFrame:
    """Typed rows; pieces beyond the schema are ignored and absent ones are null."""
    # exploding the one-element array evaluates the split once per line
    pieces = lines.select(*(carry or []), F.explode(F.array(F.split(F.col(column), _literal(delimiter)))).alias("__pieces"))
    values = [
        cast_piece(F.get(F.col("__pieces"), F.lit(i)), field.dataType).alias(field.name)
        for i, field in enumerate(schema.fields)
    ]
    return pieces.select(*values, *(carry or []))


def _literal(delimiter: str) -> str:
    """The delimiter as a pattern that matches only itself."""
    return "\\Q" + delimiter + "\\E"
