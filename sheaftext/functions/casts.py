"""Token-to-value casts as column expressions.

A *token* is a string column holding one field of a line; it is null when the line had no such field. Every
function returns a column built from Spark's own expressions, so casts stay inside whole-stage codegen and
unused ones are pruned with their columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.options import ReadOptions, number_marks

CASTABLE = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DecimalType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DateType,
    T.StringType,
)

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)

# The exact spellings of a whole number, a decimal, and a timestamp and a date that need no pattern.
WHOLE_TEXT = r"^[+-]?\d+$"
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TIMESTAMP_TEXT = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?$"
DATE_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}$"

# Fixed value: the compact timestamp pattern of the legacy profile, after its separators are removed.
COMPACT_TIMESTAMP = "yyyyMMddHHmmss"


def check_castable(schema: T.StructType) -> None:
    """Refuse schemas that delimited text cannot carry."""
    for field in schema.fields:
        if not isinstance(field.dataType, CASTABLE):
            raise TypeError(f"Unsupported type: {field.dataType.typeName()} (column {field.name})")


def to_integral(token: Column, dtype: T.DataType) -> Column:
    """Digits with an optional sign; the pattern keeps out the blanks that Spark's cast would trim."""
    return F.when(token.rlike(WHOLE_TEXT), token.try_cast(dtype))


def to_floating(token: Column, dtype: T.DataType, locale: str = "en") -> Column:
    """Plain notation first, then the notation of ``locale``."""
    grouping, decimal = number_marks(locale)
    if decimal == ".":
        # text with a grouping mark is never plain, so one parse without the marks serves both notations
        return _spelled(token, _without(token, grouping).try_cast(dtype))
    # translate maps the decimal mark to a point and, having no counterpart for them, drops the grouping marks
    local_text = F.translate(token, decimal + grouping, ".")
    # a failing parse is slow: text with a comma is never plain, and text without marks has one reading only
    plain = F.when(~F.contains(token, F.lit(",")), token.try_cast(dtype))
    return _spelled(token, F.coalesce(plain, F.when(local_text != token, local_text.try_cast(dtype))))


def _spelled(token: Column, value: Column) -> Column:
    """Spark also takes nan, inf and the like in any case; inference calls these text. Only such values need a look at the text."""
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(odd, F.when(~token.rlike(r"(?i)^\s*[+-]?(nan|inf)") | token.rlike(r"^\s*[+-]?(NaN|Infinity)\s*$"), value)).otherwise(value)


def _without(token: Column, marks: str) -> Column:
    for mark in marks:
        token = F.replace(token, F.lit(mark), F.lit(""))
    return token


def to_boolean(token: Column) -> Column:
    return F.when(F.lower(token).isin("true", "false"), token.try_cast("boolean"))


def to_decimal(token: Column, dtype: T.DecimalType, profile: str = "standard") -> Column:
    """``standard`` drops comma thousands; ``legacy`` reads the comma as the decimal mark."""
    text = F.replace(token, F.lit(","), F.lit("." if profile == "legacy" else ""))
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast(dtype))


def to_timestamp(token: Column, dtype: T.DataType = T.TimestampType(), pattern: str | None = None) -> Column:
    """By ``pattern`` when given, else exactly ``yyyy-M-d H:m:s[.f]``."""
    if pattern is not None:
        return by_pattern(token, pattern, dtype)
    return F.when(token.rlike(TIMESTAMP_TEXT), token.try_cast(dtype))


def hour_of_day(pattern: str) -> str:
    """The pattern with ``h`` read as ``H`` outside quotes, unless it has an am/pm marker."""
    parts = pattern.split("'")
    if "a" in "".join(parts[::2]):
        return pattern
    return "'".join(part if i % 2 else part.replace("h", "H") for i, part in enumerate(parts))


def names_zone(pattern: str) -> bool:
    """Whether a pattern reads a time zone or an offset from the text."""
    return re.search("[VzOXxZ]", "".join(pattern.split("'")[::2])) is not None


def _wall_clock(token: Column, pattern: str) -> Column:
    """A time without zone by pattern: read as UTC and counted from the epoch, so the session zone has no part in it."""
    instant = F.try_to_timestamp(F.concat(token, F.lit("Z")), F.lit(pattern + "X"))
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def by_pattern(token: Column, pattern: str, dtype: T.DataType) -> Column:
    """Parse by pattern. ``h`` without an am/pm marker counts 1-12 from midnight but lets 13-23 through."""
    day_pattern = hour_of_day(pattern)
    if isinstance(dtype, T.TimestampNTZType) and not names_zone(pattern):
        parsed = _wall_clock(token, day_pattern)
    else:
        parsed = F.try_to_timestamp(token, F.lit(day_pattern))
    if day_pattern != pattern:
        parsed = F.when(F.hour(parsed) == 12, parsed - F.expr("INTERVAL 12 HOURS")).otherwise(parsed)
    return parsed.cast(dtype)


def to_compact_timestamp(token: Column, dtype: T.DataType = T.TimestampType()) -> Column:
    """Digits of year to second once ``- . : /`` are gone; anything after the seconds is cut.

    Text with a blank between date and time is read by :func:`to_timestamp`.
    """
    digits = F.translate(token, "-.:/", "")
    compact = by_pattern(F.substring(digits, 1, 14), COMPACT_TIMESTAMP, dtype)
    return F.when(F.contains(token, F.lit(" ")), to_timestamp(token, dtype)).when(F.length(digits) >= 14, compact)


def to_date(token: Column, pattern: str | None = None) -> Column:
    if pattern is not None:
        return by_pattern(token, pattern, T.TimestampNTZType()).cast("date")
    return F.when(token.rlike(DATE_TEXT), token.try_cast("date"))


def try_value(token: Column, dtype: T.DataType, options: ReadOptions) -> Column:
    """The typed value, or null when the token does not fit the type."""
    legacy = options.profile == "legacy"
    pattern = None if legacy else options.date_format
    if isinstance(dtype, T.StringType):
        return token
    if isinstance(dtype, INTEGRAL):
        return to_integral(token, dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return to_floating(token, dtype, options.locale)
    if isinstance(dtype, T.BooleanType):
        return to_boolean(token)
    if isinstance(dtype, T.DecimalType):
        return to_decimal(token, dtype, options.profile)
    if isinstance(dtype, TIMESTAMPS):
        return to_compact_timestamp(token, dtype) if legacy else to_timestamp(token, dtype, pattern)
    if isinstance(dtype, T.DateType):
        return to_date(token, pattern)
    raise TypeError(f"Unsupported type: {dtype.typeName()}")


@dataclass(frozen=True)
class Cell:
    """One column of a line: its token, the texts that stand for null, and the value when it fits the type.

    The token is null where the field is missing, and also where it is empty if empty stands for null.
    """

    field: T.StructField
    token: Column
    null_texts: tuple[str, ...]
    value: Column

    @property
    def is_text(self) -> bool:
        return isinstance(self.field.dataType, T.StringType)

    def has_value(self) -> Column:
        return ~self.token.isin(*self.null_texts) if self.null_texts else self.token.isNotNull()

    def is_bad(self) -> Column:
        """A token that does not stand for null and does not fit its type."""
        return F.coalesce(self.has_value(), F.lit(False)) & self.value.isNull()

    def typed(self, on_bad: str) -> Column:
        """The value; for a misfit null or an error, as ``on_bad`` says. A missing token is null."""
        value = self.value
        if on_bad == "error" and not self.is_text:
            # a constant message: text put together per row would make the generated code several times larger
            message = f"A value of column {self.field.name} does not fit type {self.field.dataType.simpleString()}"
            failure = F.when(self.has_value(), F.raise_error(F.lit(message)).cast(self.field.dataType))
            value = F.coalesce(F.when(self.has_value(), value) if self.null_texts else value, failure)
        elif self.null_texts:
            value = F.when(self.has_value(), value)
        return value.alias(self.field.name)


def null_texts(field: T.StructField, options: ReadOptions) -> list[str]:
    """The texts that stand for null in a column under the profile's rule."""
    if options.profile == "legacy":
        return ["null"] if isinstance(field.dataType, T.StringType) else ["null", ""]
    if not field.nullable:
        return []
    texts = [] if options.null_value is None else [options.null_value]
    return texts + [""] if options.treat_empty_values_as_nulls and "" not in texts else texts


def token_of(raw: Column, field: T.StructField, options: ReadOptions) -> Column:
    """The token of a raw field, which is null when empty: the empty text comes back unless it stands for null."""
    return raw if "" in null_texts(field, options) else F.coalesce(raw, F.lit(""))


def cell(token: Column, field: T.StructField, options: ReadOptions) -> Cell:
    texts = tuple(t for t in null_texts(field, options) if t != "")
    return Cell(field, token, texts, try_value(token, field.dataType, options))
