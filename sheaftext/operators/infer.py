"""Schema inference in one pass.

Each token is one of six kinds; per column the kinds seen are or-ed into a bit mask, so partitions merge
without any effect of row order. Tokens are unpivoted first: the kind is one expression however many columns
there are, and each task hands on one mask per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.functions.casts import TIMESTAMP_TEXT, WHOLE_TEXT, hour_of_day
from sheaftext.options import DROPMALFORMED, ReadOptions
from sheaftext.sources.tokens import Tokens

INT, LONG, DOUBLE, TIMESTAMP, BOOLEAN, STRING = (1 << i for i in range(6))

# Fixed value: what counts as a floating number.
FLOAT_TEXT = r"^\s*[+-]?(NaN|Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?)\s*$"


def token_kind(token: Column, options: ReadOptions) -> Column:
    """The kind bit of a token; null for tokens that say nothing about the type."""
    silent = token.isNull() | (token == "")
    if options.null_value is not None and options.null_value != "":
        silent = silent | (token == options.null_value)
    # A cast or pattern that fails is slow, so plain tests come first: the first character, a point, a colon.
    first = F.ascii(token)
    starts_number = first.between(0, 32) | first.between(43, 57) | first.isin(73, 78)
    has_colon = F.contains(token, F.lit(":"))
    whole_kind = (
        F.when(F.length(token) <= 9, INT)
        .when(token.try_cast("bigint").between(-(2**31), 2**31 - 1), INT)
        .when(token.try_cast("bigint").isNotNull(), LONG)
        .otherwise(DOUBLE)
    )
    number = F.when(~F.contains(token, F.lit(".")) & token.rlike(WHOLE_TEXT), whole_kind).when(token.rlike(FLOAT_TEXT), DOUBLE)
    if options.date_format is None:
        is_timestamp = has_colon & token.rlike(TIMESTAMP_TEXT) & token.try_cast("timestamp_ntz").isNotNull()
    else:
        is_timestamp = F.try_to_timestamp(token, F.lit(hour_of_day(options.date_format))).isNotNull()
    rest = F.when(is_timestamp, TIMESTAMP).when(F.lower(token).isin("true", "false"), BOOLEAN).otherwise(STRING)
    return F.when(~silent, F.coalesce(F.when(starts_number & ~has_colon, number), rest))


def merged_type(mask: Column, timestamp_name: str = "timestamp") -> Column:
    """The narrowest type that holds every kind in the mask; kinds of different families make a string."""
    return (
        F.when(F.coalesce(mask, F.lit(0)) == 0, "string")
        .when(mask == TIMESTAMP, timestamp_name)
        .when(mask == BOOLEAN, "boolean")
        .when(mask > INT + LONG + DOUBLE, "string")
        .when(mask >= DOUBLE, "double")
        .when(mask >= LONG, "bigint")
        .otherwise("int")
    )


def kind_masks(tokens: Tokens, options: ReadOptions) -> DataFrame:
    """Rows of (position, mask) for every column with lines. Ragged lines count only if the mode keeps them."""
    if options.mode == DROPMALFORMED:
        rows, cells = tokens.frame.where(tokens.complete), tokens.raw
    else:
        rows, cells = tokens.frame.where(~tokens.unbalanced), [F.when(p, c) for c, p in zip(tokens.raw, tokens.present)]
    unpivoted = rows.select(F.posexplode(F.array(*cells)).alias("position", "token"))
    # distinct kinds first: they are computed once per token as a grouping key, and few are left to combine
    seen = unpivoted.select("position", token_kind(F.col("token"), options).alias("kind")).distinct()
    return seen.groupBy("position").agg(F.bit_or("kind").alias("mask"))


def inferred_types(tokens: Tokens, names: list[str], options: ReadOptions) -> DataFrame:
    """Rows of (position, column_name, data_type), one per column."""
    timestamp = "timestamp_ntz" if options.timestamp_ntz else "timestamp"
    masks = kind_masks(tokens, options).agg(F.map_from_entries(F.collect_list(F.struct("position", "mask"))).alias("masks"))
    columns = F.posexplode(F.array(*[F.lit(name) for name in names])).alias("position", "column_name")
    return masks.select("masks", columns).select(
        "position", "column_name", merged_type(F.try_element_at("masks", F.col("position")), timestamp).alias("data_type")
    )


def infer_schema(tokens: Tokens, names: list[str], options: ReadOptions) -> T.StructType:
    """The inferred schema; one row per column comes to the driver."""
    rows = sorted(inferred_types(tokens, names, options).collect())
    return T.StructType([T.StructField(r.column_name, T.DataType.fromDDL(r.data_type), True) for r in rows])
