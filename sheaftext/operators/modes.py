"""What happens to malformed rows: keep, drop, fail, or set aside with a reason.

Every mode is a predicate over all columns of the schema, so the surviving rows do not depend on what the
query later selects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.functions.casts import Cell, cell, token_of
from sheaftext.options import DROPMALFORMED, FAILFAST, ReadOptions
from sheaftext.sources.tokens import UNBALANCED, Tokens

REASON = "reason"
BAD_COLUMN = "bad_column"
TOKEN_COUNT = "token_count"
KEEP = "__keep"


def shape_reason(tokens: Tokens) -> Column:
    """Why a line does not have the shape of the schema; null when it has."""
    ragged = (
        F.when(tokens.count == UNBALANCED, "unbalanced_quote")
        .when(tokens.count > tokens.width, "too_many_tokens")
        .otherwise("too_few_tokens")
    )
    return F.when(tokens.complete, F.when(tokens.too_long, "field_too_long")).otherwise(ragged)


def full_cells(tokens: Tokens, schema: T.StructType, options: ReadOptions) -> list[Cell]:
    """The cells of complete lines."""
    return [cell(token_of(raw, field, options), field, options) for raw, field in zip(tokens.raw, schema.fields)]


def first_bad_column(cells: list[Cell]) -> Column:
    """Name of the first column whose token does not fit its type; null when all do."""
    checks = [F.when(c.is_bad(), F.lit(c.field.name)) for c in cells if not c.is_text]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def is_well_formed(tokens: Tokens, cells: list[Cell]) -> Column:
    keep = tokens.complete & ~tokens.too_long
    for c in cells:
        if not c.is_text:
            keep = keep & ~c.is_bad()
    return keep


def apply_mode(tokens: Tokens, schema: T.StructType, options: ReadOptions, carry: list[str] | None = None) -> DataFrame:
    """Typed rows under ``options.mode``, with the ``carry`` columns after them."""
    if options.mode == DROPMALFORMED:
        return _well_formed(tokens, schema, options, carry, within_limit(tokens.too_long, options))
    if options.mode == FAILFAST:
        cells = full_cells(tokens, schema, options)
        message = F.concat(F.lit("Malformed line in FAILFAST mode: "), tokens.line)
        rows = tokens.frame.where(_or_raise(tokens.complete & ~tokens.too_long, message))
        return rows.select(*[c.typed("error") for c in cells], *(carry or []))
    return _permissive(tokens, schema, options, carry)


def _permissive(tokens: Tokens, schema: T.StructType, options: ReadOptions, carry: list[str] | None) -> DataFrame:
    """Every line whose quotes close; a field of the wrong type is an error, or null on request; one that is too long is an error."""
    keep, raw = ~tokens.unbalanced & within_limit(tokens.too_long, options), tokens.raw
    # tokens become columns of their own, so that the casts refer to short names and their code stays small
    shown = [
        F.when(present, token_of(c, field, options)).alias(shown_name(i))
        for i, (c, field, present) in enumerate(zip(raw, schema.fields, tokens.present))
    ]
    rows = keep_where(tokens.frame, keep, shown, carry)
    cells = [cell(F.col(shown_name(i)), field, options) for i, field in enumerate(schema.fields)]
    return rows.select(*[c.typed(options.on_bad_cast) for c in cells], *(carry or []))


def shown_name(i: int) -> str:
    return f"__s{i}"


def keep_where(frame: DataFrame, condition: Column, values: list[Column], carry: list[str] | None = None) -> DataFrame:
    """``values`` of the rows where ``condition`` holds, evaluating what the two share once per row.

    Written as a plain filter, the condition is pushed below the projection and every cast in it runs twice. A
    row id in the condition keeps it where it is.
    """
    here = condition & (F.monotonically_increasing_id() >= 0)
    return frame.select(*values, *(carry or []), here.alias(KEEP)).where(KEEP).drop(KEEP)


def within_limit(too_long: Column, options: ReadOptions) -> Column:
    """Raises for a field beyond the limit that the user has set."""
    if options.max_chars_per_col is None:
        return F.lit(True)
    return _or_raise(~too_long, F.lit(f"field longer than {options.max_chars_per_col} characters"))


def _well_formed(tokens: Tokens, schema: T.StructType, options: ReadOptions, carry: list[str] | None, limit: Column) -> DataFrame:
    cells = full_cells(tokens, schema, options)
    return keep_where(tokens.frame, limit & is_well_formed(tokens, cells), [c.typed("null") for c in cells], carry)


def _or_raise(condition: Column, message: Column) -> Column:
    return F.coalesce(F.when(condition, True), F.raise_error(message).cast("boolean"))


def quarantine(tokens: Tokens, schema: T.StructType, options: ReadOptions, carry: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines). A rejected line keeps its text, reason, token count and first bad column."""
    good = _well_formed(tokens, schema, options, carry, F.lit(True))
    return good, rejected_lines(tokens, schema, options, carry)


def rejected_lines(tokens: Tokens, schema: T.StructType, options: ReadOptions, carry: list[str] | None = None) -> DataFrame:
    checked = tokens.frame.select(
        *(carry or []),
        tokens.line.alias("line"),
        shape_reason(tokens).alias(REASON),
        F.when(tokens.count.between(0, tokens.width), tokens.count).alias(TOKEN_COUNT),
        first_bad_column(full_cells(tokens, schema, options)).alias(BAD_COLUMN),
    )
    rejected = checked.where(F.col(REASON).isNotNull() | F.col(BAD_COLUMN).isNotNull())
    shaped = F.col(REASON).isNotNull()
    return rejected.select(
        *(carry or []),
        "line",
        F.coalesce(REASON, F.lit("bad_value")).alias(REASON),
        TOKEN_COUNT,
        F.when(~shaped, F.col(BAD_COLUMN)).alias(BAD_COLUMN),
    )
