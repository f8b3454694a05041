"""Lines to token columns.

Each line gets one more field, an end marker, before Spark's own CSV parser splits it into ``width + 1`` string
columns. Where the marker lands is the number of fields the line had; a marker swallowed by another field is a
quote that never closed. The parse sits in a generator, so the optimizer evaluates it once per line however
many predicates and casts refer to the tokens.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.options import ReadOptions
from sheaftext.sources.lines import LINE, opens_unclosed_quote

# Fixed value: private-use characters, never trimmed as blanks and not expected in text.
END_MARK = "\ue000\uf8ff\ue000"

COUNT = "__count"
UNBALANCED = -1


@dataclass(frozen=True)
class Tokens:
    """A frame of token columns plus the facts about each line that the modes need.

    ``raw`` are the tokens of a complete line, null where a field is empty. ``present`` says for each column
    whether the line had such a field at all. ``complete``: as many fields as the schema. ``count``: number of
    fields, -1 when a quote never closes, ``width + 1`` for any number above the width.
    ``too_long``: a field exceeds the length limit.
    """

    frame: DataFrame
    raw: list[Column]
    present: list[Column]
    complete: Column
    count: Column
    too_long: Column
    line: Column

    @property
    def width(self) -> int:
        return len(self.raw)

    @property
    def unbalanced(self) -> Column:
        # the cheap test first: almost every line is complete
        return ~self.complete & self.count.eqNullSafe(F.lit(UNBALANCED))


def slot(i: int) -> str:
    return f"__t{i}"


# Columns that Spark's parser is ready for, when the schema needs no more.
MOST_COLUMNS = 20_480


def most_columns(width: int) -> int:
    return max(MOST_COLUMNS, width + 2)


def parser_options(options: ReadOptions, width: int = 0) -> dict[str, str]:
    """The dialect in the words of Spark's CSV parser."""
    return {
        "sep": options.delimiter,
        "quote": options.quote or "",
        "escape": options.escape_char or "\\",
        "mode": "PERMISSIVE",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": str(options.ignore_leading_white_space).lower(),
        "ignoreTrailingWhiteSpace": str(options.ignore_trailing_white_space).lower(),
        "maxCharsPerColumn": "-1",
        "maxColumns": str(most_columns(width)),
    }


def marked_line(options: ReadOptions, width: int) -> Column:
    """The line with its end marker; null for a line of more fields than the parser takes, which has too many anyway."""
    line, most = F.col(LINE), most_columns(width) - 1
    delimiters = lambda text: F.length(text) - F.length(F.replace(text, F.lit(options.delimiter), F.lit("")))
    outside = line
    if options.quote is not None:
        q = re.escape(options.quote)
        outside = F.regexp_replace(line, f"{q}[^{q}]*{q}", "")
    crowded = (F.length(line) >= most) & (delimiters(line) >= most) & (delimiters(outside) >= most)
    return F.when(~crowded, F.concat(line, F.lit(options.delimiter + END_MARK)))


def tokenise(lines: DataFrame, width: int, options: ReadOptions, carry: list[str] | None = None) -> Tokens:
    """Split the ``value`` column of ``lines`` into ``width`` tokens, keeping the ``carry`` columns."""
    slots = ", ".join(f"{slot(i)} string" for i in range(width + 1))
    parsed = F.from_csv(marked_line(options, width), slots, parser_options(options, width))
    split = lines.select(*(carry or []), LINE, F.inline(F.array(parsed)))
    raw = [F.col(slot(i)) for i in range(width + 1)]
    complete = raw[width].eqNullSafe(F.lit(END_MARK))
    position = F.array_position(F.array(*raw), F.lit(END_MARK)).cast("int")
    # a field that swallowed the marker is the last one with any text
    swallowed = F.concat_ws("", *raw).endswith(END_MARK)
    count = (
        F.when(complete, width)
        .when(position > 0, position - 1)
        .when(swallowed | opens_unclosed_quote(F.col(LINE), options), UNBALANCED)
        .otherwise(width + 1)
    )
    return Tokens(
        frame=split.select("*", count.alias(COUNT)),
        raw=raw[:width],
        present=[F.col(COUNT) > i for i in range(width)],
        complete=complete,
        count=F.col(COUNT),
        too_long=has_long_field(F.col(LINE), raw, options),
        line=F.col(LINE),
    )


def has_long_field(line: Column, raw: list[Column], options: ReadOptions) -> Column:
    """Whether a field exceeds the limit, if there is one; a field can only be too long on a line that is."""
    if options.max_chars_per_col is None or not raw:
        return F.lit(False)
    longest = F.greatest(*[F.coalesce(F.length(c), F.lit(0)) for c in raw], F.lit(0))
    return (F.length(line) > options.max_chars_per_col) & (longest > options.max_chars_per_col)


CORRUPT = "__corrupt"
