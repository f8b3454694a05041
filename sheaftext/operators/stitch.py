"""Re-joining records that were cut in two.

In a file's line order, a line with too few fields takes its successor, whatever that is, and the pair is not
looked at again; the last line of a file stays as it is. So a line either is taken by the one before it or not: a long line is
never followed by a taken one, and a short one hands the question on, turned around. That is a step of
:mod:`sheaftext.operators.records`, which follows it through blocks and splits without a window per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaftext.operators.records import BLOCK_BITS, ROW, SOURCE, SPLIT, join_lines, place_columns
from sheaftext.sources.lines import LINE, text_lines

__all__ = ["ROW", "SOURCE", "SPLIT", "is_short", "numbered_lines", "stitch_lines"]


def numbered_lines(spark: SparkSession, path: str | list[str], charset: str = "UTF-8") -> DataFrame:
    """Lines with their file, the offset of their split and a number that grows by one per line of a split.

    The three together give the line order inside a file without a shuffle.
    """
    return text_lines(spark, path, charset, carry=place_columns())


def is_short(line: Column, delimiter: str, min_fields: int) -> Column:
    """Fewer than ``min_fields`` fields, counting delimiters only."""
    delimiters = F.length(line) - F.length(F.replace(line, F.lit(delimiter), F.lit("")))
    return delimiters + 1 < min_fields


def stitch_lines(lines: DataFrame, delimiter: str = ";", min_fields: int = 5, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Whole records from :func:`numbered_lines`, in the same columns.

    Each short line that is due takes the next line of its file, also across splits; a line taken is not
    returned on its own. A block holds up to ``2 ** block_bits`` lines.
    """
    short = is_short(F.col(LINE), delimiter, min_fields)
    return join_lines(lines, fixed=~short, shift=F.when(short, 1).otherwise(0), glue="", block_bits=block_bits)
