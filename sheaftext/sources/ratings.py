"""Three-column ratings text: no quoting, no header, extra fields ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaftext.sources.lines import LINE

# The column names of a ratings table.
RATING_COLUMNS = ("usuario", "produto", "avaliacao")


def split_ratings(lines: DataFrame, column: str = LINE) -> DataFrame:
    """The first three comma-separated fields as strings; ``is_short`` marks lines with fewer, kept whole in ``line``."""
    fields = lines.select(F.col(column).alias("line"), F.explode(F.array(F.split(F.col(column), ","))).alias("fields"))
    named = [F.get(F.col("fields"), F.lit(i)).alias(name) for i, name in enumerate(RATING_COLUMNS)]
    short = F.size("fields") < len(RATING_COLUMNS)
    return fields.select(*named, F.when(short, F.col("line")).alias("line"), short.alias("is_short"))


def read_ratings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Ratings files; short lines are kept and marked."""
    return split_ratings(spark.read.text(path))
