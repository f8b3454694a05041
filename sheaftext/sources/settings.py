"""Load settings from ``key=value`` text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaftext.operators.schema_docs import DOC, TEXT, read_documents
from sheaftext.options import ReadOptions

# Required keys, and optional keys with their defaults.
REQUIRED = ("retention", "hdfs_path_source", "hdfs_path_save", "database", "file_count", "os_path_source")
OPTIONAL = {"quote": '"', "delimiter": ";", "header": "false", "quoteMode": "NON_NUMERIC"}
# Fixed value: an older spelling of a key, accepted beside the right one.
ALIASES = {"demiliter": "delimiter"}


def setting_pairs(text: Column) -> Column:
    """An array of (position, key, value) of a text's lines; the value is everything after the first ``=``."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda line, i: F.struct(i.alias("position"), line.alias("line")))
    kept = F.filter(lines, lambda s: F.contains(s["line"], F.lit("=")))

    def pair(s: Column) -> Column:
        at = F.locate("=", s["line"])
        written = F.trim(F.substr(s["line"], F.lit(1), at - 1))
        key = written
        for old, new in ALIASES.items():
            key = F.when(written == old, new).otherwise(key)
        return F.struct(s["position"].alias("position"), key.alias("key"), F.substr(s["line"], at + 1).alias("value"))

    return F.transform(kept, pair)


def settings_table(documents: DataFrame) -> DataFrame:
    """One row per document: its settings with defaults filled in, and the required keys it lacks.

    A key that is written more than once keeps its first value, also where a document comes in several rows; a document without name
    has no settings. A row keeps its lines together: only the first value of each key is shuffled and sorted.
    """
    keys = (*REQUIRED, *OPTIONAL)
    first_of = lambda k: F.get(F.filter("pairs", lambda p: p["key"] == k), F.lit(0))
    named = documents.select(DOC, F.when(F.col(DOC).isNotNull(), setting_pairs(F.col(TEXT))).alias("pairs"))
    each = named.select(DOC, *[first_of(k).alias(k) for k in keys])
    rows = Window.partitionBy(DOC)
    complete = each.select(DOC, *[F.min(k).over(rows)["value"].alias(k) for k in keys])
    empty = lambda k: F.coalesce(F.col(k), F.lit("")) == ""
    missing = F.filter(F.array(*[F.when(empty(k), F.lit(k)) for k in REQUIRED]), lambda k: k.isNotNull())
    typed = {k: F.col(k).try_cast("int") if k in ("retention", "file_count") else F.col(k) for k in REQUIRED}
    return complete.select(
        DOC,
        *[column.alias(k) for k, column in typed.items()],
        *[F.coalesce(F.col(k), F.lit(default)).alias(k) for k, default in OPTIONAL.items()],
        missing.alias("missing"),
    )


@dataclass(frozen=True)
class LoadSettings:
    """The settings of one table's load."""

    retention: int
    source_path: str
    save_path: str
    database: str
    file_count: int
    landing_path: str
    dialect: ReadOptions
    quote_mode: str


def read_settings(spark: SparkSession, path: str) -> LoadSettings:
    """Settings from one file; raises when a required key is missing or a number is none."""
    row = settings_table(read_documents(spark, path)).head()
    if row is None:
        raise FileNotFoundError(f"no settings at {path}")
    if row.missing:
        raise ValueError(f"no setting for {', '.join(row.missing)} in {path}")
    if row.retention is None or row.file_count is None:
        raise ValueError(f"retention and file_count must be whole numbers in {path}")
    dialect = ReadOptions(delimiter=row.delimiter, quote=row.quote, header=row.header, profile="legacy")
    return LoadSettings(
        row.retention, row.hdfs_path_source, row.hdfs_path_save, row.database, row.file_count, row.os_path_source, dialect, row.quoteMode
    )
