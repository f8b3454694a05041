"""Schemas kept in text: column dictionaries, DDL control files, and the drift between the two.

A document is a row of (``doc``, ``text``); many tables' documents are handled in one job. Only
:func:`dictionary_schema`, which makes the ``StructType`` of one table, brings rows to the driver: one per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC, TEXT = "doc", "text"

# Legacy type names and the Spark types they load as. Types with arguments are handled apart.
PLAIN_TYPES = {
    "DATE": "string",
    "SMALLINT": "int",
    "TIME": "string",
    "INTEGER": "int",
}
SIZED_TYPES = {
    "CHARACTER": "string",
    "TIMESTAMP": "timestamp",
}

# Fixed value: name of the load-date column that some dictionaries add.
LOAD_DATE_COLUMN = "DAT_REF_CARGA"

TYPE_SHAPE = r"^\s*([^,()]+?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*(?:,.*)?$"


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Small text files, one row each: path and whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias(DOC), F.col("value").alias(TEXT)
    )


def document_lines(documents: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Rows of (doc, position, line) in file order."""
    lines = documents.select(DOC, F.posexplode(F.split(TEXT, r"\r?\n")).alias("position", "line"))
    return lines if keep_blank else lines.where(F.trim("line") != "")


def legacy_type(type_text: Column) -> Column:
    """The Spark type, as DDL text, of a legacy type such as ``DECIMAL(9,2)``.

    A whole ``NUMERIC(n)`` is an int; with digits after the point it stays a decimal. Unknown types with
    arguments are strings; an unknown bare name is an error.
    """
    name = F.regexp_extract(type_text, TYPE_SHAPE, 1)
    precision = F.regexp_extract(type_text, TYPE_SHAPE, 2)
    scale = F.regexp_extract(type_text, TYPE_SHAPE, 3)
    decimal = F.concat(F.lit("decimal("), precision, F.lit(","), F.when(scale == "", "0").otherwise(scale), F.lit(")"))
    plain = F.coalesce(
        *[F.when(name == known, target) for known, target in PLAIN_TYPES.items()],
        F.raise_error(F.concat(F.lit("unknown type without size: "), type_text)).cast("string"),
    )
    result = F.when(precision == "", plain)
    for known, target in SIZED_TYPES.items():
        result = result.when(name == known, target)
    result = result.when(name == "DECIMAL", decimal)
    result = result.when((name == "NUMERIC") & ((scale == "") | (scale.try_cast("int") == 0)), "int")
    result = result.when(name == "NUMERIC", decimal)
    return result.otherwise("string")


def dictionary_columns(documents: DataFrame) -> DataFrame:
    """``NAME,TYPE`` lines as rows of (doc, position, column_name, legacy_type, data_type)."""
    lines = document_lines(documents)
    kind = F.regexp_extract("line", r"^[^,]*,(.*)$", 1)
    sized = F.regexp_extract(kind, r"^\s*([^,()]+(?:\([^)]*\))?)", 1)
    named = lines.select(
        DOC,
        "position",
        F.trim(F.split_part(F.col("line"), F.lit(","), F.lit(1))).alias("column_name"),
        F.regexp_replace(sized, r"\s+", "").alias("legacy_type"),
    )
    return named.withColumn("data_type", legacy_type(F.col("legacy_type")))


def dictionary_schema(spark: SparkSession, path: str, load_date: bool = False) -> T.StructType:
    """The schema of one dictionary file, every column nullable, in file order."""
    rows = sorted(dictionary_columns(read_documents(spark, path)).collect(), key=lambda r: r.position)
    if not rows:
        raise ValueError(f"empty dictionary: {path}")
    schema = T.StructType([T.StructField(r.column_name, T.DataType.fromDDL(r.data_type), True) for r in rows])
    return schema.add(LOAD_DATE_COLUMN, T.StringType(), True) if load_date else schema


# Tokens of a column list: plain text, quoted text, brackets without brackets or quotes inside, and single marks.
_TOKENS = """[^(),'"`]+|'[^']*'|"[^"]*"|`[^`]*`|\\([^()'"`]*\\)|[(),'"`]"""

# One pass over the tokens: depth of brackets, a quote that never closes, places of the commas between columns, end of the list.
_SCAN = """aggregate(
    tokens,
    named_struct('at', 0, 'depth', 0, 'open', false, 'cuts', array(0), 'end', -1),
    (s, t) -> if(s.end >= 0 or s.open, s, named_struct(
        'at', s.at + length(t),
        'depth', s.depth + case t when '(' then 1 when ')' then -1 else 0 end,
        'open', t in ('\\'', '"', '`'),
        'cuts', if(t = ',' and s.depth = 0, array_append(s.cuts, s.at + 1), s.cuts),
        'end', if(t = ')' and s.depth = 0, s.at, -1))))"""


def ddl_columns(documents: DataFrame) -> DataFrame:
    """Columns of ``CREATE TABLE ... ( NAME TYPE ..., ... )`` texts: (doc, position, column_name, legacy_type).

    Brackets and quotes may be nested in a column to any depth; a list that never closes has no columns.
    """
    body = F.regexp_extract(F.regexp_replace(TEXT, r"\s+", " "), r"(?i)CREATE TABLE [^(]*\((.*)$", 1)
    tokens = documents.select(DOC, body.alias("body")).withColumn("tokens", F.regexp_extract_all("body", F.lit(_TOKENS), F.lit(0)))
    scanned = tokens.select(DOC, "body", F.expr(_SCAN).alias("s"))
    # no filter on the end: it would be pushed below and scan each text twice
    ends = F.expr("if(s.end >= 0, concat(transform(slice(s.cuts, 2, size(s.cuts)), c -> c - 1), array(s.end)), null)")
    parts = scanned.withColumn("ends", ends).select(DOC, F.posexplode(F.expr("transform(ends, (e, i) -> substring(body, s.cuts[i] + 1, e - s.cuts[i]))")).alias("position", "item"))
    tight = F.regexp_replace(F.regexp_replace(F.regexp_replace("item", r" ?, ?", ","), r" ?\( ?", "("), r" \)", ")")
    words = F.split(F.trim(tight), " ")
    return parts.where(F.trim("item") != "").select(
        DOC,
        "position",
        F.get(words, F.lit(0)).alias("column_name"),
        F.get(words, F.lit(1)).alias("legacy_type"),
    )


def schema_drift(ddl: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Column by column, what the control file says against the dictionary.

    Both sides carry (doc, position, column_name, legacy_type). ``status`` is equal, name_differs, type_differs,
    only_in_ddl or only_in_dictionary; a table conforms when every status is equal.
    """
    tagged = lambda columns, side: columns.select(DOC, "position", F.struct("column_name", "legacy_type").alias("column"), F.lit(side).alias("side"))
    # one shuffle by document serves the ranks of both sides and the pairing
    both = tagged(ddl, "ddl").unionByName(tagged(dictionary, "dic")).repartition(DOC)
    side = lambda name: F.first(F.when(F.col("side") == name, F.col("column")), ignorenulls=True).alias(name)
    paired = _ranked(both).groupBy(DOC, "position").agg(side("ddl"), side("dic"))
    status = (
        F.when(F.col("dic").isNull(), "only_in_ddl")
        .when(F.col("ddl").isNull(), "only_in_dictionary")
        .when(F.col("ddl.column_name") != F.col("dic.column_name"), "name_differs")
        .when(F.col("ddl.legacy_type") != F.col("dic.legacy_type"), "type_differs")
        .otherwise("equal")
    )
    return paired.select(
        DOC,
        "position",
        F.col("ddl.column_name").alias("ddl_column"),
        F.col("ddl.legacy_type").alias("ddl_type"),
        F.col("dic.column_name").alias("dictionary_column"),
        F.col("dic.legacy_type").alias("dictionary_type"),
        status.alias("status"),
    )


def _ranked(columns: DataFrame) -> DataFrame:
    """Positions 0, 1, 2, ... whatever gaps blank lines left; a group is the columns of one side of one table."""
    rank = F.row_number().over(Window.partitionBy(DOC, "side").orderBy("position")) - 1
    return columns.withColumn("position", rank)


def conforms(drift: DataFrame) -> DataFrame:
    """One row per document: whether control file and dictionary agree, and how many columns do not."""
    differing = F.count_if(F.col("status") != "equal")
    return drift.groupBy(DOC).agg(differing.alias("differing"), (differing == 0).alias("conforms"))
