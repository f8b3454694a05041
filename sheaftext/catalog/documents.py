"""Settings, dictionaries and control files of many tables at once.

Every row of ``part`` or ``customer`` stands for one table with its own small documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaftext.catalog.common import divides, table
from sheaftext.operators.schema_docs import conforms, ddl_columns, dictionary_columns, schema_drift
from sheaftext.sources.settings import settings_table


def _doc(key: str):
    return F.col(key).cast("string").alias("doc")


def config_settings(spark, sf_dir):
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("retention="), F.col("c_nationkey") + 1),
        F.concat(F.lit("hdfs_path_source=/land/"), "c_name", F.lit("?a=b/")),
        F.concat(F.lit("hdfs_path_save=/save/"), "c_name", F.lit("/")),
        F.when(~divides("c_custkey", 5), F.concat(F.lit("database="), F.lower("c_mktsegment"))),
        F.concat(F.lit("file_count="), F.col("c_custkey") % 3 + 1),
        F.lit("os_path_source=/os/"),
        F.when(divides("c_custkey", 2), "demiliter=|"),
        F.when(divides("c_custkey", 3), "header=true"),
        F.lit("retention=999"),
        F.lit("no setting here"),
    )
    documents = table(spark, sf_dir, "customer").select(_doc("c_custkey"), lines.alias("text"))
    return settings_table(documents).withColumn("missing", F.concat_ws(",", "missing"))


def dictionary_texts(spark, sf_dir):
    """One column dictionary per part; names and sizes come from the row."""
    lines = F.concat_ws(
        "\n",
        F.lit("KEY_ID,INTEGER"),
        F.concat(F.lit("AMOUNT,DECIMAL("), F.col("p_size") % 20 + 5, F.lit(",2)")),
        F.lit("LOADED,TIMESTAMP(26)"),
        F.concat(F.upper("p_type"), F.lit(",CHARACTER("), F.col("p_size"), F.lit(")")),
        F.concat(F.lit("SEQ,NUMERIC("), F.col("p_size") % 9 + 1, F.lit(")")),
        F.when(divides("p_partkey", 4), F.concat(F.lit("RATE,NUMERIC("), F.col("p_size") % 9 + 3, F.lit(",1)"))),
        F.lit("DAY,DATE"),
    )
    return table(spark, sf_dir, "part").select(_doc("p_partkey"), lines.alias("text"))


def ddl_texts(spark, sf_dir):
    """Control files for the same tables: every third renames a column, every fifth changes a type, every
    seventh has one column more. Defaults hold nested brackets, and commas and brackets between quotes."""
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("-- export\nCREATE TABLE T"), "p_partkey"),
        F.lit("    ( KEY_ID INTEGER NOT NULL"),
        F.concat(F.lit("    , AMOUNT DECIMAL("), F.col("p_size") % 20 + 5, F.when(divides("p_partkey", 5), " , 3)").otherwise(" , 2) DEFAULT (COALESCE(0, (1)))")),
        F.concat(F.lit("    , "), F.when(divides("p_partkey", 3), "STORED").otherwise("LOADED"), F.lit(" TIMESTAMP(26)")),
        F.concat(F.lit("    , "), F.upper("p_type"), F.lit(" CHARACTER("), F.col("p_size"), F.lit(") NOT NULL WITH DEFAULT ',) (('")),
        F.concat(F.lit("    , SEQ NUMERIC("), F.col("p_size") % 9 + 1, F.lit(")")),
        F.when(divides("p_partkey", 4), F.concat(F.lit("    , RATE NUMERIC("), F.col("p_size") % 9 + 3, F.lit(",1)"))),
        F.lit("    , DAY DATE"),
        F.when(divides("p_partkey", 7), "    , EXTRA TIME"),
        F.lit("    )\n;"),
    )
    return table(spark, sf_dir, "part").select(_doc("p_partkey"), lines.alias("text"))


def dictionary_schema_columns(spark, sf_dir):
    return dictionary_columns(dictionary_texts(spark, sf_dir))


def ddl_column_list(spark, sf_dir):
    return ddl_columns(ddl_texts(spark, sf_dir))


def schema_drift_columns(spark, sf_dir):
    drift = schema_drift(ddl_columns(ddl_texts(spark, sf_dir)), dictionary_columns(dictionary_texts(spark, sf_dir)))
    return drift.where("status <> 'equal'")


def schema_conforms(spark, sf_dir):
    return conforms(schema_drift(ddl_columns(ddl_texts(spark, sf_dir)), dictionary_columns(dictionary_texts(spark, sf_dir))))


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_RATE = "p_partkey % 4 = 0"
_DAY_POSITION = f"5 + CAST({_RATE} AS INTEGER)"


def _column(position: str, name: str, legacy: str, extra: str = "", where: str = "TRUE") -> str:
    return f"SELECT CAST(p_partkey AS VARCHAR) AS doc, CAST({position} AS INTEGER) AS position, {name} AS column_name, {legacy} AS legacy_type{extra} FROM part WHERE {where}"


def _typed(position, name, legacy, data_type, where="TRUE"):
    return _column(position, name, legacy, f", {data_type} AS data_type", where)


_AMOUNT = "CAST(p_size % 20 + 5 AS VARCHAR)"
DICTIONARY_SQL = _union(
    [
        _typed("0", "'KEY_ID'", "'INTEGER'", "'int'"),
        _typed("1", "'AMOUNT'", f"'DECIMAL(' || {_AMOUNT} || ',2)'", f"'decimal(' || {_AMOUNT} || ',2)'"),
        _typed("2", "'LOADED'", "'TIMESTAMP(26)'", "'timestamp'"),
        _typed("3", "upper(p_type)", "'CHARACTER(' || p_size || ')'", "'string'"),
        _typed("4", "'SEQ'", "'NUMERIC(' || (p_size % 9 + 1) || ')'", "'int'"),
        _typed("5", "'RATE'", "'NUMERIC(' || (p_size % 9 + 3) || ',1)'", "'decimal(' || (p_size % 9 + 3) || ',1)'", _RATE),
        _typed(_DAY_POSITION, "'DAY'", "'DATE'", "'string'"),
    ]
)
DDL_SQL = _union(
    [
        _column("0", "'KEY_ID'", "'INTEGER'"),
        _column("1", "'AMOUNT'", f"'DECIMAL(' || {_AMOUNT} || CASE WHEN p_partkey % 5 = 0 THEN ',3)' ELSE ',2)' END"),
        _column("2", "CASE WHEN p_partkey % 3 = 0 THEN 'STORED' ELSE 'LOADED' END", "'TIMESTAMP(26)'"),
        _column("3", "upper(p_type)", "'CHARACTER(' || p_size || ')'"),
        _column("4", "'SEQ'", "'NUMERIC(' || (p_size % 9 + 1) || ')'"),
        _column("5", "'RATE'", "'NUMERIC(' || (p_size % 9 + 3) || ',1)'", where=_RATE),
        _column(_DAY_POSITION, "'DAY'", "'DATE'"),
        _column(f"{_DAY_POSITION} + 1", "'EXTRA'", "'TIME'", where="p_partkey % 7 = 0"),
    ]
)


def _difference(position: str, names: tuple[str, str], types: tuple[str, str], status: str, where: str) -> str:
    return f"""SELECT CAST(p_partkey AS VARCHAR) AS doc, CAST({position} AS INTEGER) AS position, {names[0]} AS ddl_column, {types[0]} AS ddl_type,
    {names[1]} AS dictionary_column, {types[1]} AS dictionary_type, '{status}' AS status FROM part WHERE {where}"""


DRIFT_SQL = _union(
    [
        _difference("1", ("'AMOUNT'",) * 2, (f"'DECIMAL(' || {_AMOUNT} || ',3)'", f"'DECIMAL(' || {_AMOUNT} || ',2)'"), "type_differs", "p_partkey % 5 = 0"),
        _difference("2", ("'STORED'", "'LOADED'"), ("'TIMESTAMP(26)'",) * 2, "name_differs", "p_partkey % 3 = 0"),
        _difference(f"{_DAY_POSITION} + 1", ("'EXTRA'", "NULL"), ("'TIME'", "NULL"), "only_in_ddl", "p_partkey % 7 = 0"),
    ]
)
_DIFFERING = "CAST(p_partkey % 5 = 0 AS BIGINT) + CAST(p_partkey % 3 = 0 AS BIGINT) + CAST(p_partkey % 7 = 0 AS BIGINT)"

QUERIES = {
    "config_settings": (
        config_settings,
        """SELECT CAST(c_custkey AS VARCHAR) AS doc, c_nationkey + 1 AS retention, '/land/' || c_name || '?a=b/' AS hdfs_path_source,
        '/save/' || c_name || '/' AS hdfs_path_save, CASE WHEN c_custkey % 5 <> 0 THEN lower(c_mktsegment) END AS database,
        CAST(c_custkey % 3 + 1 AS INTEGER) AS file_count, '/os/' AS os_path_source, '"' AS quote,
        CASE WHEN c_custkey % 2 = 0 THEN '|' ELSE ';' END AS delimiter, CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END AS header,
        'NON_NUMERIC' AS "quoteMode", CASE WHEN c_custkey % 5 = 0 THEN 'database' ELSE '' END AS missing FROM customer""",
    ),
    "dictionary_schema": (dictionary_schema_columns, DICTIONARY_SQL),
    "ddl_columns": (ddl_column_list, DDL_SQL),
    "schema_drift": (schema_drift_columns, DRIFT_SQL),
    "schema_conforms": (
        schema_conforms,
        f"SELECT CAST(p_partkey AS VARCHAR) AS doc, {_DIFFERING} AS differing, {_DIFFERING} = 0 AS conforms FROM part",
    ),
}
