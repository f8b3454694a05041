"""Loading one batch of landing files into a date partition, and the checks and records around it.

All files of a batch are one scan that is parsed once: rows are written to Parquet with the name of their file,
and every count is then read from what was written. What is written becomes visible only when it has been judged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaftext.functions.dates import business_date_text
from sheaftext.options import ReadOptions
from sheaftext.operators.schema_docs import LOAD_DATE_COLUMN, conforms, ddl_columns, dictionary_columns, dictionary_schema, read_documents, schema_drift
from sheaftext.sinks.folders import delete_folder
from sheaftext.sinks.parquet import partition_location, publish_partition, run_folder, table_exists
from sheaftext.sources.delimited import read_delimited
from sheaftext.sources.landing import HEAD, batch_glob, expected_batches, list_files
from sheaftext.sources.settings import LoadSettings

SOURCE_FILE = "source_file"
#: File names that an audit row lists in full.
NAMED_FILES = 100
BATCH = ["table_name", "odate"]

# The columns of the load audit table.
AUDIT_COLUMNS = (
    "db",
    "tabela",
    "qtde_arquivos",
    "qtde_linhas",
    "tamanho",
    "origem",
    "dh_exec",
    "arq_carregados",
    "dat_ref_carga",
)


def batch_readiness(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Whether each batch is complete.

    ``files`` is a manifest; ``expected`` holds (table_name, odate, file_count), one row per batch awaited. A file
    belongs to the awaited table with the longest name that its own name begins with.
    MISSING: no trigger file. PARTIAL: fewer triggers than expected. MISMATCH: trigger or data files differ from
    the expected number. READY otherwise.
    """
    arrived = expected_batches(files, expected).groupBy(*BATCH, HEAD).agg(
        F.count_if(F.col("kind") == "BST").alias("triggers"), F.count_if(F.col("kind") == "CSV").alias("data_files")
    )
    counts = expected.join(arrived.drop(HEAD), BATCH, "left").select(
        *BATCH,
        "file_count",
        F.coalesce("triggers", F.lit(0)).alias("triggers"),
        F.coalesce("data_files", F.lit(0)).alias("data_files"),
    )
    status = (
        F.when(F.col("triggers") == 0, "MISSING")
        .when(F.col("triggers") < F.col("file_count"), "PARTIAL")
        .when((F.col("triggers") != F.col("file_count")) | (F.col("data_files") != F.col("file_count")), "MISMATCH")
        .otherwise("READY")
    )
    return counts.withColumn("status", status)


def rows_per_file(rows: DataFrame, file_column: str = SOURCE_FILE) -> DataFrame:
    """(path, rows) for every file that has rows."""
    return rows.groupBy(F.col(file_column).alias("path")).agg(F.count(F.lit(1)).alias("rows"))


def file_counts(files: DataFrame, counted: DataFrame) -> DataFrame:
    """The manifest with a row count per file, zero for files without rows."""
    return files.join(counted, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def file_verdicts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """What becomes of each file of a batch: LOADED, SKIPPED when empty among others, ERROR when alone and empty."""
    by = by or BATCH
    known = counts.withColumn("files_in_batch", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    verdict = F.when(F.col("rows") > 0, "LOADED").when(F.col("files_in_batch") == 1, "ERROR").otherwise("SKIPPED")
    return known.withColumn("verdict", verdict)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def batch_totals(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Files, rows, bytes and file names per batch.

    Up to ``NAMED_FILES`` names are listed in order. A longer list begins with as many and ends with the number of files and
    a digest of all names, so the text stays short; :func:`loaded_files` keeps every name.
    """
    by = by or BATCH
    name = base_name(F.col("path"))
    totals = counts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").alias("rows"),
        F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64(name)).alias("mark"),
        F.sum(F.xxhash64(name).cast("decimal(38,0)")).alias("sum"),
    )
    # the first names of each part of a batch, then those of the batch: no task sorts all names
    part = F.pmod(F.xxhash64("path"), F.lit(NAMED_FILES))
    first = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("name", "path"))
    some = counts.select(*by, "path", name.alias("name"), part.alias("part")).withColumn("place", first(*by, "part")).where(F.col("place") <= NAMED_FILES)
    some = some.withColumn("place", first(*by)).where(F.col("place") <= NAMED_FILES)
    listed = some.groupBy(*by).agg(F.concat_ws(" / ", F.sort_array(F.collect_list("name"))).alias("names"))
    same = [totals[k].eqNullSafe(listed[k]) for k in by]
    digest = F.concat(F.lit(" / ... ("), F.col("files").cast("string"), F.lit(" files, "), F.lower(F.hex("mark")), F.lit(" "), F.col("sum").cast("string"), F.lit(")"))
    file_names = F.concat("names", F.when(F.col("files") > NAMED_FILES, digest).otherwise(""))
    return totals.join(listed, same).select(*[totals[k] for k in by], "files", "rows", "bytes", file_names.alias("file_names"))


def loaded_files(counts: DataFrame, database: str, table: str, ref_date: str, run_at: Column | None = None) -> DataFrame:
    """One row per landing file of a load: what it was, how many rows it gave, and what became of it."""
    judged = file_verdicts(counts.withColumn("odate", F.lit(ref_date)), ["odate"])
    values = {"db": F.lit(database), "tabela": F.lit(table), "dat_ref_carga": F.lit(ref_date), "dh_exec": (run_at if run_at is not None else F.current_timestamp()).cast("string")}
    return judged.select(*[v.alias(k) for k, v in values.items()], "path", "length", "rows", "verdict")


def audit_rows(totals: DataFrame, database: str, table: Column, origin: str, run_at: Column, ref_date: Column) -> DataFrame:
    """Batch totals in the columns of the audit table."""
    values = [
        F.lit(database),
        table,
        F.col("files"),
        F.col("rows"),
        F.col("bytes"),
        F.lit(origin),
        run_at.cast("string"),
        F.col("file_names"),
        ref_date,
    ]
    return totals.select(*[value.alias(name) for value, name in zip(values, AUDIT_COLUMNS)])


def append_audit(rows: DataFrame, table: str) -> None:
    rows.write.mode("append").saveAsTable(table)


def landing_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, dialect: ReadOptions, ref_date: Column, glob: str | None = None
) -> DataFrame:
    """Typed rows of all files of a batch, with their file and load date."""
    paths = path if glob is None else f"{path}/{glob}"
    rows = read_delimited(spark, paths, schema, dialect, carry={SOURCE_FILE: F.col("_metadata.file_path")})
    return rows.withColumn(LOAD_DATE_COLUMN, ref_date)


@dataclass(frozen=True)
class LoadResult:
    """What a load did. ``counts`` has one row per landing file."""

    ref_date: str
    rows: int
    counts: DataFrame
    audit: DataFrame


def check_schema(spark: SparkSession, control_path: str, dictionary_path: str) -> None:
    """Raise unless the control file lists the dictionary's columns, in order, with the same types."""
    named = lambda columns: columns.withColumn("doc", F.lit("table"))
    drift = schema_drift(named(ddl_columns(read_documents(spark, control_path))), named(dictionary_columns(read_documents(spark, dictionary_path))))
    row = conforms(drift).head()
    if row is None or not row.conforms:
        raise ValueError(f"{control_path} and {dictionary_path} differ in {row.differing if row else 'all'} column(s)")


def load_batch(
    spark: SparkSession,
    settings: LoadSettings,
    table: str,
    odate: str,
    dictionary_path: str,
    run_at: Column | None = None,
    century: int = 20,
    audit_table: str | None = None,
) -> LoadResult:
    """Load all data files of ``table`` and ``odate`` into the partition of that date.

    Rows go to a folder of this run, are counted and judged there, and only then become the partition. A load that
    raises leaves table, partition and audit as they were and removes its folder. It raises when the catalog lacks
    the table, no file has arrived, a value does not fit, or the only file is empty. A rerun replaces the whole partition,
    also by no rows when all of several files delivered again are empty. A partition without rows is not registered.
    With ``audit_table``, each published load adds one row there and one per file to ``<audit_table>_files``.
    """
    if not table_exists(spark, settings.database, table):
        raise LookupError(f"no table {settings.database}.{table} in the catalog")
    schema = dictionary_schema(spark, dictionary_path)
    glob = batch_glob(table, odate, "CSV")
    ref_date = spark.range(1).select(business_date_text(F.lit(odate), century)).head()[0]
    if ref_date is None:
        raise ValueError(f"not a ddmmyy date: {odate}")
    files = list_files(spark, settings.source_path, glob)
    if not files.limit(1).count():
        raise FileNotFoundError(f"no file {glob} in {settings.source_path}")
    target, partition = f"{settings.database.lower()}.{table.lower()}", {LOAD_DATE_COLUMN: ref_date}
    rows = landing_rows(spark, settings.source_path.rstrip("/"), schema, settings.dialect, F.lit(ref_date), glob)
    stored = rows.drop(LOAD_DATE_COLUMN)
    location = run_folder(settings.save_path, partition)
    try:
        stored.write.option("compression", "snappy").parquet(location)
        # one narrow column of the folder that this load has just written
        counts = file_counts(files, rows_per_file(spark.read.schema(stored.schema).parquet(location)))
        total = counts.agg(F.sum("rows")).head()[0]
        if not total and settings.file_count == 1:
            raise ValueError(f"the only file of {table} {odate} is empty")
        if total or partition_location(spark, target, partition) is not None:
            publish_partition(spark, target, partition, location)
    except BaseException:
        delete_folder(spark, location)
        raise
    if not total:
        delete_unused(spark, target, partition, location)
    totals = batch_totals(counts.withColumn("odate", F.lit(odate)), ["odate"])
    audit = audit_rows(totals, settings.database, F.lit(table), settings.landing_path, run_at if run_at is not None else F.current_timestamp(), F.lit(ref_date))
    if audit_table:
        append_audit(audit, audit_table)
        append_audit(loaded_files(counts, settings.database, table, ref_date, run_at), f"{audit_table}_files")
    return LoadResult(ref_date, total or 0, counts, audit)


def delete_unused(spark: SparkSession, table: str, partition: dict[str, str], location: str) -> None:
    """Remove the folder of a run that became no partition."""
    if partition_location(spark, table, partition) is None:
        delete_folder(spark, location)
