"""The landing folder as a table: which files of which batch have arrived, and how large they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: table name, six digits of date and kind of a landing file.
LANDING_NAME = r"([A-Za-z0-9]+?)(?:[_.\-][^/]*?)?(\d{6})\.(CSV|BST|CTR)$"

# Fixed value: what comes before the date, six digits of date, and kind of a landing file's own name.
LANDING_PARTS = r"^([^/]*)(\d{6})\.(CSV|BST|CTR)$"

HEAD = "__head"


def batch_glob(table: str, odate: str, kind: str = "*") -> str:
    """File name pattern of one batch."""
    return f"{table}*{odate}.{kind}"


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Rows of (path, length, modified) of every file below ``root``; contents are not read.

    A scan leaves out files of zero bytes, which trigger files often are, so the names come from the scan's file
    index, which the driver holds for any scan. ``modified`` is null for an empty file.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    scan = reader.load(root)
    names = spark.createDataFrame([(name,) for name in scan.inputFiles()], "path string")
    # the metadata column of a scan writes a path without host as file:/x, the file index as file:///x
    every = names.select(F.regexp_replace("path", "^([a-z]+):///", "$1:/").alias("path"))
    filled = scan.select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))
    return every.join(filled, "path", "left").withColumn("length", F.coalesce("length", F.lit(0)))


def with_batch(files: DataFrame, name_pattern: str = LANDING_NAME) -> DataFrame:
    """Add (table_name, odate, kind) read from the path; names of another shape give empty text."""
    part = lambda i: F.regexp_extract("path", name_pattern, i)
    return files.select("*", part(1).alias("table_name"), part(2).alias("odate"), part(3).alias("kind"))


def expected_batches(files: DataFrame, expected: DataFrame) -> DataFrame:
    """(path, kind, table_name, odate, ``HEAD``) of the files of the awaited batches in ``expected`` (table_name, odate).

    Table names may hold any sign. A file is the table's whose name it begins with, the longest where there are
    several. Names and files of a date are sorted together: what begins with a name follows it without a gap, so the last
    name of some length before a file is the only one of that length that the file can begin with. Each file is
    shuffled once, by date and by ``HEAD``, as many first signs as the shortest name has; rows stay so for what groups them further.
    """
    part = lambda i: F.regexp_extract(F.substring_index("path", "/", -1), LANDING_PARTS, i)
    awaited = expected.where("table_name <> '' and odate <> ''")
    lengths = sorted(r[0] for r in awaited.select(F.length("table_name")).distinct().collect())
    least = lengths[0] if lengths else 1
    stems = files.select("path", part(1).alias("text"), part(2).alias("odate"), part(3).alias("kind")).where((F.length("text") >= least) & (F.col("odate") != ""))
    names = awaited.select(F.lit(None).cast("string").alias("path"), F.col("table_name").alias("text"), "odate", F.lit(None).cast("string").alias("kind"))
    both = stems.unionByName(names).withColumn(HEAD, F.substr("text", F.lit(1), F.lit(least)))
    order = Window.partitionBy("odate", HEAD).orderBy("text", F.asc_nulls_first("path"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda n: F.last(F.when(F.col("path").isNull() & (F.length("text") == n), F.col("text")), ignorenulls=True).over(so_far)
    # a path that is listed twice is one file
    placed = both.select("*", *[last(n).alias(f"name{n}") for n in lengths], F.lag("path").over(order).eqNullSafe(F.col("path")).alias("again"))
    begun = [F.when(F.startswith("text", F.col(f"name{n}")), F.col(f"name{n}")) for n in reversed(lengths)]
    table_name = F.coalesce(*begun, F.lit(None).cast("string")).alias("table_name")
    return placed.where("path is not null and not again").select("path", "odate", "kind", table_name, HEAD).where("table_name is not null")


def manifest(spark: SparkSession, root: str, glob: str | None = None, name_pattern: str = LANDING_NAME) -> DataFrame:
    """The landing files with their batch."""
    return with_batch(list_files(spark, root, glob), name_pattern)
