"""Batch steps: landing manifest, totals, partitioned loads, audit, retention."""

from __future__ import annotations

from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sheaftext import parse_lines, read_delimited
from sheaftext.catalog.common import ORDERS, joined, orders_line, stamp, table
from sheaftext.operators.schema_docs import dictionary_schema
from sheaftext.plans.batch import SOURCE_FILE, audit_rows, base_name, batch_readiness, batch_totals, check_schema, file_counts, file_verdicts, load_batch, rows_per_file
from sheaftext.plans.retention import partition_dates, purge, retained, with_expiry
from sheaftext.session import scratch_path
from sheaftext.sinks.folders import file_system
from sheaftext.sinks.parquet import add_partition, append_parquet, quoted_table, write_partitions
from sheaftext.sources.landing import list_files
from sheaftext.sources.settings import read_settings

# Folders of the landing area in these queries: batch=<yyyyMM>
MONTH_FOLDER = r"batch=(\d{6})/"


def landing_manifest_ready(spark, sf_dir):
    """Each order is a landing file; a batch is one customer's files of one date, of which some lack a trigger."""
    orders = table(spark, sf_dir, "orders")
    owner = F.concat(F.lit("TB_"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderpriority"))
    name = F.concat(F.lit("/landing/"), owner, F.lit("_"), F.col("o_orderkey").cast("string"), F.lit("_"), stamp("o_orderdate", "ddMMyy"))
    key = F.col("o_orderkey")
    kinds = F.when(key % 5 == 0, F.array(F.lit("CSV"))).when(key % 7 == 0, F.array(F.lit("BST"))).otherwise(F.array(F.lit("CSV"), F.lit("BST"), F.lit("CTR")))
    landed = orders.select(name.alias("name"), F.explode(kinds).alias("extension"))
    files = landed.select(F.concat_ws(".", "name", "extension").alias("path"))
    expected = orders.groupBy(owner.alias("table_name"), stamp("o_orderdate", "ddMMyy").alias("odate")).agg(F.count(F.lit(1)).alias("file_count"))
    return batch_readiness(files, expected)


def landed_months(spark, sf_dir):
    """Order lines in one folder per month, as they would land."""
    path = scratch_path(spark, "landing")
    lines = table(spark, sf_dir, "orders").select(orders_line(";").alias("value"), stamp("o_orderdate", "yyyyMM").alias("batch"))
    lines.hint("rebalance", "batch").write.partitionBy("batch").text(path)
    return path


def _month_counts(spark, path):
    """Per landing file: its month, size and number of parsed rows."""
    files = list_files(spark, path)
    rows = read_delimited(spark, f"{path}/*", ORDERS, delimiter=";", carry={SOURCE_FILE: F.col("_metadata.file_path")})
    counts = file_counts(files, rows_per_file(rows))
    return counts.withColumn("odate", F.regexp_extract("path", MONTH_FOLDER, 1))


def batch_load_totals(spark, sf_dir):
    totals = batch_totals(_month_counts(spark, landed_months(spark, sf_dir)), ["odate"])
    return totals.select("odate", "rows", "bytes", (F.col("files") > 0).alias("has_files"))


def load_audit(spark, sf_dir):
    totals = batch_totals(_month_counts(spark, landed_months(spark, sf_dir)), ["odate"])
    month_start = F.concat(F.substring("odate", 1, 4), F.lit("-"), F.substring("odate", 5, 2), F.lit("-01"))
    audit = audit_rows(totals, "sales", F.lit("ORDERS"), "/landing/", F.lit("2001-08-02 10:00:00"), month_start)
    saved = scratch_path(spark, "audit")
    audit.write.mode("append").parquet(saved)
    return spark.read.parquet(saved).select("db", "tabela", "qtde_linhas", "tamanho", "origem", "dh_exec", "dat_ref_carga")


def empty_file_policy(spark, sf_dir):
    """Each customer is a landing file whose rows are the customer's orders; a batch is a nation and segment."""
    counted = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("/landing/"), F.col("o_custkey").cast("string")).alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    files = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/landing/"), F.col("c_custkey").cast("string")).alias("path"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    # Customers whose key ends in 0 are a batch of their own.
    alone = F.when(F.substring("path", -1, 1) == "0", F.col("path")).otherwise("")
    batch = ["nation", "segment", "alone"]
    verdicts = file_verdicts(file_counts(files.withColumn("alone", alone), counted), batch)
    return verdicts.select(base_name(F.col("path")).cast("bigint").alias("c_custkey"), "rows", "verdict")


def load_partitioned(spark, sf_dir):
    """Order lines parsed and written by load date in one pass, twice; the second run replaces the first."""
    landed, saved = scratch_path(spark, "orders-landed"), scratch_path(spark, "orders-dated")
    table(spark, sf_dir, "orders").select(orders_line(";").alias("value")).write.text(landed)
    for _ in range(2):
        rows = read_delimited(spark, landed, ORDERS, delimiter=";")
        write_partitions(rows.withColumn("dat_ref_carga", stamp("o_orderdate", "yyyy-MM-01")), saved, "dat_ref_carga", rebalance=True)
    return spark.read.schema(ORDERS + ", dat_ref_carga string").parquet(saved)


LOADED = {"o_orderkey": "INTEGER", "o_custkey": "INTEGER", "o_orderstatus": "CHARACTER(1)", "o_totalprice": "DECIMAL(12,2)", "o_orderdate": "TIMESTAMP(26)"}


def dictionary_load_date(spark, sf_dir):
    """Orders read with the schema of their dictionary and the load date that it adds."""
    path = scratch_path(spark, "orders-def")
    spark.range(1, numPartitions=1).select(F.lit("\n".join(f"{column},{kind}" for column, kind in LOADED.items())).alias("value")).write.text(path)
    schema = dictionary_schema(spark, path, load_date=True)
    price = F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    line = joined(";", "o_orderkey", "o_custkey", "o_orderstatus", price, stamp("o_orderdate", "yyyy-MM-dd-HH.mm.ss.SSSSSS"), stamp("o_orderdate", "yyyy-MM-01"))
    rows = parse_lines(table(spark, sf_dir, "orders").select(line.alias("value")), schema, profile="legacy", delimiter=";")
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


def _landed_years(spark, sf_dir):
    """Orders landed as one batch a year, and a table for them: its name, folder, a loader and the files of each year."""
    root = scratch_path(spark, "order-batches")
    name = root.rsplit("/", 1)[1].replace("-", "_")
    write = lambda text, kind: spark.range(1, numPartitions=1).select(F.lit(text).alias("value")).write.text(f"{root}/{kind}")
    write("\n".join(f"{column},{kind}" for column, kind in LOADED.items()), "def")
    write("CREATE TABLE A.ORDERS (" + ", ".join(f"{column} {kind}" for column, kind in LOADED.items()) + ")", "ctr")
    write(f"retention=30\nhdfs_path_source={root}/land/\nhdfs_path_save={root}/save/\ndatabase=default\nfile_count=2\nos_path_source=/land/\ndemiliter=;", "conf")
    settings = read_settings(spark, f"{root}/conf")
    check_schema(spark, f"{root}/ctr", f"{root}/def")
    price = F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    line = joined(";", "o_orderkey", "o_custkey", "o_orderstatus", price, stamp("o_orderdate", "yyyy-MM-dd-HH.mm.ss.SSSSSS"))
    lines = table(spark, sf_dir, "orders").select(line.alias("value"), stamp("o_orderdate", "yyyy").alias("year"))
    lines.hint("rebalance", "year").write.partitionBy("year").text(f"{root}/written")
    files = file_system(spark, root)[1]
    path = lambda text: file_system(spark, text)[0]
    files.mkdirs(path(f"{root}/land"))
    landed = {}  # one short list of file names a year
    for part in files.globStatus(path(f"{root}/written/year=*/part-*")):
        year = part.getPath().getParent().getName()[-4:]
        landed.setdefault(year, []).append(path(f"{root}/land/{name}_{len(landed.get(year, []))}_0101{year[2:]}.CSV"))
        files.rename(part.getPath(), landed[year][-1])
    columns = "o_orderkey INT, o_custkey INT, o_orderstatus STRING, o_totalprice DECIMAL(12,2), o_orderdate TIMESTAMP, DAT_REF_CARGA STRING"
    spark.sql(f"CREATE TABLE default.`{name}` ({columns}) USING parquet PARTITIONED BY (DAT_REF_CARGA) LOCATION '{root}/save'")

    def load(year, **changed):
        return load_batch(spark, replace(settings, **changed), name, f"0101{year[2:]}", f"{root}/def", century=int(year[:2]), audit_table=f"default.{name}_audit")

    for year in sorted(landed):
        load(year)
    return name, root, load, landed, files


def _audit_and_table(spark, name, root):
    """What the audit and the table hold in the end; both tables are then dropped."""
    held = spark.table(f"default.{name}").groupBy(F.col("DAT_REF_CARGA").alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").alias("total"))
    audit = spark.table(f"default.{name}_audit").select(F.lit("audit").alias("kind"), F.col("dat_ref_carga").alias("day"), F.col("qtde_linhas").alias("rows"), F.lit(None).cast("decimal(22,2)").alias("total"))
    files = spark.table(f"default.{name}_audit_files").groupBy(F.lit("files").alias("kind"), F.col("dat_ref_carga").alias("day")).agg(F.sum("rows").alias("rows"), F.lit(None).cast("decimal(22,2)").alias("total"))
    audit.unionByName(files).unionByName(held.withColumn("kind", F.lit("table"))).write.parquet(f"{root}/result")
    for used in (name, f"{name}_audit", f"{name}_audit_files"):
        spark.sql(f"DROP TABLE default.`{used}`")
    return spark.read.parquet(f"{root}/result")


def load_batch_twice(spark, sf_dir):
    """Orders landed as one batch a year and loaded; then the last year is delivered again, with an empty file.

    Returned are the audit and what the table holds in the end.
    """
    name, root, load, landed, files = _landed_years(spark, sf_dir)
    if landed:
        last = max(landed)
        for path in landed[last]:
            files.delete(path, False)
        files.create(landed[last][0]).close()
        load(last)
    return _audit_and_table(spark, name, root).where("kind <> 'files'")


def load_batch_failed(spark, sf_dir):
    """As above, but the last year is delivered again with a line that does not fit, and the first as one empty file where one is due.

    Both loads raise; audit, list of loaded files and table are as the first loads left them.
    """
    name, root, load, landed, files = _landed_years(spark, sf_dir)
    if landed:
        bad = files.create(landed[max(landed)][0], True)
        bad.write(bytearray(b"1;2;O;no price;1995-01-01-00.00.00.000000\n"))
        bad.close()
        for path in landed[min(landed)]:
            files.delete(path, False)
        files.create(landed[min(landed)][0]).close()
        for year, changed, error in ((max(landed), {}, (PySparkException, Py4JJavaError)), (min(landed), {"file_count": 1}, ValueError)):
            try:
                load(year, **changed)
            except error:
                continue
            raise AssertionError(f"a bad delivery of {year} was loaded")
    return _audit_and_table(spark, name, root)


def _dated_table(spark, sf_dir, label, undated=None):
    """An external table over orders by month start, with every month registered; orders that meet ``undated`` have none."""
    saved = scratch_path(spark, label)
    name = "default." + saved.rsplit("/", 1)[1].replace("-", "_")
    orders = table(spark, sf_dir, "orders").withColumn("DAT_REF_CARGA", stamp("o_orderdate", "yyyy-MM-01"))
    if undated is not None:
        orders = orders.withColumn("DAT_REF_CARGA", F.when(~undated, F.col("DAT_REF_CARGA")))
    spark.sql(f"CREATE TABLE {quoted_table(name)} ({ORDERS}, DAT_REF_CARGA STRING) USING parquet PARTITIONED BY (DAT_REF_CARGA) LOCATION '{saved}'")
    orders.hint("rebalance", "DAT_REF_CARGA").select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    return name, saved


def retention_purge(spark, sf_dir):
    """Months, a partition without a date, which stays, and an old folder that the catalog does not know, which goes."""
    name, saved = _dated_table(spark, sf_dir, "orders-purged", undated=F.col("o_custkey") % 10 == 0)
    table(spark, sf_dir, "orders").write.parquet(f"{saved}/DAT_REF_CARGA=1990-01-01")
    purge(spark, name, F.lit("2001-08-01").cast("date"), 1000, root=saved)
    left = spark.read.parquet(saved).groupBy(F.col("DAT_REF_CARGA").cast("string").alias("DAT_REF_CARGA"))
    return left.agg(F.count(F.lit(1)).alias("orders"))


def retention_partitions(spark, sf_dir):
    name, _ = _dated_table(spark, sf_dir, "orders-months")
    marked = with_expiry(partition_dates(spark, name), "DAT_REF_CARGA", F.lit("2001-08-01").cast("date"), 1000)
    return marked.groupBy("expired").agg(F.count(F.lit(1)).alias("partitions"), F.min("DAT_REF_CARGA").alias("first"), F.max("DAT_REF_CARGA").alias("last"))


def retention_kept(spark, sf_dir):
    lines = table(spark, sf_dir, "orders").select(orders_line().alias("value"))
    kept = retained(parse_lines(lines, ORDERS), "o_orderdate", F.lit("2001-08-01").cast("date"), 365)
    return kept.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("orders"))


def partition_registration(spark, sf_dir):
    """Parquet appended outside the table and registered as its partition; registering twice changes nothing."""
    saved = scratch_path(spark, "events-loose")
    name = "default." + saved.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE TABLE {quoted_table(name)} (event_id BIGINT, event_type STRING, dat_ref_carga STRING) USING parquet PARTITIONED BY (dat_ref_carga) LOCATION '{saved}-table'")
    append_parquet(table(spark, sf_dir, "events").select("event_id", "event_type"), saved)
    for _ in range(2):
        add_partition(spark, name, {"dat_ref_carga": "2024-01-31"}, saved)
    return spark.table(name)


_LINE_BYTES = """octet_length(encode(CAST(o_orderkey AS VARCHAR) || ';' || CAST(o_custkey AS VARCHAR) || ';' || o_orderstatus || ';' || CAST(o_totalprice AS VARCHAR)
    || ';' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ';' || o_orderpriority)) + 1"""
_MONTH = "strftime(o_orderdate, '%Y%m')"
_READY = """SELECT 'TB_' || CAST(o_custkey AS VARCHAR) || '_' || o_orderpriority AS table_name, strftime(o_orderdate, '%d%m%y') AS odate, count(*) AS file_count,
    count(*) FILTER (o_orderkey % 5 <> 0) AS triggers, count(*) FILTER (o_orderkey % 5 = 0 OR o_orderkey % 7 <> 0) AS data_files
    FROM orders GROUP BY ALL"""

QUERIES = {
    "landing_manifest_ready": (
        landing_manifest_ready,
        f"""SELECT *, CASE WHEN triggers = 0 THEN 'MISSING' WHEN triggers < file_count THEN 'PARTIAL'
        WHEN triggers <> file_count OR data_files <> file_count THEN 'MISMATCH' ELSE 'READY' END AS status FROM ({_READY})""",
    ),
    "batch_load_totals": (
        batch_load_totals,
        f"SELECT {_MONTH} AS odate, count(*) AS rows, CAST(sum({_LINE_BYTES}) AS BIGINT) AS bytes, TRUE AS has_files FROM orders GROUP BY 1",
    ),
    "load_audit": (
        load_audit,
        f"""SELECT 'sales' AS db, 'ORDERS' AS tabela, count(*) AS qtde_linhas, CAST(sum({_LINE_BYTES}) AS BIGINT) AS tamanho, '/landing/' AS origem,
        '2001-08-02 10:00:00' AS dh_exec, strftime(o_orderdate, '%Y-%m-01') AS dat_ref_carga FROM orders GROUP BY strftime(o_orderdate, '%Y-%m-01')""",
    ),
    "empty_file_policy": (
        empty_file_policy,
        """WITH counts AS (SELECT c_custkey, count(o_orderkey) AS rows,
            CASE WHEN c_custkey % 10 = 0 THEN 'C' || c_custkey ELSE 'N' || c_nationkey || c_mktsegment END AS batch
            FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey, c_mktsegment)
        SELECT c_custkey, rows, CASE WHEN rows > 0 THEN 'LOADED' WHEN count(*) OVER (PARTITION BY batch) = 1 THEN 'ERROR' ELSE 'SKIPPED' END AS verdict FROM counts""",
    ),
    "load_batch_twice": (
        load_batch_twice,
        """WITH years AS (SELECT strftime(o_orderdate, '%Y-01-01') AS day, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total FROM orders GROUP BY 1)
        SELECT 'audit' AS kind, day, rows, CAST(NULL AS DECIMAL(22,2)) AS total FROM years
        UNION ALL SELECT 'audit', max(day), 0, NULL FROM years
        UNION ALL SELECT 'table', day, rows, total FROM years WHERE day < (SELECT max(day) FROM years)""",
    ),
    "dictionary_load_date": (
        dictionary_load_date,
        """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, strftime(o_orderdate, '%Y-%m-01') AS "DAT_REF_CARGA" FROM orders""",
    ),
    "load_batch_failed": (
        load_batch_failed,
        """WITH years AS (SELECT strftime(o_orderdate, '%Y-01-01') AS day, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total FROM orders GROUP BY 1)
        SELECT 'audit' AS kind, day, rows, CAST(NULL AS DECIMAL(22,2)) AS total FROM years
        UNION ALL SELECT 'files', day, rows, NULL FROM years
        UNION ALL SELECT 'table', day, rows, total FROM years""",
    ),
    "load_partitioned": (load_partitioned, "SELECT *, strftime(o_orderdate, '%Y-%m-01') AS dat_ref_carga FROM orders"),
    "retention_purge": (
        retention_purge,
        """SELECT CASE WHEN o_custkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-01') END AS "DAT_REF_CARGA", count(*) AS orders FROM orders
        WHERE o_custkey % 10 = 0 OR CAST(date_trunc('month', o_orderdate) AS DATE) >= DATE '2001-08-01' - 1000 GROUP BY 1""",
    ),
    "retention_partitions": (
        retention_partitions,
        """SELECT expired, count(*) AS partitions, min(m) AS first, max(m) AS last FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-01') AS m,
        CAST(date_trunc('month', o_orderdate) AS DATE) < DATE '2001-08-01' - 1000 AS expired FROM orders) GROUP BY expired""",
    ),
    "retention_kept": (
        retention_kept,
        "SELECT o_orderdate, count(*) AS orders FROM orders WHERE o_orderdate >= DATE '2001-08-01' - 365 GROUP BY o_orderdate",
    ),
    "partition_registration": (partition_registration, "SELECT event_id, event_type, '2024-01-31' AS dat_ref_carga FROM events"),
}
