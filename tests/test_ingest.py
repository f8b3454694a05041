"""Settings, schema documents, landing manifest, loads, audit and retention."""

from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compare import rows
from sheaftext.operators.schema_docs import conforms, ddl_columns, dictionary_columns, dictionary_schema, legacy_type, read_documents, schema_drift
from sheaftext.plans.batch import batch_readiness, batch_totals, check_schema, file_counts, file_verdicts, load_batch, rows_per_file
from sheaftext.plans.ratings import load_ratings, rejected_ratings
from sheaftext.plans.retention import partition_dates, purge
from sheaftext.sinks.parquet import add_partition, table_exists, write_partitions
from sheaftext.sources.landing import batch_glob, list_files, manifest
from sheaftext.sources.ratings import split_ratings
from sheaftext.sources.settings import read_settings

DICTIONARY = "ID,INTEGER\nNAME,CHARACTER(20)\nAMOUNT,DECIMAL(9,2)\nSEEN,TIMESTAMP(26)\nDAY,DATE\nN,NUMERIC(5)\nR,NUMERIC(7,3)\nS,SMALLINT\nT,TIME\nV,VARCHAR(9)\n"
CONTROL = """-- unload
CREATE TABLE A.B
    ( ID INTEGER NOT NULL
    , NAME CHARACTER(20) NOT NULL WITH DEFAULT
    , AMOUNT DECIMAL(9 , 2)
    , SEEN TIMESTAMP(26), DAY DATE
    , N NUMERIC(5)
    , R NUMERIC(7, 3)
    , S SMALLINT
    , T TIME
    , V VARCHAR(9)
    )
;
"""


def test_dictionary_schema(spark, put):
    schema = dictionary_schema(spark, put(DICTIONARY, "t.def"), load_date=True)
    expected = "ID int, NAME string, AMOUNT decimal(9,2), SEEN timestamp, DAY string, N int, R decimal(7,3), S int, T string, V string, DAT_REF_CARGA string"
    assert schema == T.StructType.fromDDL(expected) and all(f.nullable for f in schema)


def test_unknown_bare_type_is_an_error(spark, put):
    with pytest.raises(Exception, match="unknown type without size: BLOB"):
        dictionary_schema(spark, put("X,BLOB\n", "t.def"))
    assert spark.range(1).select(legacy_type(F.lit("BLOB(9)"))).head()[0] == "string"


def test_control_file_columns_and_drift(spark, put):
    control, dictionary = put(CONTROL, "t.ctr"), put(DICTIONARY, "t.def")
    listed = [(r.column_name, r.legacy_type) for r in ddl_columns(read_documents(spark, control)).orderBy("position").collect()]
    assert listed[:4] == [("ID", "INTEGER"), ("NAME", "CHARACTER(20)"), ("AMOUNT", "DECIMAL(9,2)"), ("SEEN", "TIMESTAMP(26)")]
    assert len(listed) == 10
    check_schema(spark, control, dictionary)
    with pytest.raises(ValueError, match="differ in 2"):
        check_schema(spark, control, put(DICTIONARY.replace("DAY,DATE", "DIA,DATE").replace("S,SMALLINT", "S,INTEGER"), "u.def"))
    same_doc = lambda df: df.withColumn("doc", F.lit("d"))
    short = DICTIONARY.rsplit("\n", 2)[0] + "\n"
    drift = schema_drift(same_doc(ddl_columns(read_documents(spark, control))), same_doc(dictionary_columns(read_documents(spark, put(short, "v.def")))))
    assert rows(drift.where("status <> 'equal'").select("position", "status")) == [(9, "only_in_ddl")]
    assert rows(conforms(drift)) == [("d", 1, False)]


def test_control_columns_by_depth(spark, put):
    text = """CREATE TABLE A.C ( AMT DECIMAL(9,2) DEFAULT (COALESCE(0,(1))), NOTE CHARACTER(5) DEFAULT 'a,)(b', ")" INTEGER,
        K SMALLINT CHECK (K IN (1,(2),3) ) ) PARTITIONED BY (DAY CHARACTER(10), X INTEGER);"""
    listed = rows(ddl_columns(read_documents(spark, put(text, "d.ctr"))).orderBy("position").select("column_name", "legacy_type"))
    assert listed == [("AMT", "DECIMAL(9,2)"), ("NOTE", "CHARACTER(5)"), ('")"', "INTEGER"), ("K", "SMALLINT")]
    assert ddl_columns(read_documents(spark, put("CREATE TABLE A.C ( ID INTEGER, N (", "e.ctr"))).count() == 0


SETTINGS = "retention=30\nhdfs_path_source={land}\nhdfs_path_save={save}\ndatabase=default\nfile_count=2\nos_path_source=/os/?k=v\n"


def test_settings(spark, put):
    found = read_settings(spark, put(SETTINGS.format(land="/l/", save="/s/") + "demiliter=|\nheader=true\n", "t.conf"))
    assert (found.retention, found.file_count, found.landing_path, found.quote_mode) == (30, 2, "/os/?k=v", "NON_NUMERIC")
    assert (found.dialect.delimiter, found.dialect.header, found.dialect.quote, found.dialect.profile) == ("|", True, '"', "legacy")
    with pytest.raises(ValueError, match="database, file_count"):
        read_settings(spark, put("retention=1\nhdfs_path_source=a\nhdfs_path_save=b\nos_path_source=c\nfile_count=\n", "u.conf"))


def test_manifest_and_readiness(spark, put, tmp_path):
    for name in ("AAA_1_190616.CSV", "AAA_2_190616.CSV", "AAA_1_190616.BST", "AAA_2_190616.BST", "BBB190616.BST", "BBB190616.CSV", "CCC_1_190616.CSV", "DDD_1_190616.BST", "DDD_2_190616.BST", "notes.txt"):
        put("" if name.endswith("BST") else "x\n", f"land/{name}")
    files = manifest(spark, str(tmp_path / "land"))
    assert files.count() == 10 and files.where("table_name = ''").count() == 1
    expected = spark.createDataFrame([(t, "190616", 2) for t in ("AAA", "BBB", "CCC", "DDD")], "table_name string, odate string, file_count int")
    status = {r.table_name: r.status for r in batch_readiness(files, expected).collect()}
    assert status == {"AAA": "READY", "BBB": "PARTIAL", "CCC": "MISSING", "DDD": "MISMATCH"}
    assert list_files(spark, str(tmp_path / "land"), batch_glob("AAA", "190616", "CSV")).count() == 2
    assert "content" not in files.columns


def test_table_names_with_separators(spark, put, tmp_path):
    for name in ("TB_ITEMS_1_190616", "TB_ITEMS_OLD_1_190616", "TB_1_190616", "P-Q190616", "ZZ_190616"):
        for kind in ("CSV", "BST"):
            put("", f"land/{name}.{kind}")
    expected = spark.createDataFrame([(t, "190616", 1) for t in ("TB", "TB_ITEMS", "TB_ITEMS_OLD", "P-Q", "P")], "table_name string, odate string, file_count int")
    status = {r.table_name: r.status for r in batch_readiness(manifest(spark, str(tmp_path / "land")), expected).collect()}
    assert status == {"TB": "READY", "TB_ITEMS": "READY", "TB_ITEMS_OLD": "READY", "P-Q": "READY", "P": "MISSING"}


def test_file_verdicts(spark):
    counts = spark.createDataFrame([("a", "x", 0), ("a", "y", 3), ("b", "z", 0), ("c", "w", 1)], "batch string, path string, rows long")
    assert {r.path: r.verdict for r in file_verdicts(counts, ["batch"]).collect()} == {"x": "SKIPPED", "y": "LOADED", "z": "ERROR", "w": "LOADED"}


@pytest.fixture
def landed(spark, put, tmp_path):
    """A table, its settings and dictionary, and a batch of three files of which one is empty."""
    spark.sql("DROP TABLE IF EXISTS default.sales")
    save, land = tmp_path / "save", tmp_path / "land"
    spark.sql(f"CREATE TABLE default.sales (ID INT, NAME STRING, AMOUNT DECIMAL(9,2), SEEN TIMESTAMP, DAT_REF_CARGA STRING) USING parquet PARTITIONED BY (DAT_REF_CARGA) LOCATION '{save}'")
    put('1;"Ann; B";10,50;2019-06-19-10.11.12.123456\n2;null;;\n', "land/SALES_1_190616.CSV")
    put("3;Cid;1,00;2019-06-20-00.00.00.000000\n", "land/SALES_2_190616.CSV")
    put("", "land/SALES_3_190616.CSV")
    put("9;other;1,00;\n", "land/SALES_1_200616.CSV")
    put("ID,INTEGER\nNAME,CHARACTER(9)\nAMOUNT,DECIMAL(9,2)\nSEEN,TIMESTAMP(26)\n", "sales.def")
    conf = put(SETTINGS.format(land=f"{land}/", save=f"{save}/"), "sales.conf")
    yield read_settings(spark, conf), str(tmp_path / "sales.def")
    spark.sql("DROP TABLE IF EXISTS default.sales")


def test_load_batch(spark, landed, tmp_path):
    settings, dictionary = landed
    spark.sql("CREATE DATABASE IF NOT EXISTS reports")
    spark.sql("DROP TABLE IF EXISTS reports.loads")
    for _ in range(2):  # a rerun replaces the partition
        result = load_batch(spark, settings, "SALES", "190616", dictionary, audit_table="reports.loads")
    assert (result.ref_date, result.rows) == ("2016-06-19", 3)
    assert sorted(rows(result.counts.select("rows"))) == [(0,), (1,), (2,)]
    loaded = spark.table("default.sales").orderBy("ID")
    assert [tuple(r)[:3] for r in loaded.select("ID", "NAME", "AMOUNT").collect()] == [(1, "Ann; B", Decimal("10.50")), (2, None, None), (3, "Cid", Decimal("1.00"))]
    audit = spark.table("reports.loads").collect()
    assert len(audit) == 2
    assert (audit[0].db, audit[0].tabela, audit[0].qtde_arquivos, audit[0].qtde_linhas, audit[0].dat_ref_carga) == ("default", "SALES", 3, 3, "2016-06-19")
    assert audit[0].arq_carregados == "SALES_1_190616.CSV / SALES_2_190616.CSV / SALES_3_190616.CSV"
    assert audit[0].tamanho == sum(p.stat().st_size for p in (tmp_path / "land").glob("SALES*190616.CSV"))
    spark.sql("DROP TABLE reports.loads")


def test_batch_delivered_again_with_fewer_rows(spark, landed, put):
    settings, dictionary = landed
    assert load_batch(spark, settings, "SALES", "190616", dictionary).rows == 3
    put("", "land/SALES_1_190616.CSV")
    again = load_batch(spark, settings, "SALES", "190616", dictionary)
    assert again.rows == 1 and rows(spark.table("default.sales").select("ID")) == [(3,)]
    for name in ("SALES_2_190616.CSV", "SALES_3_190616.CSV"):
        put("", f"land/{name}")
    assert load_batch(spark, settings, "SALES", "190616", dictionary).rows == 0
    assert spark.table("default.sales").count() == 0


def run_folders(tmp_path):
    return sorted(str(p) for p in (tmp_path / "save").rglob("_run-*"))


def test_failed_load_leaves_everything_as_it_was(spark, landed, put, tmp_path):
    settings, dictionary = landed
    for used in ("loads", "loads_files"):
        spark.sql(f"DROP TABLE IF EXISTS default.{used}")
    load = lambda date, **changed: load_batch(spark, replace(settings, **changed), "SALES", date, dictionary, audit_table="default.loads")
    load("190616")
    load("200616")
    state = lambda: (sorted(rows(spark.table("default.sales").select("ID", "DAT_REF_CARGA"))), spark.table("default.loads").count(), spark.table("default.loads_files").count(), run_folders(tmp_path))
    before = state()
    assert before[0] == [(1, "2016-06-19"), (2, "2016-06-19"), (3, "2016-06-19"), (9, "2016-06-20")] and before[1:3] == (2, 4) and len(before[3]) == 2
    put("4;Dan;1,00;2019-06-20-00.00.00.000000\nx;Eve;1,00;\n", "land/SALES_2_190616.CSV")
    with pytest.raises(Exception, match="(?i)cast|malformed|invalid|x"):
        load("190616")
    assert state() == before
    put("", "land/SALES_1_200616.CSV")
    with pytest.raises(ValueError, match="empty"):
        load("200616", file_count=1)
    assert state() == before
    put("9;other;2,00;\n", "land/SALES_1_200616.CSV")
    load("200616")
    after = state()
    assert after[0] == before[0] and after[1:3] == (3, 5) and len(after[3]) == 2 and after[3] != before[3]
    for used in ("loads", "loads_files"):
        spark.sql(f"DROP TABLE default.{used}")


def test_partition_written_by_other_means_is_replaced(spark, landed, tmp_path):
    settings, dictionary = landed
    old = tmp_path / "save" / "DAT_REF_CARGA=2016-06-20"
    spark.sql("SELECT 7 AS ID, 'old' AS NAME, cast(1 AS decimal(9,2)) AS AMOUNT, cast(NULL AS timestamp) AS SEEN").write.parquet(str(old))
    add_partition(spark, "default.sales", {"DAT_REF_CARGA": "2016-06-20"}, str(old))
    assert rows(spark.table("default.sales").select("ID")) == [(7,)]
    load_batch(spark, settings, "SALES", "200616", dictionary)
    assert rows(spark.table("default.sales").select("ID")) == [(9,)]
    assert [p.name[:5] for p in old.iterdir()] == ["_run-"]


def test_file_names_of_large_batches(spark):
    files = spark.range(250).select(F.lit("x").alias("b"), F.format_string("/l/f%03d.CSV", "id").alias("path"), F.lit(1).cast("bigint").alias("rows"), F.lit(2).cast("bigint").alias("length"))
    one = files.withColumn("b", F.when(F.col("path") < "/l/f002", "y").otherwise("x"))
    found = {r.b: r for r in batch_totals(one, ["b"]).collect()}
    assert found["y"].file_names == "f000.CSV / f001.CSV" and (found["x"].files, found["x"].rows, found["x"].bytes) == (248, 248, 496)
    names = found["x"].file_names.split(" / ")
    assert names[:100] == [f"f{k:03d}.CSV" for k in range(2, 102)] and len(names) == 101 and names[100].startswith("... (248 files, ")
    other = one.withColumn("path", F.replace("path", F.lit("f249"), F.lit("f250")))
    assert {r.b: r.file_names for r in batch_totals(other, ["b"]).collect()}["x"] != found["x"].file_names


def test_load_errors(spark, landed, put):
    settings, dictionary = landed
    with pytest.raises(LookupError, match="no table"):
        load_batch(spark, settings, "NOSUCH", "190616", dictionary)
    with pytest.raises(Exception, match="(?i)not exist|no file"):
        load_batch(spark, settings, "SALES", "010101", dictionary)
    with pytest.raises(ValueError, match="ddmmyy"):
        load_batch(spark, settings, "SALES", "991399", dictionary)
    put("", "land/SALES_1_210616.CSV")
    with pytest.raises(ValueError, match="empty"):
        load_batch(spark, replace(settings, file_count=1), "SALES", "210616", dictionary)
    assert load_batch(spark, settings, "SALES", "210616", dictionary).rows == 0
    assert "2016-06-21" not in [r[0] for r in partition_dates(spark, "default.sales").collect()]


def test_retention(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS default.kept")
    root = tmp_path / "kept"
    spark.sql(f"CREATE TABLE default.kept (id BIGINT, DAT_REF_CARGA STRING) USING parquet PARTITIONED BY (DAT_REF_CARGA) LOCATION '{root}'")
    for day in ("2016-06-01", "2016-06-10", "2016-06-19"):
        write_partitions(spark.range(2).withColumn("DAT_REF_CARGA", F.lit(day)), str(root), "DAT_REF_CARGA")
        for _ in range(2):
            add_partition(spark, "default.kept", {"DAT_REF_CARGA": day}, f"{root}/DAT_REF_CARGA={day}")
    today = F.lit("2016-06-19").cast("date")
    assert purge(spark, "default.kept", today, 9, dry_run=True) == ["2016-06-01"]
    assert spark.table("default.kept").count() == 6
    assert purge(spark, "default.kept", today, 9, root=str(root)) == ["2016-06-01"]
    assert spark.table("default.kept").count() == 4
    assert sorted(p.name for p in root.glob("DAT*")) == ["DAT_REF_CARGA=2016-06-10", "DAT_REF_CARGA=2016-06-19"]
    assert purge(spark, "default.kept", today, 9) == []
    for folder in ("DAT_REF_CARGA=2001-01-01", "DAT_REF_CARGA=__HIVE_DEFAULT_PARTITION__", "other"):
        (root / folder).mkdir()
    assert purge(spark, "default.kept", today, 9, root=str(root)) == ["2001-01-01"]
    assert sorted(p.name for p in root.iterdir() if p.is_dir() and "=20" not in p.name) == ["DAT_REF_CARGA=__HIVE_DEFAULT_PARTITION__", "other"]
    spark.sql("DROP TABLE default.kept")


def test_write_partitions_replaces_only_what_it_holds(spark, tmp_path):
    path = str(tmp_path / "p")
    two = spark.range(10).withColumn("day", F.when(F.col("id") < 5, "a").otherwise("b"))
    write_partitions(two, path, "day", rebalance=True)
    write_partitions(spark.range(1).withColumn("day", F.lit("a")), path, "day")
    assert sorted(rows(spark.read.parquet(path).groupBy("day").count())) == [("a", 1), ("b", 5)]
    write_partitions(spark.range(1).withColumn("day", F.lit("a")), path, "day", replace=False)
    assert spark.read.parquet(path).where("day = 'a'").count() == 2


def test_ratings(spark, put, tmp_path):
    lines = spark.createDataFrame([("u,p,5",), ("u,p",), ("u,p,4,x",)], "value string")
    assert rows(split_ratings(lines)) == [("u", "p", "5", None, False), ("u", "p", None, "u,p", True), ("u", "p", "4", None, False)]
    spark.sql("DROP TABLE IF EXISTS default.rated")
    spark.sql(f"CREATE TABLE default.rated (usuario STRING, produto STRING, avaliacao STRING, data STRING) USING parquet PARTITIONED BY (data) LOCATION '{tmp_path}/rated'")
    saved = str(tmp_path / "saved")
    load = lambda text, day: load_ratings(spark, put(text, f"{day}.csv"), saved, "default.rated", day)
    state = lambda: (sorted(rows(spark.table("default.rated"))), sorted(rows(rejected_ratings(spark, saved))))
    assert load("u,p,5\nshort\n", "2019-01-01") == 1
    assert state() == ([("u", "p", "5", "2019-01-01")], [("short", "2019-01-01")])
    assert load("v,q,1\nw,q,2\n", "2019-01-02") == 0
    both = state()
    assert both == ([("u", "p", "5", "2019-01-01"), ("v", "q", "1", "2019-01-02"), ("w", "q", "2", "2019-01-02")], [("short", "2019-01-01")])
    assert load("u,p,5\nshort\n", "2019-01-01") == 1 and state() == both  # a rerun replaces
    assert load("only short\n", "2019-01-01") == 1
    assert state() == (both[0][1:], [("only short", "2019-01-01")])
    assert load("z,z,1\n", "2019-01-01") == 0 and state() == ([*both[0][1:], ("z", "z", "1", "2019-01-01")], [])
    spark.sql("DROP TABLE default.rated")


def test_catalog_lookup(spark):
    assert not table_exists(spark, "default", "absent")


def test_empty_files_are_counted(spark, put, tmp_path):
    put("1\n", "land/a b%.csv")
    put("", "land/b.csv")
    read = spark.read.text(str(tmp_path / "land")).select(F.col("_metadata.file_path").alias("source_file"))
    counts = file_counts(list_files(spark, str(tmp_path / "land")), rows_per_file(read))
    assert sorted((Path(r.path).name, r.rows) for r in counts.collect()) == [("a%20b%25.csv", 1), ("b.csv", 0)]
