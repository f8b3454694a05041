"""Queries over tables of this test's own, looked at for what a larger table would make of them."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from sheaftext.catalog.scans import _small_splits
from sheaftext.llm import collocations, jaccard_join
from sheaftext.llm.common import as_bytes, flat, importable
from sheaftext.operators.schema_docs import ddl_columns
from sheaftext.session import scratch_root
from sheaftext.sources.landing import expected_batches
from sheaftext.sources.settings import settings_table


@pytest.fixture
def documents(spark, tmp_path):
    texts = [f"line {i},\n\"said\" {i} " * (1 + i % 40) for i in range(400)]
    rows = [(i, t, "en" if i % 2 else "de", "web", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def written(spark, label, since):
    """Bytes of the files that a query has left under a label."""
    new = [p for p in Path(scratch_root(spark).removeprefix("file:")).glob(f"{label}-*") if p not in since]
    return [f.stat().st_size for p in new for f in p.rglob("part-*")]


def test_long_fields_are_written_compressed(spark, documents):
    since = set(Path(scratch_root(spark).removeprefix("file:")).glob("long-fields-*"))
    rows = entry.queries()["csv_long_fields"](spark, documents).collect()
    assert len(rows) == 400 and min(r.chars for r in rows) > 140_000
    assert sum(written(spark, "long-fields", since)) * 20 < sum(r.chars for r in rows)


def test_files_find_their_table_without_a_row_per_beginning(spark):
    names = ["T", "TB", "TB_A", "TB_AB", "TB_B_\u00e9\U0001f600", "U-1", "TB_A"]
    paths = [f"/l/{n}{x}190616.CSV" for n in names for x in ("", "_1_", "\U0001f600", "B")] + ["/l/x190616.CSV", "/l/TB_A190617.CSV", "/l/TB_A_1_190616.CSV", "/m/TB_A_1_190616.CSV"]
    files = spark.createDataFrame([(p,) for p in paths] + [(None,)], "path string")
    expected = spark.createDataFrame([(n, "190616") for n in names] + [(None, "190616"), ("TB_A", None)], "table_name string, odate string")
    found = expected_batches(files, expected)
    stem = lambda p: p.rsplit("/", 1)[1][:-10]
    right = {(p, max((n for n in names if stem(p).startswith(n)), key=len)) for p in paths if "190616" in p and stem(p).startswith(("T", "U-1"))}
    rows = [(r.path, r.table_name) for r in found.collect()]
    assert len(rows) == len(right) and set(rows) == right
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert expected_batches(files, expected.limit(0)).count() == 0


@pytest.mark.parametrize(("query", "label"), [("csv_multiline_documents", "documents-csv"), ("csv_multiline_ragged", "documents-ragged")])
def test_documents_are_written_by_several_tasks(spark, documents, query, label):
    since = set(Path(scratch_root(spark).removeprefix("file:")).glob(f"{label}-*"))
    with _small_splits(spark, f"{documents}/documents.parquet", 4096):  # a task per row group
        found = entry.queries()[query](spark, documents)
    assert found.where("doc_id is not null").count() == 400
    assert sum(size > 0 for size in written(spark, label, since)) > 1


def test_splits_grow_with_the_files(spark, tmp_path):
    key = "spark.sql.files.maxPartitionBytes"
    kept = spark.conf.get(key)
    for size, split in ((100, 4096), (64 * 10_000, 10_000), (1 << 20, 1 << 14)):
        (tmp_path / "f").write_bytes(b"x" * size)
        with _small_splits(spark, str(tmp_path), 4096):
            assert int(spark.conf.get(key)) == split
    assert spark.conf.get(key) == kept


def test_settings_shuffle_one_row_per_document(spark):
    rows = [("a", "x=1\n database = d=e \nretention=5\nretention=6"), ("a", "\n\n\n\nretention=4\r\nfile_count=2\r\ndemiliter=|"), ("b", None), (None, "retention=9")]
    found = settings_table(spark.createDataFrame(rows, "doc string, text string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    got = sorted((r.doc or "", r.retention, r.database, r.file_count, r.delimiter) for r in found.collect())
    assert got == [("", None, None, None, ";"), ("a", 5, " d=e ", 2, "|"), ("a", 5, " d=e ", 2, "|"), ("b", None, None, None, ";")]


def test_control_files_are_scanned_once_by_tokens(spark):
    texts = ["CREATE TABLE T (A INT DEFAULT '\U0001f600,(', B DECIMAL(9 , 2) DEFAULT (f(1, (2))), C CHARACTER(3) DEFAULT \")`\") ; (x, y)", "CREATE TABLE U (A INT, B 'INT)", "CREATE TABLE V (A (INT", None]
    found = ddl_columns(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc string, text string"))
    assert sorted((r.doc, r.position, r.column_name, r.legacy_type) for r in found.collect()) == [("0", 0, "A", "INT"), ("0", 1, "B", "DECIMAL(9,2)"), ("0", 2, "C", "CHARACTER(3)")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1


def test_filter_sends_four_bytes_of_a_shingle(spark):
    batch = pa.RecordBatch.from_arrays([pa.array([b"a b c d e f g", b"a b c d x y z"], pa.binary())], ["text"])
    sent = pa.Table.from_batches(jaccard_join._fragments(4, 8)(iter([batch])))
    tokens = sum(np.frombuffer(c, np.uint32).sum() for c, t in zip(sent.column("counts").to_pylist(), sent.column("tokens").to_pylist()) if t)
    assert sum(len(t) for t in sent.column("tokens").to_pylist()) == 4 * tokens
    importable(spark)
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "a b c d"), (4, "q r s t u v")], "doc_id bigint, text string")
    rows = lambda: sorted(map(tuple, jaccard_join.jaccard_components(docs, 4, 80).select("doc_id", "component_id", "n_links").collect()))
    assert rows() == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0)]


def test_shingles_alike_in_the_filter_only_add_to_what_is_compared():
    digests = np.arange(4, dtype=np.uint64).reshape(2, 2)
    row = lambda tokens: {"digests": jaccard_join.packed(digests), "counts": jaccard_join.packed(np.array([2, 1], np.uint32)), "tokens": jaccard_join.packed(np.array(tokens, np.uint32)), "buckets": 1}
    shared = lambda tokens: sum(np.frombuffer(c, np.int64).sum() for c in jaccard_join._shared_counts(pa.Table.from_pylist([row(tokens)])).column("counts").to_pylist())
    assert shared([2, 4, 6]) == 0 and shared([2, 4, 4]) == 2 and shared([4, 4, 4]) == 3


def test_counting_tasks_give_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(collocations, "release", lambda: calls.append(1))
    text = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([b"a b c"], pa.binary())], ["lang", "text"])
    encoded = list(collocations._encode(iter([text])))
    tokens = pa.RecordBatch.from_arrays([encoded[0].column("tokens")], ["tokens"])
    spans = lambda t: iter([(2, np.array([0]), np.array([7], np.uint64), True)])
    sent = pa.Table.from_batches(collocations._tally(spans, 1)(iter([tokens])))
    assert collocations._summed(1)(sent).num_rows == 1 and len(calls) == 3


def test_filter_sends_as_many_bytes_whatever_the_number_of_fragments():
    texts = [" ".join(f"w{k * 13 + i}" for i in range(400)) for k in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["text"])
    sent = lambda many: pa.Table.from_batches(jaccard_join._fragments(4, many)(iter([batch])))
    size = lambda table: sum(len(v) for c in table.column_names[1:] for v in table.column(c).to_pylist() if isinstance(v, bytes))
    few, many = sent(1), sent(512)
    assert size(many) - 4 * many.num_rows == size(few) - 4 * few.num_rows  # a row has one number beside its tokens


def test_copies_in_other_groups_are_not_shared_and_partners_are(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP_TEXTS", 1)
    importable(spark)
    long = " ".join(f"w{i}" for i in range(40))
    docs = [(1, "a b c d e f"), (2, "A b c d e f"), (3, "a b c d e f"), (4, long), (5, long + " x"), (6, long), (7, "b c d e p q r s t"), (8, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    digests = jaccard_join.sets_of(*flat(pa.array([t.encode() for _, t in docs if t], pa.binary())), 4)[2]
    sizes = spark.createDataFrame([(d.tobytes(), n, 1) for d, n in {(d.tobytes(), n): (d, n) for d, n in zip(digests, [3, 3, 3, 37, 38, 37, 6])}.values()], "digest binary, n bigint, rows bigint")
    found = jaccard_join._survivors(frame.select(as_bytes("text").alias("text")), sizes, 4, 85)
    assert sorted(r.n for r in found.collect()) == [37, 38]
    rows = sorted(map(tuple, jaccard_join.jaccard_components(frame).select("doc_id", "component_id", "n_links").collect()))
    assert rows == [(1, 1, 2), (2, 1, 2), (3, 1, 2), (4, 4, 2), (5, 4, 2), (6, 4, 2), (7, 7, 0), (8, 8, 0)]
