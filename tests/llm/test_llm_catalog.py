"""SQL of the queries that have it, and the pipeline against brute force."""

import pytest

import brute
import corpus_pipeline
from compare import connect, differences
from sheaftext.llm import catalog
from sheaftext.llm.bpe import token_digests
from sheaftext.llm.toxicity import drop_toxic

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in catalog.QUERIES.items() if sql))
def test_query(spark, name):
    run, sql = catalog.QUERIES[name]
    assert differences(run(spark, SF), connect(SF), sql) is None


def test_line_dedup_counts_rows_as_documents(spark, tmp_path):
    """Rows with one id are documents of their own, in the query and in its SQL."""
    line = "a line of more than twenty letters"
    rows = [(1, f"{line}\nx"), (1, line), (1, line), (2, f"{line} twice\n{line} twice"), (3, f"{line} twice")]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/t")
    (tmp_path / "documents.parquet").symlink_to(next((tmp_path / "t").glob("part-*")))
    run, sql = catalog.QUERIES["op1_line_dedup"]
    assert differences(run(spark, str(tmp_path)), connect(str(tmp_path)), sql) is None


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = drop_toxic(docs, spark.read.parquet(f"{SF}/labels.parquet")).select("doc_id", "text").collect()
    lines = [(i, t) for i, _, _, t in brute.line_dedup([(r.doc_id, r.text) for r in kept])]
    roots = brute.components(lines, 5, 80)
    single = [(i, t) for i, t in lines if roots[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, _, n, _ in brute.contamination(single, items) if not n}
    left = spark.createDataFrame([(i, t) for i, t in single if i in clean], "doc_id bigint, text string")
    assert 0 < len(clean) < docs.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, token_digests(left).collect()))


def test_stages_on_odd_rows(spark, folder):
    for path in folder:
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, path)
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
            assert out.count() <= docs.count()
        assert corpus_pipeline.run(spark, path).count() >= 0


def test_stages_decide_row_by_row(spark, folder):
    family = " ".join(f"w{k}" for k in range(40))
    texts = [(None, "single short"), (None, "a clean row"), (None, family), (None, family), (3, family + " more"), (3, family), (3, "another clean row"), (3, "x single short"), (7, None), (7, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    texts_of = lambda df: sorted(map(repr, ((r.doc_id, r.text) for r in df.collect())))
    clean = [r for r in texts if "single short" not in (r[1] or "")]
    assert texts_of(corpus_pipeline.decontamination(spark, docs, folder[0])) == sorted(map(repr, clean))
    single = [r for r in texts if family not in (r[1] or "")] + [(None, family)]
    assert texts_of(corpus_pipeline.near_duplicates(spark, docs, folder[0])) == sorted(map(repr, single))
    same_id = docs.where("doc_id = 3")
    assert corpus_pipeline.near_duplicates(spark, same_id, folder[0]).count() == 3
