"""A corpus from raw documents to token digests: five stages over the documents that the one before kept.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``. A stage that filters
keeps everything it has no reason to drop. Near duplicates and contamination are decided row by row, also among rows
with equal or null ids: such a stage first writes its input with a number for each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaftext.llm.bpe import token_digests
from sheaftext.llm.common import materialise, table
from sheaftext.llm.decontaminate import build_index, find_items
from sheaftext.llm.jaccard_join import jaccard_components
from sheaftext.llm.line_dedup import dedup_lines
from sheaftext.llm.toxicity import drop_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` with a number for each row, written so that it stays the same."""
    return materialise(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), label)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score 0.7 or more."""
    return drop_toxic(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines; ``n_chars`` follows the text."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id (null before all, then the first row) of every group of five-word Jaccard 0.8 or more."""
    rows = _numbered(docs, "rows-to-compare")
    found = jaccard_components(rows.select(F.col("row").alias("doc_id"), "text"), size=5, percent=80).select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct("doc_id", "row")).alias("first")  # nulls come first
    kept = found.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(first).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold ten consecutive words of a benchmark item (or a whole shorter item)."""
    rows = _numbered(docs, "rows-to-search")
    found = find_items(build_index(rows.select(F.col("row").alias("doc_id"), "text")), table(spark, sf_dir, "benchmark"))
    hit = found.where(F.size("items") > 0).select(F.col("doc_id").alias("row"))
    return rows.join(hit, "row", "left_anti").select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode, decode, and digest both."""
    return token_digests(docs)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination), ("BPE encoding and decoding", bpe)]

#: The first stage is a trained model, which SQL can't express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
