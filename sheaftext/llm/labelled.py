"""A bounded sample of labelled documents, and a model trained on it in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, crc_mod_column

FOLDS = 3
HELD_OUT = 1
#: Bytes of text of either label that a model is trained on, at most.
TRAIN_BYTES = 16 << 20


def training_ids(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` documents of either label outside the held-out fold, in the order of
    a hash of the id. Null labels and ids are left out; of several labels of one id the largest counts."""
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (crc_mod_column("doc_id", FOLDS) != HELD_OUT))
    each = known.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = [each.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return first[0].union(first[1])


def sample(docs: DataFrame, ids: DataFrame, most: int = TRAIN_BYTES) -> DataFrame:
    """(doc_id, text, label) of the documents in ``ids``, whole texts, in the order of a hash of the id as long as the texts of a label
    stay within ``most`` bytes. Of several rows of one id the smallest text counts, null and empty ones first."""
    rows = docs.select("doc_id", as_bytes("text").alias("text")).join(F.broadcast(ids), "doc_id")
    single = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    return single.withColumn("so_far", so_far).where(F.col("so_far") <= most).drop("so_far")


def train(docs: DataFrame, ids: DataFrame, fit: Callable[[list[tuple[int, bytes, int]]], bytes]) -> bytes:
    """``fit`` on the sampled (doc_id, text, label) rows, run once on an executor."""
    rows = sample(docs, ids).repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "label")))]
        yield pa.RecordBatch.from_arrays([pa.array([fit(sorted(held))], pa.binary())], ["model"])

    made = rows.mapInArrow(run, "model binary").collect()
    return bytes(made[0].model) if made else fit([])
