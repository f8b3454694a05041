"""Shared small pieces: tables, materialised steps, Arrow batches of text."""

from __future__ import annotations

import ctypes
import os
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaftext.session import scratch_path

#: Bytes of text that numpy works on at once; a longer text makes a chunk of its own.
CHUNK_BYTES = (1 << 20) - 1
#: Bytes of an Arrow batch sent to a Python worker.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches are cut by bytes, so that many very long texts never meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def importable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, besides where it is installed for them."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back: later steps neither repeat it nor depend on lost executors.

    Rows may hold packed arrays of a megabyte. The size of a Parquet page is looked at after a few rows, not after a hundred, as pages
    are compressed and read whole, in memory outside the heap.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**{"parquet.page.size.row.check.min": "4", "parquet.page.size.row.check.max": "1000"}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(name: str) -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A binary column as one flat array of bytes and the offsets of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with at most ``limit`` bytes in their last column (one row at least), with those bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = flat(batch.column(batch.num_columns - 1))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def values(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    cuts = offsets.tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def crc_mod(doc_id: int | None, m: int) -> int:
    """crc32 of the id as text, modulo ``m``; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def crc_mod_column(name: str, m: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(m))


def release() -> None:
    """Give memory that a Python worker has freed back to the system; an idle worker would keep it beside the tasks that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def packed(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()
