"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the ``K`` smallest distinct 48-bit hashes of a text's shingles of five words (``[^\\x20\\x09-\\x0D]+``,
A-Z in lower case) and is exact while a text has fewer than ``K``. As text it is the base64 form of the
hashes in ascending order, so equal sets have equal sketches. Sketches of parts merge to the sketch of the
union; two sketches give resemblance and containment, one gives the number of distinct shingles.

Defined results: a text of one to four words has one shingle of all its words; a null, empty or blank text has
none and the empty sketch. Two empty sketches resemble each other fully; an empty and another one not at all.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, chunks, partitions, table, values
from sheaftext.llm.words import distinct_per_text, shingles, words

K = 128
WORDS = 5
SPACE = 1 << 48


def sketches(data: np.ndarray, offsets: np.ndarray, k: int = K, size: int = WORDS) -> list[np.ndarray]:
    """The sketch of each text as sorted numbers below 2^48."""
    h, at = shingles(words(data, offsets), size)
    h, at = distinct_per_text(h >> np.uint64(16), at)
    return [h[a : min(b, a + k)] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.concatenate([np.zeros((len(raw), 2), np.uint8), raw], axis=1).reshape(-1).view(">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of two parts."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of intersection over union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    same = both[1:][both[1:] == both[:-1]]
    union = len(both) - len(same)
    if union <= k:
        return len(same) / union
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    limit = both[first][k - 1]
    return np.count_nonzero(same <= limit) / k


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimate of the number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * SPACE / (float(a[-1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of the share of a's shingles that b holds."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def _column(texts: list[bytes], k: int, size: int) -> list[np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return sketches(np.frombuffer(b"".join(texts), np.uint8), offsets, k, size)


def fingerprint(text: str, k: int = K, size: int = WORDS) -> Column:
    """The sketch of a text column, as text."""

    def run(batch: pa.Array) -> pa.Array:
        out = []
        for _, data, offsets in chunks([pa.RecordBatch.from_arrays([batch], ["text"])]):
            out += [encode(s) for s in sketches(data, offsets, k, size)]
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(as_bytes(text))


def _binary(function, kind: str):
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist())
        return pa.array([None if x is None or y is None else function(decode(x), decode(y)) for x, y in pairs], pa.string() if kind == "string" else pa.float64())

    return F.arrow_udf(run, kind)


def likeness(a: str, b: str, k: int = K) -> Column:
    """Estimated resemblance of two sketch columns; null when one is null."""
    return _binary(lambda x, y: resemblance(x, y, k), "double")(F.col(a), F.col(b))


def contained(a: str, b: str, k: int = K) -> Column:
    return _binary(lambda x, y: containment(x, y, k), "double")(F.col(a), F.col(b))


def merged(a: str, b: str, k: int = K) -> Column:
    return _binary(lambda x, y: encode(merge(x, y, k)), "string")(F.col(a), F.col(b))


def shingle_count(a: str, k: int = K) -> Column:
    def run(x: pa.Array) -> pa.Array:
        return pa.array([None if t is None else distinct(decode(t), k) for t in x.to_pylist()], pa.float64())

    return F.arrow_udf(run, "double")(F.col(a))


def chars(text: bytes) -> str:
    return text.decode()


def edited(text: str, other: str) -> str:
    """The last quarter of a text replaced by the first as many characters of another."""
    n = len(text) // 4
    return text[: len(text) - n] + other[:n]


def _pairs(k: int, size: int, block: int = 64):
    """Rows arrive by bucket in the order of ids; the row that ends a bucket only serves as a successor."""

    def emit(rows: list, upto: int) -> pa.RecordBatch:
        pairs = [(a, b) for a, b in zip(rows[:upto], rows[1 : upto + 1]) if a[0] == b[0]]
        texts, seen = [], {}
        columns: list[list] = [[] for _ in range(7)]
        ready = []
        for (_, doc, raw), (_, _, following) in pairs:
            new = edited(chars(raw), chars(following)).encode()
            ready.append((doc, raw, new, following))
            for t in (raw, new, following):
                if t not in seen:
                    seen[t] = len(texts)
                    texts.append(t)
        prints = _column(texts, k, size) if texts else []
        for doc, raw, new, following in ready:
            own, changed, after = (prints[seen[t]] for t in (raw, new, following))
            row = (doc, len(chars(raw)), hashlib.sha256(new).hexdigest(), encode(own), encode(changed), resemblance(own, changed, k), resemblance(own, after, k))
            for c, v in zip(columns, row):
                c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size_now = 0
        for part, data, offsets in chunks(batches, 1 << 18):
            for bucket, doc, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), values(data, offsets)):
                rows.append((bucket, doc, text))
                size_now += len(text)
                if size_now > 1 << 20 or len(rows) > 4096:
                    yield emit(rows, len(rows) - 1)
                    rows, size_now = rows[-1:], 0
        yield emit(rows, len(rows) - 1) if len(rows) > 1 else emit([], 0)

    return run


def compare_with_next(docs: DataFrame, k: int = K, size: int = WORDS) -> DataFrame:
    """Each document beside its edited text and the next document by id (after the last: the first).

    Ids are cut into buckets of near-equal numbers of rows; a bucket also gets a copy of the document that
    follows its last one. So one shuffle of the texts is enough and no task holds more than its buckets.
    Equal ids follow in the order of their texts; null ids come first.
    """
    many = 4 * partitions(docs.sparkSession)
    id_ = F.col("doc_id")
    cuts = docs.select(F.percentile_approx("doc_id", [i / many for i in range(1, many)], 100 * many)).first()[0] or []
    edges = sorted(set(cuts))
    bucket = F.when(id_.isNull(), 0).otherwise(reached(id_, edges))
    rows = docs.select(id_, as_bytes("text").alias("text")).withColumn("bucket", bucket)
    firsts = rows.groupBy("bucket").agg(F.min(F.struct(id_.isNotNull(), id_, "text")).alias("first"))
    heads = firsts.select("bucket", F.col("first.doc_id").alias("doc_id"), F.col("first.text").alias("text"))
    buckets = sorted(r.bucket for r in firsts.select("bucket").collect())  # at most four per shuffle partition
    before = {b: a for a, b in zip([buckets[-1], *buckets[:-1]], buckets)} if buckets else {}
    numbers = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else None
    own = rows.select("bucket", F.lit(0).alias("end"), "doc_id", "text")
    if before:
        own = own.unionAll(heads.select(numbers[F.col("bucket")].alias("bucket"), F.lit(1).alias("end"), "doc_id", "text"))
    order = own.repartition(many // 4, "bucket").sortWithinPartitions("bucket", "end", F.col("doc_id").asc_nulls_first(), "text")
    return order.mapInArrow(
        _pairs(k, size),
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def reached(value: Column, edges: list) -> Column:
    """How many of the sorted edges a value reaches, by halving: nested conditions of logarithmic depth."""

    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= F.lit(edges[mid]), between(mid + 1, hi)).otherwise(between(lo, mid))

    return between(0, len(edges))


def op3_fingerprints(spark, sf_dir):
    return compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
