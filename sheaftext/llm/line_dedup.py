"""Line deduplication: minimal perfect hashes over line hashes, probed by the documents.

A line's key is the line without blanks at both ends, A-Z in lower case, as a 128-bit hash. Keys held by
enough documents go into shards. A shard is a minimal perfect hash with three arrays in its order: a 64-bit
fingerprint, the number of documents, and the largest document id. Documents send packed blocks of hashes
to the shards and get back what to drop; lines themselves are never joined.

Repeated lines are found in all documents, whatever their number: a key held by a third of the documents
is one entry of the arrays, and its shard is copied to as many tasks as its probes need.

Defined results: a null or empty text is one empty line (empty lines are never keys long enough to drop);
a null id counts as smaller than every id; rows with equal ids count as documents of their own and, if that
id is the one that keeps a line, all of them keep it; an empty table gives an empty table. Columns named
like the result (``text n_lines n_dropped``) are replaced; all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, chunks, materialise, packed, partitions, table, values
from sheaftext.llm.words import mix

BLANK = b" \t\n\x0b\x0c\r"
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
KEYS_PER_SHARD = 250_000
NO_ID = -(2**63)
_U = np.uint64


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or None when it is too short to count."""
    key = line.strip(BLANK)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key.translate(FOLD)


def hash_of(key: bytes) -> tuple[int, int]:
    """High and low half of the 128-bit hash, as signed numbers."""
    d = xxhash.xxh3_128_digest(key)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _document_keys(text: bytes, min_chars: int) -> set[tuple[int, int]]:
    return {hash_of(k) for line in text.split(b"\n") if (k := key_of(line, min_chars)) is not None}


class PerfectHash:
    """Levels of bit arrays: a key rests on the first level where no other remaining key has its bit.
    The place of a key is the number of set bits before its own."""

    def __init__(self, bits: np.ndarray, sizes: list[int]):
        self.bits, self.sizes = bits, sizes
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @staticmethod
    def _spot(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(high + low * _U(2 * level) + _U(level)) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels, sizes = [], []
        while len(high):
            size = len(high) * 2
            at = cls._spot(high, low, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            left = ~alone[at]
            high, low = high[left], low[left]
        return cls(np.concatenate([np.zeros(0, bool), *levels]), sizes)

    def places(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for keys that are surely absent. Other absent keys get any place."""
        out = np.full(len(high), -1, np.int64)
        left, base = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._spot(high[left], low[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
            base += size
        return out

    def dump(self) -> tuple[bytes, bytes]:
        return np.packbits(self.bits).tobytes(), packed(np.array(self.sizes, np.int64))

    @classmethod
    def load(cls, bits: bytes, sizes: bytes) -> PerfectHash:
        s = np.frombuffer(sizes, np.int64).tolist()
        return cls(np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(s)).astype(bool), s)


def _lines_of(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            rows = [(h, l, i) for i, text in zip(part.column(0).to_pylist(), values(data, offsets)) for h, l in _document_keys(text, min_chars)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["high", "low", "doc"])

    return run


def _build_shard(rows: pa.Table) -> pa.Table:
    high, low, n, keeper = (rows.column(c).to_numpy() for c in ("high", "low", "n", "keeper"))
    function = PerfectHash.build(high.view(_U), low.view(_U))
    at = function.places(high.view(_U), low.view(_U))
    arrays = [np.empty(len(at), a.dtype) for a in (low, n, keeper)]
    for array, column in zip(arrays, (low, n, keeper)):
        array[at] = column
    counts = arrays[1].astype(np.min_scalar_type(int(n.max())))
    bits, sizes = function.dump()
    return pa.table(
        {"shard": rows.column("shard")[:1], "bits": [bits], "sizes": [sizes], "fingerprints": [packed(arrays[0])], "counts": [packed(counts)], "count_type": [counts.dtype.str], "keepers": [packed(arrays[2])], "hits": [int(n.sum())], "shards": rows.column("shards")[:1]}
    )


_SHARD = "shard bigint, bits binary, sizes binary, fingerprints binary, counts binary, count_type string, keepers binary, hits bigint, shards bigint"


def line_index(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The shards over all line keys of ``docs`` (doc_id, text) held by at least ``min_docs`` documents."""
    lines = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), as_bytes("text").alias("text")).mapInArrow(_lines_of(min_chars), "high bigint, low bigint, doc bigint")
    keys = materialise(lines.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= min_docs), "line-keys")
    shards = keys.count() // KEYS_PER_SHARD + 1
    sharded = keys.withColumn("shard", F.pmod("high", F.lit(shards))).withColumn("shards", F.lit(shards).cast("bigint"))
    return materialise(sharded.groupBy("shard").applyInArrow(_build_shard, _SHARD), "line-shards")


def _probes(min_chars: int, shards: int, splits: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, 1 << 18):
            found = [(h, l, i) for i, text in zip(part.column(0).to_pylist(), values(data, offsets)) for h, l in _document_keys(text, min_chars)]
            high, low, doc = (np.array([r[k] for r in found], np.int64) for k in range(3))
            shard = high % shards
            rows = []
            for s in np.unique(shard).tolist():
                if s in splits:
                    own = shard == s
                    rows.append((s, int(low[own][0] & 0x7FFFFFFF) % splits[s], packed(high[own]), packed(low[own]), packed(doc[own])))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["shard", "split", "high", "low", "doc"])

    return run


def _answer(min_docs: int):
    """Rows arrive sorted: the arrays of a shard, then the blocks that probe it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    function = PerfectHash.load(r["bits"], r["sizes"])
                    prints, keepers = (np.frombuffer(r[c], np.int64) for c in ("fingerprints", "keepers"))
                    counts = np.frombuffer(r["counts"], r["count_type"])
                    continue
                high, low, doc = (np.frombuffer(r[c], np.int64) for c in ("high", "low", "doc"))
                at = function.places(high.view(_U), low.view(_U))
                safe = np.maximum(at, 0)
                drop = (at >= 0) & (prints[safe] == low) & (counts[safe] >= min_docs) & (keepers[safe] != doc)
                ids, low = doc[drop], low[drop]
                cuts = np.flatnonzero(np.diff(ids)) + 1
                out += [(int(i[0]), packed(l)) for i, l in zip(np.split(ids, cuts), np.split(low, cuts)) if len(i)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["doc", "drops"])

    return run


def lines_to_drop(docs: DataFrame, index: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc, drops): the low hash halves of the lines that each document loses."""
    spark = docs.sparkSession
    many = partitions(spark)
    known = index.select("shard", "hits", "shards").collect()  # one row per 250,000 keys
    load, shards = {r.shard: r.hits for r in known}, known[0].shards if known else 1
    share = max(1, sum(load.values()) // many)
    splits = {s: max(-(-many // len(load)), -(-n // share)) for s, n in load.items()}
    blocks = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), as_bytes("text").alias("text")).mapInArrow(
        _probes(min_chars, shards, splits), "shard bigint, split bigint, high binary, low binary, doc binary"
    )
    numbers = spark.createDataFrame(sorted(splits.items()), "shard bigint, n bigint")
    copies = index.join(numbers, "shard").select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("split")).withColumn("kind", F.lit(0)).drop("n", "hits", "shards")
    merged = copies.unionByName(blocks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    asked = merged.repartition(many, "shard", "split").sortWithinPartitions("shard", "split", "kind").mapInArrow(_answer(min_docs), "doc bigint, drops binary")
    return asked.groupBy("doc").agg(F.collect_list("drops").alias("drops"))


def _kept(min_chars: int):
    kind = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

    def run(text: pa.Array, drops: pa.Array) -> pa.Array:
        texts, lines_in, lost = [], [], []
        for t, d in zip(text.to_pylist(), drops.to_pylist()):
            lines = t.split(b"\n")
            kept = lines
            if d:
                gone = set(np.frombuffer(b"".join(d), np.int64).tolist())
                kept = [x for x in lines if (k := key_of(x, min_chars)) is None or hash_of(k)[1] not in gone]
            texts.append(b"\n".join(kept).decode())
            lines_in.append(len(lines))
            lost.append(len(lines) - len(kept))
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(lines_in, pa.int64()), pa.array(lost, pa.int64())], fields=list(kind))

    return F.arrow_udf(run, "text string, n_lines bigint, n_dropped bigint")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with repeated lines removed from ``text`` and two more columns, ``n_lines`` and ``n_dropped``."""
    drops = lines_to_drop(docs, line_index(docs, min_chars, min_docs), min_chars, min_docs)
    extra = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    joined = docs.withColumn("_line_doc", F.coalesce("doc_id", F.lit(NO_ID))).join(drops.withColumnsRenamed({"doc": "_line_doc", "drops": "_line_drops"}), "_line_doc", "left")
    done = joined.select(*[F.col(f"`{c}`") for c in extra], _kept(min_chars)(as_bytes("text"), F.col("_line_drops")).alias("_line_kept"))
    return done.select(*[F.col(f"`{c}`") for c in extra], "_line_kept.*")


def op1_line_dedup(spark, sf_dir):
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_ALPHA = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL = rf"""
WITH split AS MATERIALIZED (
  SELECT row_number() OVER () AS doc_row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_row, doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_ALPHA}) AS k FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_row) >= 3
), marked AS (
  SELECT doc_row, doc_id, pos, line, r.k IS NOT NULL AND doc_id <> r.keeper AS gone FROM keyed LEFT JOIN repeated r USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_row, doc_id
"""
