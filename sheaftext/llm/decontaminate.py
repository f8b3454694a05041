"""Benchmark decontamination with a positional inverted index of the training documents.

The index is cut by documents. A shard holds the words of some documents in one stream of positions: the
sorted distinct word hashes, how often each occurs, and the positions of each word in ascending order (stored
as differences). It is written once and answers any number of queries.

A phrase is looked up from its rarest word of the shard: its positions, less the word's place in the phrase,
are the candidate starts; the lists of the other words, less their places, are intersected with these from the
rarest on. A proximity query finds places where all words of a query lie within a number of words.

The queries are sent to the shards in blocks of bounded size; every document answers every block. Words are
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A word in a third of all documents only makes
lists longer, and each shard has its own; nothing is shuffled by word.

Defined results: a null or empty document has no words and no hits; an item without words matches nothing; an item
of fewer words than a window is one window; items with equal ids count as one; a null item id is the text "";
rows of documents are never merged, also with equal or null ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, chunks, packed, table
from sheaftext.llm.words import SYMBOLS, words
from sheaftext.session import scratch_path

SHARD_BYTES = (2 << 20) - 1
QUERY_WORDS = 1_000_000  # words of all windows in a block of queries: 8 MB
CANDIDATES = 1_000_000  # starts looked at together
_U = np.uint64


class Shard(NamedTuple):
    terms: np.ndarray
    starts: np.ndarray  # of each term's positions, one more than terms
    positions: np.ndarray
    postings: np.ndarray  # term number and position in one sorted number
    docs: np.ndarray  # first position of each document, and the end

    @classmethod
    def load(cls, terms: bytes, counts: bytes, steps: bytes, docs: bytes) -> Shard:
        t, n = np.frombuffer(terms, np.uint64), np.frombuffer(counts, np.uint32)
        starts = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        total = np.cumsum(np.frombuffer(steps, np.uint32), dtype=np.int64)
        before = np.concatenate([[0], total])[starts[:-1]]
        positions = total - np.repeat(before, n)
        number = np.repeat(np.arange(len(t), dtype=np.uint64), n)
        return cls(t, starts, positions, number << _U(32) | positions.astype(np.uint64), np.frombuffer(docs, np.int64))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of terms; -1 for words the shard has not."""
        if not len(self.terms):
            return np.full(hashes.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        return self.starts[numbers + 1] - self.starts[numbers]

    def listed(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of some terms: which term of the list, and the position."""
        n = self.counts(numbers)
        which = np.repeat(np.arange(len(numbers)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return which, self.positions[self.starts[numbers][which] + inside]

    def has(self, numbers: np.ndarray, positions: np.ndarray) -> np.ndarray:
        key = numbers.astype(np.uint64) << _U(32) | np.maximum(positions, 0).astype(np.uint64)
        at = np.minimum(np.searchsorted(self.postings, key), len(self.postings) - 1)
        return (positions >= 0) & (self.postings[at] == key)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.docs, positions, "right") - 1


def _slices(cost: np.ndarray) -> Iterator[slice]:
    """Runs of queries whose candidates fit together; a costlier query is alone."""
    at = 0
    total = np.concatenate([[0], np.cumsum(cost)])
    while at < len(cost):
        to = max(at + 1, int(np.searchsorted(total, total[at] + CANDIDATES, "right")) - 1)
        yield slice(at, to)
        at = to


def phrase_starts(shard: Shard, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, position) of every occurrence of phrases of equal length, given as rows of word hashes."""
    number = shard.numbers(phrases)
    able = np.flatnonzero((number >= 0).all(axis=1))
    number = number[able]
    length = phrases.shape[1]
    counts = shard.counts(number)
    order = np.argsort(counts, axis=1, kind="stable")
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for part in _slices(counts.min(axis=1)) if len(able) else ():
        own, rank = number[part], order[part]
        each = np.arange(len(own))
        which, start = shard.listed(own[each, rank[:, 0]])
        start = start - rank[which, 0]
        fits = (start >= 0) & (start + length <= shard.docs[-1])
        which, start = which[fits], start[fits]
        for r in range(1, length):
            place = rank[which, r]
            hit = shard.has(own[which, place], start + place)
            which, start = which[hit], start[hit]
        whole = shard.doc_of(start) == shard.doc_of(start + length - 1)
        found.append((able[part][which[whole]], start[whole]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_starts(shard: Shard, terms: np.ndarray, within: int) -> np.ndarray:
    """First positions of the runs of ``within`` words that hold every one of the terms."""
    number = shard.numbers(terms)
    if (number < 0).any():
        return np.zeros(0, np.int64)
    rarest = number[np.argsort(shard.counts(number), kind="stable")]
    _, at = shard.listed(rarest[:1])
    start = np.unique((at[:, None] - np.arange(within)[None, :]).reshape(-1))
    start = start[start >= 0]
    doc = shard.doc_of(start)
    for t in rarest:
        own = shard.positions[shard.starts[t] : shard.starts[t + 1]]
        k = np.searchsorted(own, start)
        following = own[np.minimum(k, len(own) - 1)]
        fits = (k < len(own)) & (following < start + within)
        fits[fits] &= shard.doc_of(following[fits]) == doc[fits]
        start, doc = start[fits], doc[fits]
    return start


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches, SHARD_BYTES):
        w = words(data, offsets, SYMBOLS)
        order = np.argsort(w.hashes, kind="stable")
        h = w.hashes[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(first)
        steps = order.astype(np.int64)
        steps[1:] -= order[:-1]
        steps[at] = order[at]
        counts = np.diff(np.append(at, len(h)))
        ids = part.column(0).cast(pa.int64())
        row = [
            packed(ids.fill_null(0).to_numpy(zero_copy_only=False)), packed(ids.is_null().to_numpy(zero_copy_only=False)), packed(w.offsets.astype(np.int64)),
            packed(h[at]), packed(counts.astype(np.uint32)), packed(steps.astype(np.uint32)),
        ]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], ["ids", "no_id", "docs", "terms", "counts", "steps"])


def build_index(docs: DataFrame) -> DataFrame:
    """The written index of ``docs`` (doc_id, text): one row per shard."""
    path = scratch_path(docs.sparkSession, "positions")
    shards = docs.select("doc_id", as_bytes("text").alias("text")).mapInArrow(_index, "ids binary, no_id binary, docs binary, terms binary, counts binary, steps binary").withColumn("shard", F.monotonically_increasing_id())
    shards.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(shards.schema).parquet(path)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, Shard]]:
    for batch in batches:
        for k in range(batch.num_rows):
            r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            ids, empty = np.frombuffer(r["ids"], np.int64).tolist(), np.frombuffer(r["no_id"], bool).tolist()
            yield r["shard"], [None if e else i for i, e in zip(ids, empty)], Shard.load(r["terms"], r["counts"], r["steps"], r["docs"])


def windows_of(items: Iterable[tuple[str, str | None]], size: int) -> Iterator[tuple[str, np.ndarray]]:
    """(item, rows of word hashes) of every item with words."""
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        h = words(raw, np.array([0, len(raw)], np.int64), SYMBOLS).hashes
        if len(h):
            yield item, np.lib.stride_tricks.sliding_window_view(h, min(size, len(h)))


def _blocks(items: Iterable[tuple[str, str | None]], size: int) -> Iterator[dict]:
    """Queries by phrase length, in blocks: length -> (rows of hashes, item number of each row), and item names."""
    held: dict[int, list] = {}
    names: list[str] = []
    n = 0
    for item, rows in windows_of(items, size):
        held.setdefault(rows.shape[1], []).append((rows, np.full(len(rows), len(names))))
        names.append(item)
        n += rows.size
        if n >= QUERY_WORDS:
            yield {"names": names, "phrases": {k: tuple(map(np.concatenate, zip(*v))) for k, v in held.items()}}
            held, names, n = {}, [], 0
    yield {"names": names, "phrases": {k: tuple(map(np.concatenate, zip(*v))) for k, v in held.items()}}


_HITS = "shard bigint, row bigint, doc_id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def _matches(block: dict):
    names = block["names"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, shard in _shards(batches):
            edge = np.zeros(int(shard.docs[-1]) + 1, np.int64)
            doc_items: list[set] = [set() for _ in ids]
            for length, (phrases, owner) in block["phrases"].items():
                which, start = phrase_starts(shard, phrases)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + length, -1)
                pairs = np.unique(np.stack([shard.doc_of(start), owner[which]], axis=1), axis=0) if len(start) else ()
                for d, i in pairs:
                    doc_items[d].add(names[i])
            hit = np.cumsum(edge)[:-1] > 0
            change = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
            inner = np.unique(shard.docs[(shard.docs > 0) & (shard.docs < len(hit))])
            inner = inner[hit[inner] & hit[inner - 1]]  # runs that go on in the next document
            change = np.sort(np.concatenate([change, inner, inner]))
            begin, end = change[::2], change[1::2]
            doc = shard.doc_of(begin)
            spans: list[list] = [[] for _ in ids]
            for d, a, b in zip(doc.tolist(), begin.tolist(), end.tolist()):
                base = int(shard.docs[d])
                spans[d].append({"start": a - base, "end": b - base})
            sizes = np.diff(shard.docs)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [
                pa.array([name] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array([sorted(s) for s in doc_items], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "row", "doc_id", "n_words", "spans", "items"])

    return run


def find_items(index: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document: the words inside any window of any item.

    ``items`` (item_id, text) is the stated query set; it passes through the driver in blocks.
    """
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), "text").toLocalIterator()
    answers = [index.mapInArrow(_matches(b), _HITS) for b in _blocks(((r.i, r.text) for r in rows), size)]
    if len(answers) == 1:
        return answers[0].drop("shard", "row")
    every = reduce(DataFrame.unionAll, answers).groupBy("shard", "row", "doc_id", "n_words")
    joined = every.agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return joined.select("doc_id", "n_words", _merged_spans("spans").alias("spans"), "items")


def _merged_spans(spans: str):
    """Disjoint spans from sorted ones."""

    def run(column: pa.Array) -> pa.Array:
        out = []
        for row in column.to_pylist():
            done: list[dict] = []
            for s in row:
                if done and s["start"] <= done[-1]["end"]:
                    done[-1]["end"] = max(done[-1]["end"], s["end"])
                else:
                    done.append(dict(s))
            out.append(done)
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return F.arrow_udf(run, "array<struct<start:bigint,end:bigint>>")(F.col(spans))


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def near_matches(index: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """(query_id, doc_id, start): runs of ``within`` words that hold all words of a query (query_id, text)."""
    asked = [(str(r.query_id), np.unique(np.concatenate([h for _, h in windows_of([("", r.text)], 1)], axis=None))) for r in queries.toLocalIterator() if any(True for _ in windows_of([("", r.text)], 1))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, shard in _shards(batches):
            out = []
            for query, terms in asked:
                start = near_starts(shard, terms, within)
                doc = shard.doc_of(start)
                out += [(query, ids[d], int(s - shard.docs[d])) for d, s in zip(doc.tolist(), start.tolist())]
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["query_id", "doc_id", "start"])

    return index.mapInArrow(run, "query_id string, doc_id bigint, start bigint")


def op8_decontaminate(spark, sf_dir):
    index = build_index(table(spark, sf_dir, "documents"))
    found = find_items(index, table(spark, sf_dir, "benchmark"))
    hits = n_hit().alias("n_hit")
    digest = F.sha2(F.concat_ws(",", F.array_sort("items")), 256)
    return found.select("doc_id", "n_words", hits, F.size("items").cast("bigint").alias("n_items"), digest.alias("items_sha256"), (n_hit() > 0).alias("contaminated"))


