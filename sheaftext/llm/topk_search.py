"""Exact top-k inner products from an impact-ordered index, read score at a time.

Vectors become integers. The index cuts all vectors into shards. In a shard, a posting is a row that holds a value in a
dimension; the impact of a posting is the value's size, quantised to ``LEVELS`` levels of equally many postings. Postings with one level,
dimension and sign are a segment, and segments are stored by descending impact.

Queries meet a shard in groups. Level by level, each segment adds its impact, times the queries' values, to the sums of its
rows; the segments of a level are laid out in one sparse plane, so that a product adds them for all queries of the group. After a level, what a sum can still miss (levels not read, and the rounding of those read) is at most the length of the row's
rest, kept in the index for each level, times the length of the query. The k-th best exact score found so far, in earlier
shards or among the k largest sums, is a proven floor; rows whose upper bound is below it can't be members. Reading stops when few rows are left, at the last level
at the latest, and all rows left are scored exactly from their integers.

On a cluster: shards and the queries of each shard are written tables. Query groups (by number, ``QUERIES`` at most on average) and shard groups
form cells; each cell is one group of rows in one task, with its queries in memory and its shards as a stream. A cell
returns k rows per query, and a window over the cells of a query picks the k best.

Defined results: a vector that is null or holds a null, NaN or infinite component takes no part. Values beyond a long
count as its ends, and so do scores. Vectors of different lengths meet in the dimensions that both have; an empty vector scores 0. Rows
count one by one: of rows with equal ids each is a query and a candidate for the others. A null id is no query, and as a candidate comes after
all ids among equal scores (the id 2^63 - 1 is read as null). Other columns are ignored; an empty table has no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaftext.llm.common import materialise, packed, partitions, table

SHARD = 4096  # rows
SHARD_BYTES = 32 << 20  # as 64-bit values; fewer rows when vectors are long
LEVELS = 12
QUERIES = 16_384  # a query group
SHARDS = 256  # a shard group
AT_ONCE = 256  # queries that share the sums of a shard
READ = 0.6  # of the levels: read before the first look at what is left
FEW = 0.02  # of the rows of a shard: so many rows left are scored instead of reading on
NO_ID = 2**63 - 1

INDEX = "shard bigint, dims int, kind string, ids binary, vectors binary, postings binary, starts binary, impacts binary, rests binary"


def usable(column: str):
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(column).isNotNull() & ~F.exists(column, bad)


def _shards(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer vectors with zeros up to the longest) of at most ``SHARD`` rows."""
    ids, rows, longest = [], [], 0

    def cut():
        x = np.zeros((len(rows), longest))
        for line, row in zip(x, rows):
            line[: len(row)] = row
        with np.errstate(over="ignore"):
            x = np.floor(scale * x)
        top = float(2**63)
        return np.array(ids, np.int64), np.where(x >= top, 2**63 - 1, np.clip(x, -top, np.nextafter(top, 0)).astype(np.int64))

    for batch in batches:
        flat, at = batch.column("vector").flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(batch.column("vector").value_lengths().to_numpy(zero_copy_only=False))])
        for k, i in enumerate(batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False).tolist()):
            row = flat[at[k] : at[k + 1]]
            if rows and (len(rows) == SHARD or (len(rows) + 1) * max(longest, len(row)) * 8 > SHARD_BYTES):
                yield cut()
                ids, rows, longest = [], [], 0
            ids.append(i)
            rows.append(row)
            longest = max(longest, len(row))
    if rows:
        yield cut()


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def impact_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Postings (rows) by descending impact, dimension and sign; starts and signed impacts of segments (level, dimension, sign
    in that order); length of each row's rest after each level, rounded up."""
    n, dims = x.shape
    value = x.astype(float)
    size = np.abs(value)
    nonzero = np.sort(size[size > 0])
    cuts = np.unique(nonzero[np.arange(1, LEVELS) * len(nonzero) // LEVELS]) if len(nonzero) else np.zeros(0)
    level = len(cuts) - np.searchsorted(cuts, size, "right")  # 0 holds the largest
    levels = len(cuts) + 1
    impact = np.zeros(levels)
    read = size > 0
    np.divide(np.bincount(level[read], size[read], levels), np.bincount(level[read], minlength=levels), out=impact, where=np.bincount(level[read], minlength=levels) > 0)
    impact = np.rint(impact)
    key = ((level * dims + np.arange(dims)) * 2 + (x < 0))[read]
    row = np.broadcast_to(np.arange(n)[:, None], x.shape)[read]
    order = np.argsort(key, kind="stable")
    starts = np.searchsorted(key[order], np.arange(levels * dims * 2 + 1))
    rests, rest = np.zeros((levels, n), np.float32), value.copy()
    for k in range(levels):
        rest -= np.where(read & (level == k), np.sign(value) * impact[k], 0)
        rests[k] = np.nextafter((np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-6)).astype(np.float32), np.float32(np.inf))
    return row[order].astype(np.uint16), starts.astype(np.int64), impact, rests


def _index(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, (ids, x) in enumerate(_shards(batches, scale)):
            postings, starts, impact, rests = impact_order(x)
            x = narrow(x)
            row = [first + k, x.shape[1], x.dtype.str, *map(packed, (ids, x, postings, starts, impact, rests))]
            kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.binary()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], [c.split()[0] for c in INDEX.split(", ")])

    return run


def _vectors(row: dict) -> np.ndarray:
    ids = len(row["ids"]) // 8
    return np.frombuffer(row["vectors"], np.dtype(row["kind"])).reshape(ids, row["dims"])


def _queries_of(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                place = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                if len(place):
                    own = [row["shard"], row["dims"], row["kind"], packed(ids[place]), packed(_vectors(row)[place]), packed(place.astype(np.int64)), len(place)]
                    kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.binary()] * 3, pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(own, kinds)], ["shard", "dims", "kind", "ids", "vectors", "places", "many"])

    return run


class Best:
    """The k best candidates of some queries, found so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.full(queries, -np.inf)
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.zeros(len(self.floor), bool)
        touched[query] = True
        old = touched[self.query]
        q, s, i = (np.concatenate([a[old], b]) for a, b in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, ~s, q))  # ~ turns the order of longs around
        q, s, i = q[order], s[order], i[order]
        start = np.searchsorted(q, q)
        place = np.arange(len(q)) - start
        kept = place < self.k
        full = place == self.k - 1
        self.floor[q[full]] = s[full]
        self.query, self.score, self.id = (np.concatenate([a[~old], b[kept]]) for a, b in ((self.query, q), (self.score, s), (self.id, i)))


def exact(x: np.ndarray, y: np.ndarray, wide: bool) -> np.ndarray:
    """Inner products row by row; ``wide``: of numbers of any size, beyond a long its ends."""
    if not wide:
        return np.einsum("ij,ij->i", x.astype(float), y.astype(float)).astype(np.int64)
    total = (x.astype(object) * y.astype(object)).sum(axis=1) if x.shape[1] else np.zeros(len(x), object)
    return np.array([min(max(int(t), -(2**63)), 2**63 - 1) for t in total], np.int64)


def search(index: dict, shard_ids: np.ndarray, x: np.ndarray, queries: np.ndarray, own: np.ndarray, best: Best, numbers: np.ndarray) -> None:
    """One shard for a few queries (``numbers`` in ``best``); ``own`` is the row of the query itself, -1 if elsewhere."""
    dims = min(x.shape[1], queries.shape[1])
    q = queries[:, :dims].astype(np.int64)
    n, b = len(x), len(q)
    reach = [max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0 for a in (x, q)]
    most = reach[0] * reach[1] * max(dims, 1)
    wide = most >= 2**50
    mine = np.flatnonzero(own >= 0)
    left = np.ones((n, b), bool)
    if not wide:
        kind = np.float32 if most < 2**23 else np.float64  # sums of integers that either type holds exactly
        sums, toward = np.zeros((n, b), kind), np.zeros((x.shape[1], b), kind)
        toward[:dims] = q.T
        postings, starts, impact = (np.frombuffer(index[c], t) for c, t in (("postings", np.uint16), ("starts", np.int64), ("impacts", np.float64)))
        rests = np.frombuffer(index["rests"], np.float32).reshape(-1, n)
        length = np.sqrt((queries.astype(float) ** 2).sum(axis=1)) * (1 + 1e-5)
        floor, step = best.floor[numbers], 2 * x.shape[1]
        signed, column = np.tile([1, -1], x.shape[1]), np.repeat(np.arange(x.shape[1]), 2)
        plane, levels = np.zeros((n, x.shape[1]), kind), len(impact)
        for level in range(levels):
            sizes = np.diff(starts[level * step : level * step + step + 1])
            plane[postings[starts[level * step] : starts[level * step + step]], np.repeat(column, sizes)] = np.repeat(signed * impact[level], sizes)
            pause = level + 1 == levels or (level >= levels * READ and (level - int(levels * READ)) % 2 == 1)
            if not pause:
                continue
            sums += plane @ toward  # the segments read since the last pause, for all queries at once
            plane[:] = 0
            if n > best.k and not np.isfinite(best.floor[numbers]).all():
                sums[own[mine], mine] = -most
                hopeful = np.argpartition(sums.T, n - best.k - 1, axis=1)[:, n - best.k :]  # k rows that are not the query's own
                score = exact(x[hopeful.ravel(), :dims], np.repeat(q, best.k, axis=0), False).reshape(b, best.k)
                floor = np.maximum(floor, score.min(axis=1))
            left = sums >= floor.astype(kind) - (rests[level][:, None] * length.astype(kind) + 1)
            if left.sum() <= FEW * n * b:
                break
    left[own[mine], mine] = False
    row, which = np.nonzero(left)
    for a in range(0, len(row), 1 << 16):
        r, w = row[a : a + (1 << 16)], which[a : a + (1 << 16)]
        score = exact(x[r, :dims], q[w], wide)
        hopeful = score >= best.floor[numbers[w]]
        best.add(numbers[w[hopeful]], score[hopeful], shard_ids[r[hopeful]])


def _cells(k: int):
    """Rows arrive by cell, queries first; the shards of a cell pass one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks, best = None, [], None

        def results():
            if best is None or not len(best.query):
                return
            names = np.concatenate([block["ids"] for block in blocks])
            rows = np.concatenate([block["shard"] << 12 | block["places"] for block in blocks])
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (rows[best.query], names[best.query], best.id, best.score)], ["query", "query_id", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    yield from results()
                    cell, blocks, best = row["cell"], [], None
                if row["places"] is not None:
                    blocks.append({"shard": row["shard"], "ids": np.frombuffer(row["ids"], np.int64), "places": np.frombuffer(row["places"], np.int64), "vectors": _vectors(row)})
                elif blocks:
                    if best is None:
                        sizes = np.concatenate([[0], np.cumsum([len(block["ids"]) for block in blocks])])
                        best = Best(int(sizes[-1]), k)
                    ids, x = np.frombuffer(row["ids"], np.int64), _vectors(row)
                    for group in _together(blocks):
                        q, home, place, numbers = group
                        search(row, ids, x, q, np.where(home == row["shard"], place, -1), best, numbers)
        yield from results()

    return run


def _together(blocks: list[dict]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Queries of a cell, ``AT_ONCE`` at a time: vectors, home shards, places there, numbers."""
    held, first = [], 0
    for k, block in enumerate(blocks):
        for a in range(0, len(block["ids"]), AT_ONCE):
            part = block["vectors"][a : a + AT_ONCE]
            held.append((part, np.full(len(part), block["shard"]), block["places"][a : a + AT_ONCE], np.arange(first + a, first + a + len(part))))
            if sum(len(h[0]) for h in held) >= AT_ONCE or (k + 1 == len(blocks) and a + AT_ONCE >= len(block["ids"])):
                dims = max(h[0].shape[1] for h in held)
                joined = np.concatenate([np.pad(h[0].astype(np.int64), ((0, 0), (0, dims - h[0].shape[1]))) for h in held])
                yield joined, *(np.concatenate([h[c] for h in held]) for c in (1, 2, 3))
                held = []
        first += len(block["ids"])


def build_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """The written index of floor(``scale`` * component) of all usable vectors."""
    rows = vectors.where(usable(vector)).select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return materialise(rows.mapInArrow(_index(scale), INDEX), "impact-index")


def top_k(index: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each indexed row whose id is divisible by ``every``, the ``k`` best other rows."""
    spark = index.sparkSession
    found = index.select("shard", "dims", "kind", "ids", "vectors").mapInArrow(_queries_of(every), "shard bigint, dims int, kind string, ids binary, vectors binary, places binary, many int")
    queries = materialise(found, "queries")
    shards, many = index.count(), queries.agg(F.sum("many")).first()[0] or 0
    across, down = max(min(shards, partitions(spark)), -(-shards // SHARDS), 1), -(-many // QUERIES) or 1
    group = lambda n: F.pmod(F.xxhash64("shard"), F.lit(n))
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select("shard", "dims", "kind", "ids", "vectors", "places", group(down).alias("i"), every_one(across).alias("j"))
    held = index.select("*", every_one(down).alias("i"), group(across).alias("j"))
    both = asked.unionByName(held, allowMissingColumns=True).withColumn("cell", F.col("i") * across + F.col("j")).drop("i", "j")
    cells = both.repartition(min(across * down, max(partitions(spark), across)), "cell").sortWithinPartitions("cell", F.col("places").isNull(), "shard")
    near = cells.mapInArrow(_cells(k), "query bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


def op11_topk_search(spark, sf_dir):
    return top_k(build_index(table(spark, sf_dir, "embeddings")))


SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.r <> v.r
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, coalesce(score, 0) AS score FROM ranked WHERE rank <= 20
"""
