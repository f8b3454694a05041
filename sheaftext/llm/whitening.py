"""Embedding whitening from the covariance of distinct vectors, weighted by multiplicity or by one.

1. Components become integers x = floor(``scale`` * c) + ``shift``; rows with equal x are grouped, and the distinct vectors are written once with
   their counts. Grouping sums counts before it shuffles, so that a vector held by a third of all rows is one row a task.
2. Sums per dimension are exact (halves of 32 bits, added as longs). Vectors are centred with them before they are multiplied: each chunk
   of distinct vectors gives one weighted product, tasks add their chunks, and a second stage adds the tasks. Only dims x dims numbers go to the driver.
3. The eigenvectors of the covariance are the components. Each distinct vector is whitened once; a second pass of products over the
   whitened vectors measures how far their covariance is from the identity.
4. Results go back to the rows by a join on x. Vectors of at least one row in ``HOT`` are so few (``HOT`` at most) that they are broadcast;
   every other vector meets its rows in a shuffle, where no key holds more than that share.

Defined results: a vector that is null or holds null, NaN or infinite entries takes no part. x stops at 2^60 on either side. Vectors shorter than
the longest are filled up with zeros (x = ``shift``). Components whose eigenvalue is 0 up to rounding can't be whitened and give no rows, so a
single distinct vector, an empty table or empty vectors give none. ``deviation`` is null beyond a long. Rows with null or repeated ids
stay rows of their own; other columns are ignored. Components with equal eigenvalues are any orthogonal choice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import materialise, packed, table
from sheaftext.llm.topk_search import usable

SHIFT = 1_000_000
COMPONENTS = 16
CHUNK = 1 << 20  # numbers of a chunk of vectors
HOT = 1000
GROUPS = 32  # of tasks, whose matrices are added together
_LOW = (1 << 32) - 1


def _rows(batch: pa.RecordBatch, dims: int, shift: int) -> Iterator[tuple[int, np.ndarray]]:
    """Chunks of the vectors of a batch: first row and integers, filled up to ``dims``."""
    at = np.concatenate([[0], np.cumsum(batch.column("x").value_lengths().to_numpy(zero_copy_only=False))])
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    step = max(1, CHUNK // max(dims, 1))
    for a in range(0, batch.num_rows, step):
        b = min(a + step, batch.num_rows)
        x = np.full((b - a, dims), shift, np.int64)
        sizes = np.diff(at[a : b + 1])
        x[np.repeat(np.arange(b - a), sizes), np.arange(at[b] - at[a]) - np.repeat(at[a:b] - at[a], sizes)] = flat[at[a] : at[b]]
        yield a, x


class Fit:
    """Exact sums of the fit list; what centring and whitening need from it."""

    def __init__(self, n: int, sums: list[int], shift: int):
        self.n, self.sums, self.shift, self.dims = n, sums, shift, len(sums)
        self.whole = np.array([s // n for s in sums], np.int64)
        self.part = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, where the subtraction of the whole part is exact."""
        return (x - self.whole).astype(float) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n*x - S)^2, exact; None beyond a long."""
        off, rest = x - self.whole, np.array([s % self.n for s in self.sums], np.int64)
        reach = (int(np.abs(off).max()) + 1) * self.n if off.size else 0
        if reach * reach * max(self.dims, 1) < 2**63:
            d = self.n * off - rest
            return (d * d).sum(axis=1).tolist()
        d = (self.n * off.astype(object) - rest.astype(object)) ** 2
        return [v if v < 2**63 else None for v in map(int, d.sum(axis=1))]


def _task_products(project):
    """One row a task: the sum of weight * y and of weight * y yT over its vectors, where y = project(x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = product = None
        for batch in batches:
            weights = batch.column("weight").to_numpy(zero_copy_only=False).astype(float)
            for a, y in project(batch):
                w = weights[a : a + len(y)]
                parts = w @ y, (w[:, None] * y).T @ y
                first, product = parts if first is None else (first + parts[0], product + parts[1])
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([packed(first)], pa.binary()), pa.array([packed(product)], pa.binary())], ["first", "product"])

    return run


def _added(rows: pa.Table) -> pa.Table:
    total = lambda c: packed(sum(np.frombuffer(v.as_buffer()) for v in rows.column(c)))
    return pa.table({"first": [total("first")], "product": [total("product")]})


def _moments(vectors: DataFrame, project, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums of y and of y yT over all vectors; at most ``GROUPS`` matrices come to the driver."""
    schema = "first binary, product binary"
    tasks = vectors.select("x", "weight").mapInArrow(_task_products(project), schema)
    groups = tasks.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(GROUPS))).groupBy("part").applyInArrow(lambda rows: _added(rows.drop_columns("part")), schema)
    found = groups.collect()
    add = lambda c: sum((np.frombuffer(r[c]) for r in found), np.zeros(1))
    return add("first") * np.ones(dims), (add("product") * np.ones(dims * dims)).reshape(dims, dims)


def distinct_vectors(vectors: DataFrame, vector: str, scale: int, shift: int, by_count: bool) -> DataFrame:
    """(x, rows, weight), written: each distinct x with its number of rows and its weight in the fit."""
    each = vectors.where(usable(vector)).select(_integers(vector, scale, shift)).groupBy("x").agg(F.count(F.lit(1)).alias("rows"))
    return materialise(each.withColumn("weight", F.col("rows") if by_count else F.lit(1).cast("bigint")), "distinct-vectors")


def _integers(vector: str, scale: int, shift: int):
    end = float(2**60)
    whole = lambda c: F.floor(F.greatest(F.least(F.lit(float(scale)) * c.cast("double"), F.lit(end)), F.lit(-end))) + F.lit(shift)
    return F.transform(vector, whole).alias("x")


def fit_sums(distinct: DataFrame, shift: int) -> Fit | None:
    """Exact sums per dimension over the fit list."""
    size = distinct.agg(F.sum("weight").alias("n"), F.max(F.size("x")).alias("dims"), F.sum(F.col("rows")).alias("rows")).first()
    if not size.n or not size.dims:
        return None
    # shorter vectors add nothing here; what they lack is ``shift`` and is added below
    each = distinct.select("weight", F.posexplode("x").alias("d", "v"))
    exact = lambda c: F.sum((c * F.col("weight")).cast("decimal(38,0)"))
    found = each.groupBy("d").agg(F.sum("weight").alias("held"), exact(F.shiftright("v", 32)).alias("high"), exact(F.col("v").bitwiseAND(F.lit(_LOW))).alias("low")).collect()
    sums = [shift * size.n] * size.dims
    for r in found:
        sums[r.d] = (int(r.high) << 32) + int(r.low) + shift * (size.n - r.held)
    return Fit(size.n, sums, shift)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, by_count: bool = False, scale: int = 64, shift: int = SHIFT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    ``by_count`` fits on all rows (a vector weighs as often as it occurs), otherwise on each distinct vector once.
    """
    spark = vectors.sparkSession
    distinct = distinct_vectors(vectors, vector, scale, shift, by_count)
    fit = fit_sums(distinct, shift)
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if fit is None:
        return spark.createDataFrame([], schema)
    centred = lambda batch: ((a, fit.centred(x)) for a, x in _rows(batch, fit.dims, shift))
    _, product = _moments(distinct, centred, fit.dims)
    covariance = product / fit.n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    values, directions = values[::-1], directions[:, ::-1]
    trace = float(np.trace(covariance))
    count = int((values[:components] > max(values[0], 0) * fit.dims * 1e-13).sum())
    if not count:
        return spark.createDataFrame([], schema)
    turn = directions[:, :count] / np.sqrt(values[:count])
    project = lambda batch: ((a, fit.centred(x) @ turn) for a, x in _rows(batch, fit.dims, shift))
    first, product = _moments(distinct, project, count)
    mean = first / fit.n
    error = float(np.abs(product / fit.n - np.outer(mean, mean) - np.eye(count)).max())

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, x in _rows(batch, fit.dims, shift):
                z = fit.centred(x) @ turn
                own = batch.slice(a, len(x))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * count, pa.int32()), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([own.column("x"), own.column("rows"), pa.array(fit.deviations(x), pa.int64()), lists], ["x", "rows", "deviation", "z"])

    done = materialise(distinct.select("x", "rows").mapInArrow(whitened, "x array<bigint>, rows bigint, deviation bigint, z array<double>"), "whitened")
    total = done.agg(F.sum("rows")).first()[0]
    hot = F.col("rows") * HOT >= total  # at most HOT vectors
    rows = vectors.where(usable(vector)).select(F.col(vec_id).cast("bigint").alias("vec_id"), _integers(vector, scale, shift))
    few = F.broadcast(done.where(hot).select("x", F.lit(True).alias("hot"), "deviation", "z"))
    met = rows.join(few, "x", "left")
    rest = met.where("hot is null").select("vec_id", F.xxhash64("x").alias("h"), "x").join(done.where(~hot).select(F.xxhash64("x").alias("h"), "x", "deviation", "z").hint("merge"), ["h", "x"])
    joined = met.where("hot").select("vec_id", "deviation", "z").unionByName(rest.select("vec_id", "deviation", "z"))
    explained = F.array(*[F.lit(float(v / trace)) for v in values[:count]])
    each = joined.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("bigint").alias("n"), "deviation", "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")
    )


def op12_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
