"""Whitening of embeddings onto their leading components.

Entries become whole numbers, and every distinct vector counts once. Sums are exact. Every partition of the distinct
vectors reduces its centred rows block by block to one triangle by QR, triangles are stacked and reduced again in a tree of
fixed width, and the last one has the covariance's square root. `bidiagonal` finds its singular values and the leading right
singular vectors, which are the components. Only that triangle, the sums and the components, whose sizes depend on the
dimension alone, pass through the driver. Rows are projected where they are read; the covariance of the projected vectors is
measured over all distinct vectors, again in a tree.

The distinct vectors are written to the shared folder, so lost tasks read the same rows in the same order again.

Cases: rows whose vector is null or holds a null or non-finite entry go; repeated rows are kept; shorter vectors are filled up
with zeros to the length of the longest; entries beyond the range of a long take its ends. Directions without variance (up to
rounding) have no component, so there is no row for them, and none at all where all vectors are equal or the table is
empty. Equal eigenvalues have any orthonormal components of their space. A deviation beyond the range of a long is null. Ids
may be null; only the id and vector columns are read, so other columns may have any name.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.bidiagonal import leading
from leaksafe.llm.shared import written

SCALE = 256
COMPONENTS = 4
WIDTH = 8  # triangles or moments that one task joins
BLOCK_ROWS = 4096
RESOLUTION = 1e-13  # of a singular value against the largest
LARGEST = (1 << 63) - 1
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
_ARROW = pa.schema(
    [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
    + [(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]
)
_PART = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
PART = "part long, n long, data binary"


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, x) of the remaining rows, all of one length, and that length."""
    vector = F.col(f"`{vector_col}`")
    kept = rows.where(usable(vector)).select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), whole_numbers(vector).alias("x"))
    size = F.size("x")
    shortest, longest = kept.agg(F.min(size), F.max(size)).first()
    if shortest != longest:
        filled = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(longest) - size))
        kept = kept.withColumn("x", F.when(size < longest, filled).otherwise(F.col("x")))
    return kept, longest or 0


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of rows and their vectors, the last column, as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, np.asarray(part.column(part.num_columns - 1).flatten()).reshape(-1, size)


def exact_sums(x: np.ndarray) -> list[int]:
    if max(abs(int(x.min())), abs(int(x.max()))) * len(x) <= LARGEST:
        return x.sum(axis=0).tolist()
    return x.astype(object).sum(axis=0).tolist()


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the exact sum of (n * x - S) ^ 2; none beyond the range of a long."""
    bound = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if x.shape[1] * bound * bound <= LARGEST:
        y = x * n - np.array(sums)
        return (y * y).sum(axis=1).tolist()
    y = x.astype(object) * n - np.array(sums, object)
    return [v if v <= LARGEST else None for v in (y * y).sum(axis=1).tolist()]


def _part(n: int, data: np.ndarray) -> pa.RecordBatch:
    values = [[TaskContext.get().partitionId()], [n], [np.ascontiguousarray(data, "<f8").tobytes()]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _PART, strict=True)], schema=_PART)


def joined(parts: DataFrame, count: int, join: Callable[[list[tuple[int, bytes]]], tuple[int, bytes]]) -> tuple[int, bytes] | None:
    """The parts of all partitions joined `WIDTH` at a time, in the order of their partitions."""

    def join_group(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        n, data = join(list(zip(table.column("n").to_pylist(), table.column("data").to_pylist(), strict=True)))
        return pa.table([[key[0].as_py()], [n], [data]], schema=_PART)

    while count > 1:
        parts = parts.groupBy(F.expr(f"part div {WIDTH}").alias("group")).applyInArrow(join_group, PART)
        count = -(-count // WIDTH)
    row = parts.first()
    return None if row is None else (row["n"], bytes(row["data"]))


def count_and_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for _, x in blocks(batches, size):
            n, sums = n + len(x), [a + b for a, b in zip(sums, exact_sums(x), strict=True)]
        values = [decimal.Decimal(v) for v in [n, *sums]]
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["at", "v"])

    totals = fit.mapInArrow(partial, "at int, v decimal(38,0)").groupBy("at").agg(F.sum("v").cast("decimal(38,0)").alias("v"))
    n, *sums = [int(r.v) for r in sorted(totals.collect())]  # one row per dimension
    return n, sums


def triangle(fit: DataFrame, size: int, mean: np.ndarray) -> np.ndarray:
    """R of the centred vectors."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n = np.zeros((0, size)), 0
        for _, x in blocks(batches, size):
            r, n = np.linalg.qr(np.vstack([r, x - mean]), mode="r"), n + len(x)
        if n:
            yield _part(n, r)

    def join(parts: list[tuple[int, bytes]]) -> tuple[int, bytes]:
        stacked = np.vstack([np.frombuffer(data, "<f8").reshape(-1, size) for _, data in parts])
        return sum(n for n, _ in parts), np.linalg.qr(stacked, mode="r").astype("<f8").tobytes()

    _, data = joined(fit.mapInArrow(reduce, PART), fit.rdd.getNumPartitions(), join)
    r = np.frombuffer(data, "<f8").reshape(-1, size)
    return np.vstack([r, np.zeros((size - len(r), size))])


def identity_error(fit: DataFrame, size: int, mean: np.ndarray, axes: np.ndarray) -> float:
    """The largest entry of the covariance of the whitened vectors less the identity."""
    k = len(axes)

    def merge(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
        """Counts, and means above centred products."""
        n, apart = a[0] + b[0], b[1][0] - a[1][0]
        products = a[1][1:] + b[1][1:] + np.outer(apart, apart) * (a[0] * b[0] / n)
        return n, np.vstack([a[1][:1] + apart * (b[0] / n), products])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for _, x in blocks(batches, size):
            y = (x - mean) @ axes.T
            own = y.mean(axis=0)
            block = len(x), np.vstack([own[None], (y - own).T @ (y - own)])
            whole = block if whole is None else merge(whole, block)
        if whole is not None:
            yield _part(*whole)

    def join(parts: list[tuple[int, bytes]]) -> tuple[int, bytes]:
        whole = None
        for n, data in parts:
            part = n, np.frombuffer(data, "<f8").reshape(k + 1, k)
            whole = part if whole is None else merge(whole, part)
        return whole[0], whole[1].astype("<f8").tobytes()

    n, data = joined(fit.mapInArrow(measure, PART), fit.rdd.getNumPartitions(), join)
    return float(np.abs(np.frombuffer(data, "<f8").reshape(k + 1, k)[1:] / n - np.eye(k)).max())


class Whitening:
    """Fitted on distinct vectors: their number, sums, and the leading components with their eigenvalues."""

    def __init__(self, fit: DataFrame, size: int, most: int = COMPONENTS):
        self.size = size
        self.n, self.sums = count_and_sums(fit, size)
        self.mean = np.array([float(Fraction(s, self.n)) for s in self.sums])
        squares, components = leading(triangle(fit, size, self.mean), most)
        found = int((squares[: len(components)] > RESOLUTION**2 * squares[0] * size).sum()) if squares[0] else 0
        self.components = np.array([v if v[np.argmax(np.abs(v))] > 0 else -v for v in components[:found]]).reshape(found, size)
        self.eigenvalues = squares[:found] / self.n
        self.explained = squares[:found] / squares.sum() if found else squares[:0]
        self.axes = self.components / np.sqrt(self.eigenvalues)[:, None]
        self.error = identity_error(fit, size, self.mean, self.axes) if found else 0.0

    def apply(self, rows: DataFrame) -> DataFrame:
        """A row for each row of (vec_id, x) and component."""
        n, sums, size, mean, axes, explained, error = self.n, self.sums, self.size, self.mean, self.axes, self.explained, self.error
        k = len(axes)

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, x in blocks(batches, size):
                rows = len(x)
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
                far = pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
                columns = [
                    ids, np.tile(np.arange(1, k + 1), rows), np.full(rows * k, n), far,
                    ((x - mean) @ axes.T).ravel(), np.tile(explained, rows), np.full(rows * k, error),
                ]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
                )

        return rows.mapInArrow(project, SCHEMA)


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Each remaining row's coordinates on the leading components, scaled to unit variance."""
    vectors, size = integer_vectors(rows, id_col, vector_col)
    if not size:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    fitted = Whitening(written(vectors.select("x").distinct()), size, most)
    return fitted.apply(vectors) if len(fitted.axes) else rows.sparkSession.createDataFrame([], SCHEMA)
