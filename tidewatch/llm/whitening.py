"""Whitening of embeddings by a covariance in two passes.

1. Entries become whole numbers, ``floor(256 * c)``, and equal vectors one, map-side before the shuffle: the fit list.
   Its exact integer sums give the mean.
2. Partitions sum outer products of centred vectors by matrix products in numpy, and ``treeAggregate`` merges them: what
   meets in one place is a few matrices of the dimension's square, whatever the number of rows.
3. A symmetric eigenproblem (LAPACK) gives the components; the projection, a few vectors, is broadcast, and every row is
   projected where it is.  A last pass over the fit list measures the covariance of what came out, centred as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize

SCALE = 256
#: A matrix of this dimension has 128 MB; more is refused before anything of that size is made.
MOST_DIMENSIONS = 4096
#: Vectors of one matrix product.
BLOCK_ROWS = 4096
#: Partial results of ``treeAggregate`` that the driver merges, about.
FAN_IN = 8
_MOST = (1 << 63) - 1
_WIDTHS = (np.int16, np.int64)


@dataclass(frozen=True)
class Whitening:
    """A fit: size and integer sums of the fit list, eigenvectors as columns with their eigenvalues, falling, and the trace."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n as doubles; whole parts are subtracted as integers."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])
        return (x - np.array(whole, np.int64)).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """A column a component; components without variance give nan."""
        some = self.values > len(self.sums) * np.finfo(float).eps * max(float(self.values.max(initial=0)), 0)
        scale = np.where(some, 1 / np.sqrt(np.where(some, self.values, 1)), np.nan)
        return self.centred(x) @ self.vectors * scale

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - sums)**2, exact."""
        top = max((self.n * int(abs(b)) + abs(s) for b, s in zip(np.abs(x.astype(np.float64)).max(0, initial=0).tolist(), self.sums)), default=0)
        if top * top * max(len(self.sums), 1) < _MOST:
            off = self.n * x - np.array(self.sums, np.int64)
            return pa.array((off * off).sum(1)).cast(pa.decimal128(38, 0))
        return pa.array([Decimal(sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums))) for row in x.tolist()], pa.decimal128(38, 0))


def _usable(vector):
    return vector.isNotNull() & F.forall(F.coalesce(vector, F.array()), lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))


def _whole(vectors: pa.ListArray) -> np.ndarray:
    """A row a vector; entries beyond a long become the nearest one."""
    size = vectors.value_lengths().to_numpy()
    if (size != size[0]).any():
        raise ValueError("vectors must have one length")
    y = np.floor(SCALE * vectors.flatten().to_numpy().astype(np.float64))
    x = np.where(np.abs(y) < 2.0**62, y, 0).astype(np.int64)
    big = np.flatnonzero(np.abs(y) >= 2.0**62)
    x[big] = [max(-_MOST - 1, min(_MOST, int(v))) for v in y[big].tolist()]
    return x.reshape(size.size, int(size[0]))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A vector's bytes: the bytes an entry takes (2 or 8, the least that hold all), then the entries."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _whole(batch.column(0))
        short = (np.abs(x) < 1 << 15).all(1) if x.size else np.ones(len(x), bool)
        out = [None] * len(x)
        for kind, at in zip(_WIDTHS, (np.flatnonzero(short), np.flatnonzero(~short))):
            lead = bytes([np.dtype(kind).itemsize])
            for i, row in zip(at.tolist(), x[at].astype(kind)):
                out[i] = lead + row.tobytes()
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["x"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Vectors of a packed column, some rows at a time, all of one dimension."""
    dimension = None
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.column(0).slice(low, BLOCK_ROWS).to_pylist()
            for kind in _WIDTHS:
                width = np.dtype(kind).itemsize
                mine = [r for r in rows if r[0] == width]
                if mine:
                    size = {(len(r) - 1) // width for r in mine} | ({dimension} if dimension is not None else set())
                    if len(size) > 1:
                        raise ValueError("vectors must have one length")
                    dimension = size.pop()
                    yield np.frombuffer(b"".join(r[1:] for r in mine), kind).astype(np.int64).reshape(len(mine), dimension)


def _merged(partials: DataFrame, read, merge):
    """One value of all rows of ``partials``: each is read, and two are merged; None if there are none."""
    rdd = partials.rdd
    both = lambda a, b: b if a is None else a if b is None else merge(a, b)
    depth = max(2, math.ceil(math.log(max(rdd.getNumPartitions(), 2), FAN_IN)))
    return rdd.treeAggregate(None, lambda a, row: both(a, read(row)), both, depth)


def _sums(fit: DataFrame) -> tuple[int, list[int]] | None:
    def partial(batches):
        n, sums = 0, None
        for x in _blocks(batches):
            few = x.shape[0] * int(np.abs(x.astype(np.float64)).max(initial=0)) < 1 << 62
            mine = [int(s) for s in x.sum(0)] if few else [sum(c) for c in zip(*x.tolist())]
            n, sums = n + len(x), mine if sums is None else [a + b for a, b in zip(sums, mine)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(s) for s in sums]], pa.list_(pa.string()))], ["n", "sums"])

    def merge(a, b):
        if len(a[1]) != len(b[1]):
            raise ValueError("vectors must have one length")
        return a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]

    return _merged(fit.mapInArrow(partial, "n long, sums array<string>"), lambda r: (r.n, [int(s) for s in r.sums]), merge)


def _matrix(rows: DataFrame, of, columns: int) -> np.ndarray:
    """Sum of the matrices ``of`` gives for the vectors of each block."""

    def partial(batches):
        total = None
        for x in _blocks(batches):
            mine = of(x)
            total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    return _merged(rows.mapInArrow(partial, "m binary"), lambda r: np.frombuffer(r.m).reshape(-1, columns), lambda a, b: a + b)


def fit_list(df: DataFrame, vector_col: str) -> DataFrame:
    """x: each distinct vector of whole numbers once, packed; a written table."""
    vector = F.col(f"`{vector_col}`")
    rows = df.where(_usable(vector)).select(vector.cast("array<double>").alias("v"))
    return materialize(rows.mapInArrow(_packed, "x binary").distinct(), "whitening-fit")


def fit_whitening(fit: DataFrame, components: int | None = None) -> Whitening | None:
    """Of a fit list; None if it has no vector or vectors without entries.  Signs: the largest entry is positive."""
    got = _sums(fit)
    if got is None or not got[1]:
        return None
    n, sums = got
    d = len(sums)
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors must have {MOST_DIMENSIONS} entries or fewer")
    mean = Whitening(n, tuple(sums), np.zeros((d, 0)), np.zeros(0), 0.0)

    def outer(x):
        c = mean.centred(x)
        return c.T @ c

    v = _matrix(fit, outer, d) / n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1, 1)
    return Whitening(n, tuple(sums), np.ascontiguousarray(vectors), np.ascontiguousarray(values), float(np.trace(v)))


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity; components without variance left out."""
    some = np.flatnonzero(~np.isnan(model.whitened(np.zeros((1, len(model.sums)), np.int64))[0]))
    if not some.size:
        return None
    mean = _matrix(fit, lambda x: model.whitened(x)[:, some].sum(0, keepdims=True), some.size)[0] / model.n

    def outer(x):
        z = model.whitened(x)[:, some] - mean
        return z.T @ z

    return float(np.abs(_matrix(fit, outer, some.size) / model.n - np.eye(some.size)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of each usable row and component.

    A row whose vector is null or has a null or non-finite entry is dropped.  Rows that repeat count once in the fit and
    have rows of their own here; null ids stay null.  A component without variance (of equal vectors, say) has a null
    ``whitened``; if none has any, ``explained`` and ``identity_error`` are null.  Vectors of fewer entries than
    ``components`` have as many components as entries, so vectors without entries have no rows, nor has an empty table.
    Vectors of different lengths are an error.  ``deviation`` is a decimal of 38 digits; other columns are ignored.
    """
    fit = fit_list(df, vector_col)
    model = fit_whitening(fit, components)
    shape = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return df.sparkSession.createDataFrame([], shape)
    error = identity_error(fit, model)
    shared = df.sparkSession.sparkContext.broadcast(model)
    k = model.values.size
    explained = [float(e / model.trace) if model.trace > 0 else None for e in model.values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _whole(batch.column("v")), batch.num_rows
            z, every = mine.whitened(x).ravel(), pa.array(np.repeat(np.arange(m), k))
            cols = [batch.column("vec_id").take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, mine.n)), mine.deviations(x).take(every)]
            cols += [pa.array(z, mask=np.isnan(z)), pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    vector = F.col(f"`{vector_col}`")
    rows = df.where(_usable(vector)).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.cast("array<double>").alias("v"))
    return rows.mapInArrow(project, shape)
