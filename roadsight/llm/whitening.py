"""Embedding whitening: principal directions by blockwise QR and a bidiagonal qd solver, not by a covariance.

Each task reduces its centred rows to one triangular factor by QR of stacked blocks; factors are
combined sixteen at a time until one is left.  Its singular values and right vectors
(``bidiagonal.eigen``) are the covariance's, without the digits that forming a covariance loses.
Only sums a dimension and triangles of width x width pass between tasks.

Entries are taken as whole numbers x = floor(64 c) + 1000000 (clipped to 62 bits), and a row is
centred exactly as (n x - S) / n.

* Null vectors and vectors that hold null or non-finite entries are dropped.
* All vectors of a fit have one length: the most frequent (of two equally frequent, the larger);
  rows of another length, and empty ones, are dropped too.
* Directions whose eigenvalue is zero in double precision have ``whitened`` null and ``explained`` 0,
  and stay out of ``identity_error``.  With no direction at all (one row, or equal rows)
  ``identity_error`` is 0.
* ``deviation`` is null where it exceeds 64 bits.  Rows without id, and repeated ids, stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from roadsight.llm.bidiagonal import eigen
from roadsight.llm.common import stage

COMPONENTS = 32
BLOCK = 2048
_FAN = 16
_SAFE = 1 << 62


@dataclass
class Fit:
    """What whitening needs of the fit list: all of it is width or width x width in size."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    rank: int

    @property
    def kept(self) -> int:
        return min(COMPONENTS, len(self.sums))


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & (F.size(vector) > 0), F.lit(False))


def points(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, vector) of the fit list; vectors are equally long."""
    vector = F.col("embedding").cast("array<double>")
    good = rows.where(usable(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    longest = good.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return good.where(F.size("vector") == (longest["width"] if longest else 0))


def whole_numbers(column) -> np.ndarray:
    """x of a list column: int64, within 62 bits."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    scaled = np.floor(64.0 * np.clip(values, -1e300, 1e300))
    return np.clip(scaled, -float(_SAFE >> 1), float(_SAFE >> 1)).astype(np.int64) + 1_000_000


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S without rounding: int64 where it fits, else Python integers."""
    most = max(n * int(np.abs(x).max(initial=0)), max((abs(s) for s in sums), default=0))
    if 2 * most < _SAFE:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(gap: np.ndarray) -> list[int | None]:
    """Sum of squares a row, without rounding; None beyond 64 bits."""
    if gap.dtype != object and int(np.abs(gap).max(initial=0)) ** 2 * max(gap.shape[1], 1) < _SAFE:
        return (gap * gap).sum(1).tolist()
    totals = ((g * g).sum() for g in gap.astype(object))
    return [t if t < 1 << 63 else None for t in totals]


def _centred(gap: np.ndarray, n: int) -> np.ndarray:
    return (gap / n).astype(np.float64)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    import pyarrow as pa

    def apply(batches: Iterator) -> Iterator:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = whole_numbers(batch.column(0))
                exact = int(np.abs(x).max()) * len(x) < _SAFE
                part = x.sum(0).astype(object) if exact else x.astype(object).sum(0)
                n, total = n + len(x), part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(total)), pa.int32()), pa.array([Decimal(v) for v in [n, *map(int, total)]], pa.decimal128(38, 0))],
                ["at", "total"])

    parts = rows.select("vector").mapInArrow(apply, "at int, total decimal(38,0)")
    found = sorted((r["at"], int(r["total"])) for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect())
    return (found[0][1], [t for _, t in found[1:]]) if found else (0, [])


def _fold(parts: DataFrame, combine: Callable[[list[np.ndarray]], np.ndarray], name: str) -> np.ndarray | None:
    """Combine arrays of rows (part int, data binary) sixteen at a time until one is left."""
    import pyarrow as pa

    def merge(table):
        table = table.sort_by("part")
        out = combine([np.frombuffer(v) for v in table["data"].to_pylist()])
        return pa.table({"part": pa.array([table["part"][0].as_py() // _FAN], pa.int32()), "data": pa.array([out.tobytes()], pa.binary())})

    parts = stage(parts, name)
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:
        parts = stage(parts.groupBy(F.floor(F.col("part") / _FAN)).applyInArrow(merge, parts.schema), name)
    last = parts.first()
    return None if last is None else np.frombuffer(bytes(last["data"]))


def _triangle(blocks: list[np.ndarray], width: int) -> np.ndarray:
    return np.linalg.qr(np.vstack([b.reshape(-1, width) for b in blocks]), mode="r").ravel()


def fit(rows: DataFrame) -> Fit:
    """Eigenvalues and directions of the covariance of ``points``."""
    import pyarrow as pa
    from pyspark import TaskContext

    n, sums = _sums(rows)
    width = len(sums)
    if not n:
        return Fit(0, [], np.empty(0), np.empty((0, 0)), 0.0, 0)

    def reduce(batches: Iterator) -> Iterator:
        factor, part = None, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = whole_numbers(batch.column(0).slice(at, BLOCK))
                block = _centred(deviations(x, n, sums), n)
                factor = _triangle([block] if factor is None else [factor, block], width)
        if factor is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([factor.tobytes()], pa.binary())], ["part", "data"])

    factor = _fold(rows.select("vector").mapInArrow(reduce, "part int, data binary"), lambda b: _triangle(b, width), "triangles")
    square = np.zeros((width, width))
    factor = factor.reshape(-1, width)
    square[:len(factor)] = factor
    values, vectors = eigen(square)
    zero = (8 * width * np.finfo(np.float64).eps) ** 2 * values[0]
    return Fit(n, sums, values / n, vectors, float((square ** 2).sum()) / n, int((values > zero).sum()))


def project(x: np.ndarray, model: Fit) -> tuple[np.ndarray, np.ndarray]:
    """n x - S, and the whitened coordinates (columns: components up to 32 that are not zero)."""
    gap = deviations(x, model.n, model.sums)
    k = min(model.kept, model.rank)
    return gap, _centred(gap, model.n) @ (model.vectors[:, :k] / np.sqrt(model.values[:k]))


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    import pyarrow as pa
    from pyspark import TaskContext

    k = min(model.kept, model.rank)
    if not k:
        return 0.0

    def apply(batches: Iterator) -> Iterator:
        total = np.zeros((k + 1, k))  # products, then sums
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                _, z = project(whole_numbers(batch.column(0).slice(at, BLOCK)), model)
                total[:k] += z.T @ z
                total[k] += z.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["part", "data"])

    total = _fold(rows.select("vector").mapInArrow(apply, "part int, data binary"), lambda b: np.sum(b, axis=0), "products").reshape(k + 1, k)
    mean = total[k] / model.n
    return float(np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    import pyarrow as pa

    rows = points(embeddings)
    model = fit(rows)
    error = identity_error(rows, model)
    k = min(model.kept, model.rank)
    explained = np.zeros(model.kept)
    explained[:k] = model.values[:k] / model.trace if k else 0.0

    def apply(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                gap, z = project(whole_numbers(part.column(1)), model)
                m, c = len(gap), model.kept
                flat, empty = np.zeros((m, c)), np.ones((m, c), bool)
                flat[:, :k], empty[:, :k] = z, False
                of_row = pa.array(np.repeat(np.arange(m), c))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(of_row), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * c, model.n)), pa.array(_squares(gap), pa.int64()).take(of_row),
                     pa.array(flat.ravel(), mask=empty.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * c, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(apply, "vec_id long, component int, n long, deviation long, whitened double, "
                                  "explained double, identity_error double")
