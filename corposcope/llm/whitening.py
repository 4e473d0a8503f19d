"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

Entries become integers, so counts, sums and the covariance are exact whatever the order of the rows. The covariance is
summed up in tasks; the driver sees a number per pair of dimensions. Its float32 eigenvectors are corrected by
the iteration of Ogita and Aishima, matrix products in more than double precision; where eigenvalues are too close
to be told apart, the small problem of their subspace is solved first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Beyond these the sums of a block of rows go over to integers of any size.
EXACT = float(1 << 53)
LARGEST = float(1 << 62)
BLOCK_ROWS = 4096
# Slices of a number in a product of matrices: together they hold more bits than an extended double.
SLICES = 4
# A step squares the error, so a few are enough; more only turn clusters that rounding made.
STEPS = 24


class Whitening(NamedTuple):
    """``n`` rows with ``sums`` per dimension; ``components`` are columns, by falling ``values``."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


# --- rows and their sums ------------------------------------------------------------


def clean_vectors(df: DataFrame) -> DataFrame:
    """``(vec_id, v)``: rows whose vector has only finite entries."""
    v = F.col("embedding").cast("array<double>")
    wrong = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~wrong)


def _scaled(batch: pa.RecordBatch, dim: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one dimension each and their integers; of ``dim`` only, if given."""
    lists = batch.column("v")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes) if dim is None else [dim]:
        rows = batch.take(pa.array(np.flatnonzero(sizes == size)))
        flat = rows.column("v").flatten().to_numpy(zero_copy_only=False)
        x = np.clip(np.floor(SCALE * flat), -LARGEST, LARGEST).astype(np.int64) + SHIFT
        yield rows, x.reshape(len(rows), int(size))


def _added(parts: DataFrame, kind: str) -> DataFrame:
    """``(key, values)``: arrays of one ``key`` summed up by place; the tasks that made them come in order."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for key, values in zip(batch.column("key").to_pylist(), batch.column("values").to_pylist()):
                values = np.array([int(v) for v in values], object) if kind == "string" else np.array(values)
                total[key] = total[key] + values if key in total else values
        out = [[str(v) for v in values] if kind == "string" else values.tolist() for values in total.values()]
        yield pa.record_batch([pa.array(total, pa.int64()), pa.array(out, pa.list_(pa.string() if kind == "string" else pa.float64()))], ["key", "values"])

    ordered = parts.repartition("key").sortWithinPartitions("key", "part")
    return ordered.select("key", "values").mapInArrow(add, f"key long, values array<{kind}>")


def _parts(rows: list[tuple[int, list]], kind) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    columns = [pa.array([k for k, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.list_(kind)), pa.array([part] * len(rows), pa.int64())]
    return pa.record_batch(columns, ["key", "values", "part"])


_PARTS = "key long, values array<{}>, part long"


def row_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each dimension that occurs the number of rows and the sums of their integers, exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, x in _scaled(batch):
                wide = x.size and float(np.abs(x.astype(float)).max()) * len(x) >= LARGEST
                sums = np.array([len(x), *(x.astype(object) if wide else x).sum(axis=0)], object)
                total[x.shape[1]] = total[x.shape[1]] + sums if x.shape[1] in total else sums
        if total:
            yield _parts([(d, [str(v) for v in s]) for d, s in total.items()], pa.string())

    found = _added(vectors.mapInArrow(count, _PARTS.format("string")), "string").collect()
    return {r["key"]: (int(r["values"][0]), [int(v) for v in r["values"][1:]]) for r in found}


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the integers, divisor ``n``, as fractions ``n * n`` times as large, exactly.

    Rows are centred on the integers nearest to the means before they are multiplied, so the products are small and
    exact; what the fractions left over, below one half, add to the sums is taken off them exactly.
    """
    dim = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        held, room = np.zeros((dim, dim)), EXACT

        def flush():
            nonlocal total, held, room
            total, held, room = total + held.astype(np.int64).astype(object), np.zeros((dim, dim)), EXACT

        for batch in batches:
            for _, x in _scaled(batch, dim):
                for start in range(0, len(x), BLOCK_ROWS):
                    y = x[start : start + BLOCK_ROWS]
                    far = max((abs(int(v) - c) for bound in (y.min(axis=0), y.max(axis=0)) for v, c in zip(bound, centre)), default=0)
                    need = float(far) ** 2 * len(y)
                    if need >= EXACT:
                        y = y.astype(object) - np.array(centre, object)
                        total = total + y.T @ y
                        continue
                    if need >= room:
                        flush()
                    y = (y - np.array(centre, np.int64)).astype(float)
                    held += y.T @ y
                    room -= need
        flush()
        yield _parts([(i, [str(v) for v in row]) for i, row in enumerate(total)], pa.string())

    rows = _added(vectors.mapInArrow(multiply, _PARTS.format("string")), "string").collect()
    products = np.zeros((dim, dim), object)
    for r in rows:
        products[r["key"]] = [int(v) for v in r["values"]]
    rest = np.array([s - n * c for s, c in zip(sums, centre)], object)
    return n * products - np.outer(rest, rest)


# --- eigenvectors --------------------------------------------------------------------


def _extended(exact: np.ndarray, by: int) -> np.ndarray:
    """Integers of any size over ``by`` as extended doubles."""
    high = np.array([[float(v) for v in row] for row in exact])
    low = np.array([[float(v - int(h)) for v, h in zip(row, highs)] for row, highs in zip(exact, high)])
    return (high.astype(np.longdouble) + low.astype(np.longdouble)) / np.longdouble(by)


def _cut(a: np.ndarray, axis: int, bits: int) -> list[np.ndarray]:
    """A matrix as a sum of doubles of few bits each, relative to the largest entry along ``axis``."""
    out, rest = [], a.astype(np.longdouble)
    for _ in range(SLICES):
        top = np.abs(rest).max(axis=axis, keepdims=True)
        unit = np.exp2(np.ceil(np.log2(np.where(top > 0, top, 1))) - bits)
        part = np.rint(rest / unit) * unit
        out.append(part.astype(float))
        rest = rest - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` in more than double precision from products of doubles, each of which is exact."""
    bits = (52 - math.ceil(math.log2(max(a.shape[1], 2)))) // 2
    left, right = _cut(a, 1, bits), _cut(b, 0, bits)
    total = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    for i in reversed(range(SLICES)):
        for j in reversed(range(SLICES - i)):
            total += left[i] @ right[j]
    return total


def _clusters(values: np.ndarray, width: np.longdouble) -> Iterator[np.ndarray]:
    """Runs of neighbours in order of value whose gaps are at most ``width``."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > width) + 1
    yield from (c for c in np.split(order, breaks) if len(c) > 1)


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of ``a`` from approximate vectors ``x``, by the iteration of Ogita and Aishima.

    A step squares the error of vectors whose eigenvalues lie apart. Those that lie closer than the error are turned
    inside their subspace, by the eigenvectors of ``a`` there, shifted by their mean, before the next step.
    """
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    norm = np.abs(a).sum(axis=1).max()
    noise = len(a) * np.finfo(np.longdouble).eps * norm
    best = None
    for _ in range(STEPS):
        off = one - product(x.T, x)
        inner = product(x.T, product(a, x))
        off, inner = (off + off.T) / 2, (inner + inner.T) / 2  # rounding must not turn vectors of close values out of square
        values = np.diag(inner) / (1 - np.diag(off))
        miss = np.abs(inner - np.diag(values)).sum(axis=1).max()
        width = 2 * (miss + norm * np.abs(off).sum(axis=1).max())
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > width
        change = np.where(apart, (inner + values[None, :] * off) / np.where(apart, gap, 1), off / 2)
        size = np.abs(change).max()
        if np.abs(off).max() <= noise / norm and best is not None and size >= best / 2:  # rounding is all that is left
            break
        best = size
        x = x + product(x, change)
        for run in _clusters(values, width):
            part = x[:, run]
            mean = values[run].mean()
            small = product(part.T, product(a, part) - mean * part)
            top = np.abs(small).max()
            if np.abs(small - np.diag(np.diag(small))).max() > noise:
                turn = np.linalg.eigh(((small + small.T) / (2 * top)).astype(float))[1]
                x[:, run] = product(part, turn.astype(np.longdouble))
                best = None
    return values, x


def eigenvectors(exact: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues by falling size, unit eigenvectors as columns, and the trace, of ``exact`` over ``n * n``."""
    a = _extended(exact, n * n)
    top = np.abs(a).max(initial=0)
    if not top > 0:
        return np.zeros(len(a)), np.eye(len(a)), 0.0
    start = np.linalg.eigh((a / top).astype(np.float32))[1]
    values, x = refined(a / top, start)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x / np.sqrt((x * x).sum(axis=0))
    x = x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])  # the sign is free: the largest entry is positive
    return np.maximum(values[order] * top, 0).astype(float), x.astype(float), float(np.diag(a).sum())


# --- the operator ----------------------------------------------------------------------


def fit(vectors: DataFrame, *, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of clean ``vectors``; of several dimensions the one that most rows have, then the largest."""
    found = row_sums(vectors)
    if not found:
        return None
    dim = max(found, key=lambda d: (found[d][0], d))
    n, sums = found[dim]
    values, vectors_, trace = eigenvectors(covariance(vectors, n, sums), n)
    return Whitening(n, sums, vectors_[:, :components], values[:components], trace)


def _projection(model: Whitening):
    """From integers to whitened values: the centre and what the centred rows are multiplied by."""
    dim = len(model.sums)
    centre = [(2 * s + model.n) // (2 * model.n) for s in model.sums]
    rest = np.array([(s - model.n * c) / model.n for s, c in zip(model.sums, centre)])
    # An eigenvalue that rounding could have made has no direction to scale.
    real = model.values > dim * np.finfo(np.longdouble).eps * 64 * model.values.max(initial=0)
    scale = np.divide(1, np.sqrt(model.values), out=np.full(len(model.values), np.nan), where=real)
    matrix = model.components * scale

    def project(x: np.ndarray) -> np.ndarray:
        y = (x - np.array(centre, np.int64)).astype(float) - rest
        return y @ matrix

    return project, centre


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity, by size."""
    project, _ = _projection(model)
    dim, k = len(model.sums), len(model.values)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in _scaled(batch, dim):
                for start in range(0, len(x), BLOCK_ROWS):
                    w = np.nan_to_num(project(x[start : start + BLOCK_ROWS]))
                    total[:k] += w.T @ w
                    total[k] += w.sum(axis=0)
        yield _parts(list(enumerate(total.tolist())), pa.float64())

    total = np.zeros((k + 1, k))
    for r in _added(vectors.mapInArrow(multiply, _PARTS.format("double")), "double").collect():
        total[r["key"]] = r["values"]
    mean = total[k] / model.n
    real = np.isfinite(project(np.zeros((1, dim), np.int64))[0])
    error = np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k))[np.ix_(real, real)]
    return float(error.max(initial=0))


_WHITE = pa.schema(
    [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
     ("explained", pa.float64()), ("identity_error", pa.float64())]
)
_WHITE_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, centre: list[int], sums: list[int]) -> pa.Array:
    """``sum((n * x - sums) ** 2)`` per row, exactly; null beyond a long."""
    rest = [s - n * c for s, c in zip(sums, centre)]
    y = x - np.array(centre, np.int64)
    far = n * float(np.abs(y.astype(float)).max(initial=0)) + n
    if far * far * max(x.shape[1], 1) < LARGEST:
        d = n * y - np.array(rest, np.int64)
        return pa.array((d * d).sum(axis=1), pa.int64())
    d = n * y.astype(object) - np.array(rest, object)
    return pa.array([int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)], pa.int64())


def whitened(df: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: for each row of ``df`` (``vec_id``,
    ``embedding``) and each of the first components its whitened coordinate.

    Rows without a vector, or with a null or non-finite entry, are left out, and so are those whose vector has not the
    number of dimensions that most rows have. Repeated rows and null ids are rows of their own. Entries
    beyond 2^62 after scaling count as that; a ``deviation`` that no long holds is null. A direction in
    which the rows do not differ has ``explained`` 0 and ``whitened`` null, and no part in ``identity_error``.
    An empty table gives no rows. Other columns are not read.
    """
    vectors = clean_vectors(df)
    model = fit(vectors, components=components)
    if model is None:
        return vectors.where(F.lit(False)).mapInArrow(lambda batches: iter(()), _WHITE_DDL)
    error = identity_error(vectors, model)
    project, centre = _projection(model)
    dim, k = len(model.sums), len(model.values)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, x in _scaled(batch, dim):
                for start in range(0, len(x), BLOCK_ROWS):
                    part = x[start : start + BLOCK_ROWS]
                    m = len(part)
                    row = pa.array(np.repeat(np.arange(m), k))
                    yield pa.record_batch(
                        [found.column("vec_id").slice(start, m).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                         pa.array(np.full(m * k, model.n)), _deviations(part, model.n, centre, model.sums).take(row),
                         pa.array(project(part).ravel(), from_pandas=True), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                        schema=_WHITE,
                    )

    return vectors.mapInArrow(rows, _WHITE_DDL)
