"""Embedding whitening by polarisation covariance.

Vectors become whole numbers x, and each distinct x vector counts once in the fit. With n of
them and sums S by dimension, t = n * x - S is a centred value without rounding. The tasks add
up exact squares only: of t_i for every dimension and of t_i + t_j for every pair. Differences
of these variances give every covariance,

    2 * sum(t_i * t_j) = sum((t_i + t_j) ** 2) - sum(t_i ** 2) - sum(t_j ** 2),

and the eigenvectors of the assembled matrix turn and scale each row. Vectors stay where they
are but for one shuffle that finds the distinct ones; what reaches the driver is one pair of
numbers a pair of dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespan.llm.common import scoped, stage

SCALE = 256
COMPONENTS = 4
CHUNK = 2048  # rows squared together
LIMB = 21  # bits of a limb: sums of products of two limbs over CHUNK rows fit in 64 bits
HALF = 10**18  # sums travel as two decimals, v = hi * HALF + lo, so that no total overflows
FLAT = 1e-13  # a component whose share of the variance is below this has none

FITTED = "vec_id long, x array<long>"
OUT = "vec_id long, component int, n long, deviation long, deviation_exact string, whitened double, explained double, identity_error double"


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which of the vectors are whole and finite, and the entries of those, one after another."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)  # a null entry becomes NaN
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    size = np.where(there, size, 0)
    owner = np.repeat(np.arange(len(size)), size)
    bad = np.bincount(owner, weights=~np.isfinite(flat), minlength=len(size)) > 0
    keep = there & ~bad & (size > 0)
    return keep, flat[np.repeat(keep, size)]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id and x of the usable rows."""
    for batch in batches:
        keep, flat = _matrix(batch.column(1))
        kept = batch.filter(pa.array(keep))
        size = kept.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        scaled = np.floor(flat * SCALE)
        top = float(2**63)
        x = np.where(scaled >= top, np.iinfo(np.int64).max, np.where(scaled < -top, np.iinfo(np.int64).min, np.clip(scaled, -top, np.nextafter(top, 0)).astype(np.int64)))
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([kept.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))], ["vec_id", "x"])


def vectors(rows: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, x of the rows whose vector is there, not empty, and free of null and non-finite entries."""
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("v")).mapInArrow(_whole, FITTED)


def _rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The x vectors of a batch as matrices of at most CHUNK rows."""
    x = batch.column(batch.schema.get_field_index("x"))
    for at in range(0, len(x), CHUNK):
        part = x.slice(at, CHUNK)
        yield part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(part), -1)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S without rounding: 64-bit numbers where they are sure to hold it, else Python's."""
    most = max((abs(int(x.max())), abs(int(x.min()))), default=0) if x.size else 0
    if n * most + max(map(abs, sums), default=0) < 1 << 61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squares(u: np.ndarray) -> list[int]:
    """Exact sum of squares of each column."""
    if u.dtype == object:
        return [int(v) for v in (u * u).sum(axis=0)]
    most = int(np.abs(u).max()) if u.size else 0
    if most * most * max(len(u), 1) < 1 << 62:
        return [int(v) for v in np.einsum("ij,ij->j", u, u)]
    low = (1 << LIMB) - 1
    limbs = [u & low, (u >> LIMB) & low, u >> (2 * LIMB)]
    total = [0] * u.shape[1]
    for i in range(3):
        for j in range(i, 3):
            part = np.einsum("ij,ij->j", limbs[i], limbs[j])
            total = [a + (int(b) << (LIMB * (i + j) + (i != j))) for a, b in zip(total, part)]
    return total


def row_squares(t: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    most = max(abs(int(t.max())), abs(int(t.min()))) if t.size else 0
    if most * most * t.shape[1] >= 1 << 63:
        t = t.astype(object)
    return [int(v) for v in (t * t).sum(axis=1)]


def _halves(keys: list[tuple[int, int]], values: list[int]) -> pa.RecordBatch:
    dec = pa.decimal128(38, 0)
    hi = [Decimal(v // HALF) for v in values]
    lo = [Decimal(v % HALF) for v in values]
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array(hi, dec), pa.array(lo, dec)],
        ["i", "j", "hi", "lo"],
    )


def _exact(df: DataFrame, task) -> dict[tuple[int, int], int]:
    """Exact sums by (i, j) of what each task adds up; one row a pair of dimensions reaches the driver."""
    parts = df.mapInArrow(task, "i int, j int, hi decimal(38,0), lo decimal(38,0)")
    sums = parts.groupBy("i", "j").agg(F.sum("hi").cast("string").alias("hi"), F.sum("lo").cast("string").alias("lo"))
    return {(r.i, r.j): int(r.hi) * HALF + int(r.lo) for r in sums.collect()}


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of each dimension, and under (-1, -1) the number of vectors."""
    total: list[int] = []
    n = 0
    for batch in batches:
        for x in _rows(batch):
            n += len(x)
            small = abs(int(x.max())) < 1 << 50 and abs(int(x.min())) < 1 << 50
            part = [int(v) for v in (x if small else x.astype(object)).sum(axis=0)]
            total = [a + b for a, b in zip(total, part)] if total else part
    if n:
        yield _halves([(-1, -1), *((i, i) for i in range(len(total)))], [n, *total])


def _pair_squares(n: int, sums: list[int]):
    """Task: squared centred values of every dimension under (i, i), of every pair's sum under (i, j)."""
    d = len(sums)
    keys = [(i, j) for i in range(d) for j in range(i, d)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] | None = None
        for batch in batches:
            for x in _rows(batch):
                t = centred(x, n, sums)
                part: list[int] = []
                for i in range(d):
                    pairs = t[:, i : i + 1] + t[:, i:]
                    pairs[:, 0] = t[:, i]
                    part += squares(pairs)
                total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            yield _halves(keys, total)

    return task


def covariance(n: int, d: int, squared: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance of x from sums of squares of t = n * x - S: each entry is rounded once."""
    out = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            twice = 2 * squared[i, i] if i == j else squared[i, j] - squared[i, i] - squared[j, j]
            out[i, j] = out[j, i] = float(Fraction(twice, 2 * n**3))
    return out


def _axes(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions (a column each), eigenvalues and shares of the variance, by falling eigenvalue."""
    value, axis = np.linalg.eigh(v)
    top = np.argsort(-value, kind="stable")[:components]
    trace = float(np.trace(v))
    e = value[top]
    return axis[:, top], e, e / trace if trace > 0 else np.zeros(len(e))


def _turned(x: np.ndarray, n: int, sums: list[int], axis: np.ndarray, e: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Whitened values of rows, NaN in a component without variance."""
    scale = np.where(share > FLAT, np.sqrt(np.maximum(e, 0)), np.nan)
    return (centred(x, n, sums).astype(np.float64) / n) @ axis / scale


def _products(*fit):
    """Task: sums of whitened values' products, under (i, j). Whitened values are centred already."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for x in _rows(batch):
                w = _turned(x, *fit)
                total = total + w.T @ w
        if not np.isscalar(total):
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])

    return task


def _project(error: float | None, n: int, sums: list[int], axis: np.ndarray, e: np.ndarray, share: np.ndarray):
    """Task: a row for each row and component."""
    k = len(e)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _rows(batch):
                ids = batch.column(0).slice(at, len(x))
                at += len(x)
                whole = row_squares(centred(x, n, sums))
                w = _turned(x, n, sums, axis, e, share)
                rows = pa.array(np.repeat(np.arange(len(x)), k))
                long = pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(rows),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), n)),
                        long.take(rows),
                        pa.array(list(map(str, whole)), pa.string()).take(rows),
                        pa.array(w.ravel(), from_pandas=True),
                        pa.array(np.tile(share, len(x))),
                        pa.array([error] * len(rows), pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"],
                )

    return task


@scoped
def whiten(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, deviation_exact,
    whitened, explained, identity_error.

    Rows with a null or empty vector or a null or non-finite entry go. Where vectors differ in
    length, those of the length that most distinct vectors have (of equals, the longest) make
    up the table and the others go as well. Repeated rows and null ids are rows like others, and count once in the
    fit as equal vectors do; other columns, whatever their names, are not read. Entries beyond
    64 bits stop at the ends. ``deviation`` is null where it passes a long;
    ``deviation_exact`` has it in any case. A component without variance (fewer distinct
    vectors than dimensions) has ``whitened`` null and stays out of ``identity_error``, which
    is null if no component is left. Components of equal eigenvalues may be turned among
    themselves. Empty input gives no rows.
    """
    spark = embeddings.sparkSession
    every = vectors(embeddings, column, key)
    distinct = stage(every.select("x").distinct(), "whiten-fit")
    sizes = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], OUT)
    d = sizes.d
    fitted = distinct.filter(F.size("x") == d)
    total = _exact(fitted, _column_sums)
    n, sums = total.pop((-1, -1)), [total[i, i] for i in range(d)]
    v = covariance(n, d, _exact(fitted, _pair_squares(n, sums)))
    axis, e, share = _axes(v, components)
    fit = (n, sums, axis, e, share)
    seen = fitted.mapInArrow(_products(*fit), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    wide = share > FLAT
    gaps = [abs(r.s / n - (r.i == r.j)) for r in seen if wide[r.i] and wide[r.j]]
    return every.filter(F.size("x") == d).mapInArrow(_project(max(gaps, default=None), *fit), OUT)
