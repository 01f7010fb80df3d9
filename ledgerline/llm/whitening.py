"""Embedding whitening by shifted CholeskyQR.

Vectors are put on the grid ``x = floor(SCALE * c)`` (whole numbers, so counts,
sums and deviations are exact). The components are fitted on the distinct grid
vectors, so copies weigh nothing.

Method. With A the centred fit rows, each pass over them sums the Gram matrix
of ``A R^-1`` (every task solves its rows against the triangular factors so far
and adds up its own matrix; one aggregate adds the tasks'). The Cholesky factor
of the Gram matrix, shifted by a multiple of the rounding error while it is not
safely positive, joins the composition ``R = R3 R2 R1``. After the last pass
``A^T A = R^T G R`` with G measured and near the identity (near a projector
where dimensions depend on each other); the SVD of ``G^1/2 R`` gives singular
values s and right vectors w, hence eigenvalues ``s^2 / n`` and components w of
the covariance without ever squaring the condition number.

Per fit row the passes read a packed copy (1, 2, 4 or 8 bytes an entry); the
driver holds d x d matrices only, whatever the number of rows.

Defined results: rows whose vector is null, or holds null, NaN or infinite
entries, are dropped; empty vectors have no component and give no row; vectors
of different lengths raise. Repeated and null ids come back as often as they
went in. Components without variance (eigenvalue below rounding error) cannot be
whitened and are left out: one distinct vector, or an empty table, gives no
rows. The sign of a component is fixed by its largest entry being positive.
Numbers outside a long raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship_package, written

SCALE = 256
COMPONENTS = 4
ROUNDS = 3
ROUNDING = np.finfo(np.float64).eps
BLOCK_ENTRIES = 1 << 20

PACKED = "packed binary"
GRAM = "i int, j int, v double"


class Fit(NamedTuple):
    n: int
    sums: np.ndarray        # long, one per dimension
    values: np.ndarray      # eigenvalues, falling
    vectors: np.ndarray     # d x k, one column per component
    trace: float
    identity_error: float
    largest: int            # of all entries, without sign


def _pack(x: np.ndarray) -> list[bytes]:
    """Each row as width and little-endian entries of the least width that holds it."""
    low, high = x.min(1), x.max(1)
    out: list[bytes] = [b""] * len(x)
    left = np.ones(len(x), bool)
    for kind in ("<i1", "<i2", "<i4", "<i8"):
        limit = np.iinfo(np.dtype(kind))
        rows = np.flatnonzero(left & (low >= limit.min) & (high <= limit.max))
        mark, packed = kind[2].encode(), x[rows].astype(kind)
        for k, r in enumerate(rows):
            out[r] = mark + packed[k].tobytes()
        left[rows] = False
    return out


def _unpack(packed: list[bytes]) -> np.ndarray:
    """Matrix of longs."""
    d = (len(packed[0]) - 1) // int(packed[0][:1])
    if any(len(p) != 1 + d * int(p[:1]) for p in packed):
        raise ValueError("vectors of different lengths")
    out = np.empty((len(packed), d), np.int64)
    marks = np.array([int(p[:1]) for p in packed])
    for width in np.unique(marks):
        rows = np.flatnonzero(marks == width)
        out[rows] = np.frombuffer(b"".join([packed[r][1:] for r in rows]), f"<i{width}").reshape(len(rows), -1)
    return out


def _grid(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors and their grid matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat, offs = col.flatten(), np.asarray(col.value_lengths().fill_null(0), np.int64)
    entries = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), np.float64)
    bounds = np.concatenate([[0], np.cumsum(offs)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    good = np.flatnonzero((offs > 0) & (bad[bounds[1:]] == bad[bounds[:-1]]))
    if not len(good):
        return good, np.zeros((0, 0), np.int64)
    d = int(offs[good[0]])
    if (offs[good] != d).any():
        raise ValueError("vectors of different lengths")
    rows = entries[bounds[good][:, None] + np.arange(d)]
    x = np.floor(SCALE * rows)
    if np.abs(x).max() >= 2.0 ** 63:
        raise ArithmeticError("an entry is too large for a long")
    return good, x.astype(np.int64)


def _cut(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a batch of about BLOCK_ENTRIES entries."""
    col = batch.column(column)
    per = max(1, len(col.flatten()) // max(1, len(col))) if pa.types.is_list(col.type) else 64
    step = max(1, BLOCK_ENTRIES // per)
    for first in range(0, batch.num_rows, step):
        yield first, col.slice(first, step)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, col in _cut(batch, 0):
            _, x = _grid(col)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(_pack(x), pa.binary())], ["packed"])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        step = max(1, BLOCK_ENTRIES // max(1, len(batch.column(0)[0].as_py()))) if batch.num_rows else 1
        for first in range(0, batch.num_rows, step):
            yield _unpack(batch.column(0).slice(first, step).to_pylist())


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and whole-number sums per dimension, as decimal text for an exact total."""
    n, total, largest = 0, None, 0
    for x in _matrices(batches):
        if total is not None and len(total) != x.shape[1]:
            raise ValueError("vectors of different lengths")
        most = int(np.abs(x).max(initial=0))
        largest = max(largest, most)
        part = x.sum(0).astype(object) if most * len(x) < 2 ** 62 else x.astype(object).sum(0)
        n, total = n + len(x), part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                                          pa.array([str(v) for v in total], pa.string()),
                                          pa.array([largest] * len(total), pa.int64())], ["j", "n", "s", "largest"])


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, with n x - S whole where it fits a long."""
    if int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0)) < 2 ** 62:
        return (n * x - sums.astype(np.int64)) / n
    return x - np.array([float(s) / n for s in sums])


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows R1^-1 R2^-1 ...: one triangular solve per factor."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def _grams(n: int, sums: np.ndarray, factors: list[np.ndarray], weight: np.ndarray | None):
    """Gram matrix of a task's centred rows after the triangular solves
    (or times ``weight``), upper triangle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _matrices(batches):
            rows = centred(x, n, sums)
            rows = rows @ weight if weight is not None else _solved(rows, factors)
            total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])
    return run


def _gram(fit: DataFrame, n: int, sums: np.ndarray, d: int, factors: list[np.ndarray], weight: np.ndarray | None = None) -> np.ndarray:
    parts = fit.mapInArrow(_grams(n, sums, factors, weight), GRAM)
    out = np.zeros((d, d))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # d^2 numbers
        out[i, j] = out[j, i] = v
    return out


def _factor(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper Cholesky factor, shifted until the matrix is safely positive."""
    d = len(gram)
    least, norm = np.linalg.eigvalsh(gram)[0], np.linalg.norm(gram, 2)
    shift = 11 * (min(n, 1 << 20) * d + d * (d + 1)) * ROUNDING * norm
    shift = min(shift, 1e-8 * norm)
    if least > shift:
        return np.linalg.cholesky(gram).T
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def fit_components(vectors: DataFrame, col: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The whitening fitted on the distinct grid vectors; None if there are none."""
    ship_package(vectors.sparkSession)
    fit = written(vectors.select(F.col(f"`{col}`").alias("v")).mapInArrow(_packed, PACKED).distinct())
    parts = fit.mapInArrow(_sums, "j int, n long, s string, largest long")
    got = parts.groupBy("j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"),
                                 F.max("largest").alias("largest")).orderBy("j").collect()
    if not got:
        return None
    n, d = got[0]["n"], len(got)
    if any(r["n"] != n for r in got):
        raise ValueError("vectors of different lengths")
    sums = np.array([int(r["s"]) for r in got], object)
    factors: list[np.ndarray] = []
    gram = _gram(fit, n, sums, d, factors)
    trace = float(np.trace(gram)) / n
    if trace == 0:
        return Fit(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, 0)
    composed = np.eye(d)
    for _ in range(ROUNDS):
        r = _factor(gram, n)
        factors.append(r)
        composed = r @ composed
        gram = _gram(fit, n, sums, d, factors)
    values, turn = np.linalg.eigh(gram)
    root = (turn * np.sqrt(np.clip(values, 0, None))) @ turn.T
    _, s, w = np.linalg.svd(root @ composed)
    k = int(np.sum(s[:components] > s[0] * d * 1e-10))
    axes = w[:k].T
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    eigen = s[:k] ** 2 / n
    white = _gram(fit, n, sums, k, [], axes / np.sqrt(eigen)) / n
    return Fit(n, sums, eigen, axes, trace, float(np.abs(white - np.eye(k)).max()), max(r["largest"] for r in got))


def _fits_long(fit: Fit) -> bool:
    most = fit.largest * fit.n + max((abs(int(s)) for s in fit.sums), default=0)
    return most * most * max(1, len(fit.sums)) < 2 ** 62


def _whitened(fit: Fit):
    weight = fit.vectors / np.sqrt(fit.values)
    k, sums, small = len(fit.values), fit.sums, _fits_long(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, col in _cut(batch, 1):
                at, x = _grid(col)
                if not len(at):
                    continue
                off = fit.n * x - sums.astype(np.int64) if small else fit.n * x.astype(object) - sums
                spread = np.repeat((off * off).sum(1), k)
                white = centred(x, fit.n, sums) @ weight
                rows = batch.column(0).take(pa.array(np.repeat(at + first, k)))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()), pa.array(spread if small else [str(v) for v in spread]),
                     pa.array(white.ravel(), pa.float64()), pa.array(np.tile(fit.values / fit.trace, len(at)), pa.float64())],
                    ["row", "component", "deviation", "whitened", "explained"])
    return run


def whiten(vectors: DataFrame, col: str = "embedding", components: int = COMPONENTS, keep: list[str] | None = None) -> DataFrame:
    """One row per usable row of ``vectors`` and component: the struct ``row`` of
    its columns (``keep``: only those), ``component``, ``n`` (distinct grid
    vectors), ``deviation`` (sum of (n x - S)^2, decimal), ``whitened``,
    ``explained`` (share of the whole variance) and ``identity_error``."""
    carried = [c for c in vectors.columns if keep is None or c in keep]
    row = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row")
    fit = fit_components(vectors, col, components)
    source = vectors.select(row, F.col(f"`{col}`").alias("v"))
    kind = source.schema["row"].dataType.simpleString()
    if fit is None or not len(fit.values):
        source, fit = source.where("false"), Fit(0, np.zeros(0, object), np.ones(0), np.zeros((0, 0)), 1.0, 0.0, 0)
    out = source.mapInArrow(_whitened(fit), f"row {kind}, component int, deviation {'long' if _fits_long(fit) else 'string'}, whitened double, explained double")
    return out.select("row", "component", F.lit(fit.n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
                      "whitened", "explained", F.lit(fit.identity_error).alias("identity_error"))
