"""Whitening of embeddings by spectrum slicing.

The leading eigenvalues of the covariance are isolated by counting: by Sylvester's law the pivots of
an LDL' factorisation of V - s I have the signs of the eigenvalues less s, so one factorisation tells
how many lie above s. Intervals are halved until each holds one eigenvalue; there Rayleigh quotient iteration converges cubically, and
falls back to a halved interval where its quotient leaves it. Eigenvalues too close for vectors of
their own are iterated as a block, whose quotient is a small matrix. At the end the counts on both
sides of each value certify its number.

Entries become integers, so sums are exact and vectors are centred without rounding. The covariance
is summed by task and then by matrix row; only it, of a size that the dimension sets, is on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues below this share of the largest are rounding, and their directions hold no variance.
RANK_SHARE = 1e-11
#: Eigenvalues closer than this share of the largest are treated as one cluster.
CLUSTER = 1e-8
_EPS = np.finfo(float).eps
_ALPHA = (1 + np.sqrt(17)) / 8
#: Output rows a batch, and entries of a block that is multiplied.
BATCH_ROWS, BLOCK = 8_192, 1 << 20


def count_above(v: np.ndarray, s: float) -> int:
    """How many eigenvalues of symmetric ``v`` are above ``s``: positive pivots of V - s I, with Bunch-Kaufman pivoting."""
    a, n, k, above = v - s * np.eye(len(v)), len(v), 0, 0
    while k < n:
        here, two = abs(a[k, k]), False
        if k < n - 1:
            col = np.abs(a[k + 1 :, k])
            r = int(np.argmax(col)) + k + 1
            most = col[r - k - 1]
            if max(here, most) == 0:
                k += 1
                continue
            if here < _ALPHA * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if here * other < _ALPHA * most * most:
                    two = abs(a[r, r]) < _ALPHA * other
                    to = k + 1 if two else k
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if two:
            d = a[k : k + 2, k : k + 2]
            det = d[0, 0] * d[1, 1] - d[0, 1] * d[1, 0]
            above += 1 if det < 0 else 2 * int(d[0, 0] > 0)
            c = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(d, c.T)
            k += 2
        else:
            above += int(a[k, k] > 0)
            if a[k, k] != 0:
                c = a[k + 1 :, k]
                a[k + 1 :, k + 1 :] -= np.outer(c, c / a[k, k])
            k += 1
    return above


def _solve(v: np.ndarray, s: float, x: np.ndarray, step: float) -> np.ndarray:
    for k in range(8):
        try:
            y = np.linalg.solve(v - (s + k * step) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all() and (size := np.linalg.norm(y)) > 0:
            return y / size
    raise ArithmeticError(f"no inverse iteration at {s}")


def leading(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a covariance ``v``: at most ``most``, those that are not rounding."""
    d, trace = len(v), float(np.trace(v)) if len(v) else 0.0
    if not trace > 0:
        return np.empty(0), np.empty((d, 0))
    top = float(np.abs(v).sum(1).max())
    tight = 4 * _EPS * top * np.sqrt(d)
    ends = (RANK_SHARE * trace, top + tight)
    rank = count_above(v, ends[0])
    want = min(most, rank)
    if want < rank:  # with the last one, all that are as close to it as the members of a cluster
        last = min(low for low, _, _ in _slices(v, *ends, rank, want, tight))
        wide = min(rank, count_above(v, last - CLUSTER * top))
    else:
        wide = want
    rng, found = np.random.default_rng(11), []
    for low, high, n in _slices(v, *ends, rank, wide, tight):
        one = _rayleigh(v, low, high, tight, rng) if n == 1 else None
        found += [one] if one else [((low + high) / 2, rng.normal(size=d)) for _ in range(n)]
    found.sort(key=lambda x: -x[0])
    values, vectors = np.array([x[0] for x in found[:wide]]), np.column_stack([x[1] for x in found[:wide]])
    edges = np.flatnonzero(np.r_[True, values[:-1] - values[1:] > CLUSTER * top, True])
    for i, j in zip(edges, edges[1:]):
        if j - i > 1:
            values[i:j], vectors[:, i:j] = _block(v, vectors[:, i:j], float(values[i:j].mean()), tight)
    values, vectors = values[:want], vectors[:, :want]
    slack = np.maximum(64 * tight, np.linalg.norm(v @ vectors - vectors * values, axis=0))
    for k, (value, by) in enumerate(zip(values, slack), 1):
        if by > 1e6 * tight or not count_above(v, value + by) < k <= count_above(v, value - by):
            raise ArithmeticError(f"component {k} is not certified: {value} +- {by}")
    return values, vectors


def _slices(v: np.ndarray, low: float, high: float, rank: int, want: int, tight: float) -> list[tuple[float, float, int]]:
    """(low, high, how many) that hold the first ``want`` eigenvalues: one each, or several that double precision can't part."""
    out, open_ = [], [(low, high, rank, 0)]
    while open_:
        low, high, n_low, n_high = open_.pop()
        if n_low <= n_high or n_high >= want:
            continue
        if n_low - n_high == 1 or high - low <= tight:
            out.append((low, high, n_low - n_high))
            continue
        middle = (low + high) / 2
        n = min(max(count_above(v, middle), n_high), n_low)
        open_ += [(low, middle, n_low, n), (middle, high, n, n_high)]
    return out


def _rayleigh(v: np.ndarray, low: float, high: float, tight: float, rng) -> tuple[float, np.ndarray] | None:
    """(value, unit vector) of the one eigenvalue between ``low`` and ``high``; None where neighbours are too close to tell."""
    while True:
        best, held, x = np.inf, None, rng.normal(size=len(v))
        for _ in range(2):
            x = _solve(v, (low + high) / 2, x, tight / 4)
        for _ in range(12):
            value = float(x @ v @ x)
            off = float(np.linalg.norm(v @ x - value * x))
            if not low - 64 * tight <= value <= high + 64 * tight or off >= best:  # counts are right to rounding
                break
            best, held = off, (value, x)
            x = _solve(v, value, x, tight / 4)
        if held and best <= 64 * tight:
            return held
        if high - low <= tight:
            return None
        middle = (low + high) / 2
        low, high = (middle, high) if count_above(v, middle) > count_above(v, high) else (low, middle)


def _block(v: np.ndarray, x: np.ndarray, shift: float, tight: float) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh quotient of a whole cluster: inverse iteration of its plane, then the eigenvectors inside it."""
    about = v - (shift + tight / 4) * np.eye(len(v))
    for _ in range(6):
        x = np.linalg.qr(x)[0]
        try:
            y = np.linalg.solve(about, x)
        except np.linalg.LinAlgError:
            break
        x = y / np.linalg.norm(y, axis=0)
    x = np.linalg.qr(np.linalg.qr(x)[0])[0]
    w, u = np.linalg.eigh(x.T @ ((v - shift * np.eye(len(v))) @ x))
    return shift + w[::-1], x @ u[:, ::-1]


def _vectors(df: DataFrame, vector_col: str):
    """The rows whose vector is not null and has finite entries only; vectors as doubles."""
    c = df[vector_col].cast("array<double>")
    return df.where(c.isNotNull() & ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).withColumn(vector_col, c)


def _whole(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as integers."""
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)).astype(np.int64) + SHIFT


def _summed(rows: DataFrame, dim: int, per_batch: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of a matrix a block of them gives; added up by task, then by matrix row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = _whole(b.column(0), dim)
            for at in range(0, len(x), max(1, BLOCK // dim)):
                part = per_batch(x[at : at + max(1, BLOCK // dim)])
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1)
            kind = pa.int64() if total.dtype == np.int64 else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel(), kind)], names=["i", "j", "v"])

    whole = per_batch(np.zeros((0, dim), np.int64))
    kind, wide = ("long", "decimal(38,0)") if whole.dtype == np.int64 else ("double", "double")
    cells = rows.mapInArrow(run, f"i int, j int, v {kind}").groupBy("i", "j").agg(F.sum(F.col("v").cast(wide)).alias("v")).toArrow()  # a row an entry
    out = np.zeros(whole.shape, object if whole.dtype == np.int64 else float)
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = [int(v) for v in cells["v"].to_pylist()] if whole.dtype == np.int64 else cells["v"].to_numpy()
    return out


class Whitening:
    """n, sums, eigenvalues and vectors of a fit list, and how it maps vectors."""

    def __init__(self, n: int, sums: list[int], dim: int):
        self.n, self.dim = n, dim
        # x - S/n is (x - base) - rest/n, with an exact first part
        self.base, self.rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
        self.values, self.vectors, self.trace, self.error = np.empty(0), np.empty((dim, 0)), 0.0, 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 by vector, exact; None where it is no 64-bit integer."""
        about = ((self.n * self.centred(x)) ** 2).sum(1)
        if not len(about) or about.max() < 2.0**62:
            return ((self.n * (x - self.base) - self.rest) ** 2).sum(1).tolist()
        out: list[int | None] = []
        for row, a in zip(x - self.base, about):
            exact = sum((self.n * int(c) - int(r)) ** 2 for c, r in zip(row, self.rest)) if a < 2.0**63 * 1.001 else 1 << 63
            out.append(exact if exact < 1 << 63 else None)
        return out


def fit(embeddings: DataFrame, vector_col: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """Fit to all vectors of ``embeddings`` that have finite entries only; None where there are none.

    Vectors of differing length, or with entries of 2 ** 55 and more, are an error.
    """
    rows = _vectors(embeddings, vector_col).select(F.col(vector_col).alias("e"))
    size = rows.agg(F.count("*").alias("n"), F.min(F.size("e")).alias("low"), F.max(F.size("e")).alias("high"), F.max(F.array_max(F.transform("e", F.abs))).alias("most")).first()
    if not size.n:
        return None
    if size.low != size.high or (size.most or 0) >= 2.0**55:
        raise ValueError(f"vectors have {size.low} to {size.high} entries of up to {size.most}")
    model = Whitening(size.n, [int(s) for s in _summed(rows, size.low, lambda x: x.sum(0, keepdims=True))[0]] if size.low else [], size.low)
    if not size.low:
        return model

    def product(x: np.ndarray) -> np.ndarray:
        c = model.centred(x)
        return c.T @ c

    v = _summed(rows, size.low, product) / size.n
    model.trace = float(np.trace(v))
    model.values, model.vectors = leading((v + v.T) / 2, most)
    if len(model.values):
        # the covariance of what comes out, about its own mean
        mean = _summed(rows, size.low, lambda x: model.whitened(x).sum(0, keepdims=True))[0] / size.n

        def again(x: np.ndarray) -> np.ndarray:
            w = model.whitened(x) - mean
            return w.T @ w

        model.error = float(np.abs(_summed(rows, size.low, again) / size.n - np.eye(len(model.values))).max())
    return model


def whiten(embeddings: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out. Repeated rows and null
    ids keep their rows; an empty table, or one whose vectors are all alike or empty, gives none, as no direction holds
    variance. There are fewer components where fewer do. ``deviation`` is null where it exceeds 64
    bits. Equal eigenvalues share their plane: any perpendicular vectors of it. Other columns are not read.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    shared = embeddings.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        for b in batches:
            for at in range(0, b.num_rows, max(1, BATCH_ROWS // k)):
                part = b.slice(at, max(1, BATCH_ROWS // k))
                x = _whole(part.column(1), m.dim)
                rows = len(x) * k
                dev = pa.array([d for d in m.deviation(x) for _ in range(k)], pa.int64())
                cols = [
                    part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(rows, m.n), pa.int64()), dev,
                    pa.array(m.whitened(x).ravel()), pa.array(np.tile(m.values / m.trace, len(x))), pa.array(np.full(rows, m.error)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in schema.split(", ")])

    return _vectors(embeddings, vector_col).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("e")).mapInArrow(run, schema)


def op11(spark, sf_dir: str) -> DataFrame:
    """All embeddings whitened; edge cases as in ``whiten``."""
    rows = table(spark, sf_dir, "embeddings")
    return whiten(rows, fit(rows))
