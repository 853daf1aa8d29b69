"""Whitening of embeddings by a bidiagonal qd solver.

The entries are integers, so sums and centred rows ``n x - S`` are exact. Every task reduces its
centred rows block by block to one upper triangular R (QR of R stacked on the next block); the R of
all tasks are reduced in rounds of bounded fan-in until one is left. Its singular values squared
over n are the eigenvalues of the covariance, without the covariance ever being formed.

What is left is as wide as the vectors and is solved at the driver: Householder reflections make R
bidiagonal, the differential quotient-difference algorithm with shifts (dqds) finds the singular
values to high relative accuracy, and twisted factorisations of the same quotient-difference
representation give the vectors. Values closer together than `CLUSTER` relative to their size share
one space; there the twisted factors serve inverse iteration with reorthogonalisation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import column

COMPONENTS = 32
FAN_IN = 32  # triangles that one task stacks in a round
BLOCK_ROWS = 4096
CLUSTER = 1e-5
#: Fixed values of the contract: entries are floor(64 c) + 1000000.
SCALE, OFFSET = 64, 1_000_000
_EPS = np.finfo(np.float64).eps
_LONG_LIMIT = 9.2e18


# --- the solver ------------------------------------------------------------------------


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and W, with ``r = U B W'`` for some orthogonal U."""
    a = np.array(r, np.float64)
    d = len(a)
    w = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """v of unit length with (I - 2 v v') x along the first axis."""
        largest = np.abs(x).max(initial=0.0)
        if len(x) < 2 or largest == 0 or not np.any(x[1:]):
            return None
        v = x / largest
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 1 < d and (v := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _qd(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform; None where the shift exceeds the smallest value. The last number is the
    smallest of the intermediate d, an upper bound of the smallest value."""
    d, out_q, out_e = q[0] - shift, [], []
    least = d
    if d < 0:
        return None
    for k in range(len(e)):
        new = d + e[k]
        ratio = q[k + 1] / new if new else 0.0
        out_q.append(new)
        out_e.append(e[k] * ratio)
        d = d * ratio - shift
        if d < 0 or d != d:
            return None
        least = min(least, d)
    out_q.append(d)
    return out_q, out_e, least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix by dqds, falling."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if not scale:
        return np.zeros(len(diagonal))
    # Zeros on the diagonal are lifted far below rounding, so that every quotient exists.
    floor = (_EPS * _EPS) ** 2
    blocks = [
        ([max(float(x), floor) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)
    ]
    found = []
    tolerance = _EPS**2 * 100
    while blocks:
        q, e, total = blocks.pop()
        least = min(q)
        while q:
            if len(q) == 1:
                found.append(q[0] + total)
                break
            # A small coupling in the middle separates two problems with the same total shift.
            cut = next((k for k in range(len(e) - 1) if e[k] <= tolerance * (total + min(q[k], q[k + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], total))
                q, e = q[cut + 1 :], e[cut + 1 :]
                least = min(q)
                continue
            if e[-1] <= tolerance * (total + q[-1]):
                found.append(q.pop() + total)
                e.pop()
                continue
            # Flip a graded problem so that the small values stand at the end.
            if q[0] < 0.5 * q[-1]:
                q, e = q[::-1], e[::-1]
            shift = 0.95 * least if total or least < 0.01 * max(q) else 0.75 * least
            shift = min(shift, q[-1])
            step = None
            while step is None:
                step = _qd(q, e, shift)
                if step is None:
                    shift = shift / 4 if shift > 1e-3 * least else 0.0
            total += shift
            q, e, least = step
    return np.sort(np.array(found))[::-1] * scale**2


@dataclass
class Twisted:
    """``L D L' - value I`` as ``N G N'``, twisted at the place where the middle entry is smallest.

    ``lower`` are the multipliers above the twist and ``upper`` those below it."""

    at: int
    gamma: float
    lower: np.ndarray
    upper: np.ndarray
    top: np.ndarray
    bottom: np.ndarray

    @classmethod
    def factor(cls, q: np.ndarray, ratios: np.ndarray, value: float) -> Twisted:
        """``q`` is the diagonal D and ``ratios`` the entries of L below its unit diagonal."""
        n = len(q)
        tiny = _EPS * _EPS * max(abs(value), float(np.abs(q).max())) or 1e-300
        s, p = np.zeros(n), np.zeros(n)
        lower, upper = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        top, bottom = np.zeros(n), np.zeros(n)
        s[0] = -value
        for k in range(n - 1):
            top[k] = s[k] + q[k] or tiny
            lower[k] = q[k] * ratios[k] / top[k]
            s[k + 1] = lower[k] * ratios[k] * s[k] - value
        top[n - 1] = s[n - 1] + q[n - 1] or tiny
        p[n - 1] = q[n - 1] - value
        for k in range(n - 2, -1, -1):
            bottom[k + 1] = q[k] * ratios[k] ** 2 + p[k + 1] or tiny
            ratio = q[k] / bottom[k + 1]
            upper[k] = ratios[k] * ratio
            p[k] = p[k + 1] * ratio - value
        bottom[0] = p[0] or tiny
        gammas = s + p + value
        gammas[~np.isfinite(gammas)] = np.inf
        at = int(np.abs(gammas).argmin())
        return cls(at, float(gammas[at]) or tiny, lower, upper, top, bottom)

    def vector(self) -> np.ndarray:
        """The solution of ``N G N' z = gamma e``, of unit length: nearly an eigenvector."""
        z = np.zeros(len(self.top))
        z[self.at] = 1.0
        for k in range(self.at - 1, -1, -1):
            z[k] = -self.lower[k] * z[k + 1]
        for k in range(self.at, len(z) - 1):
            z[k + 1] = -self.upper[k] * z[k]
        return z / np.linalg.norm(z)

    def solve(self, b: np.ndarray) -> np.ndarray:
        """The solution of ``N G N' y = b``."""
        y, r = b.astype(np.float64), self.at
        for k in range(r):
            y[k + 1] -= self.lower[k] * y[k]
        for k in range(len(y) - 1, r, -1):
            y[k - 1] -= self.upper[k - 1] * y[k]
        y[:r] /= self.top[:r]
        y[r + 1 :] /= self.bottom[r + 1 :]
        y[r] /= self.gamma
        for k in range(r - 1, -1, -1):
            y[k] -= self.lower[k] * y[k + 1]
        for k in range(r, len(y) - 1):
            y[k + 1] -= self.upper[k] * y[k]
        return y


def _block_vectors(diagonal: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values (falling) and vectors (columns) of ``B' B`` for one bidiagonal B without zero couplings."""
    values = squared_singular_values(diagonal, above)
    n, scale = len(values), max(float(np.abs(diagonal).max()), float(np.abs(above).max(initial=0.0)))
    safe = np.where(np.abs(diagonal) < _EPS * _EPS * scale, _EPS * _EPS * scale, diagonal)
    q, ratios = safe**2, above / safe[:-1]
    vectors = np.zeros((n, n))
    first = 0
    for j in range(n):
        if j and values[j - 1] - values[j] > CLUSTER * values[j - 1]:
            first = j
        near = vectors[:, first:j]
        factors = Twisted.factor(q, ratios, float(values[j]))
        z = factors.vector()
        # Alone, the twisted vector is the eigenvector. In a cluster it is a start among the others.
        alone = j == first and (j + 1 == n or values[j] - values[j + 1] > CLUSTER * values[j])
        if not alone and np.isfinite(z).all():
            for _ in range(4):
                z = z - near @ (near.T @ z)
                z = z - near @ (near.T @ z)
                if np.linalg.norm(z) < 0.1:
                    z = np.random.default_rng(j).standard_normal(n)
                    z -= near @ (near.T @ z)
                z = factors.solve(z / np.linalg.norm(z))
                z /= np.abs(z).max()
                z /= np.linalg.norm(z)
            z = z - near @ (near.T @ z)
            z = z - near @ (near.T @ z)
        vectors[:, j] = z / np.linalg.norm(z)
    return values, vectors


def principal_axes(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of ``r`` (falling) and right singular vectors as columns.

    The largest entry of a vector is positive. Vectors of value zero complete the basis."""
    diagonal, above, w = bidiagonalise(r)
    d = len(diagonal)
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    cuts = np.flatnonzero(np.abs(above) <= _EPS * _EPS * scale) + 1
    values, vectors = np.zeros(d), np.zeros((d, d))
    for first, end in zip(np.r_[0, cuts], np.r_[cuts, d]):
        values[first:end], vectors[first:end, first:end] = _block_vectors(
            diagonal[first:end], above[first : end - 1]
        )
    order = np.argsort(-values, kind="stable")
    vectors = w @ vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)])
    return values[order], vectors * signs


# --- over a table ----------------------------------------------------------------------


def usable(embedding: Column) -> Column:
    """Whether a vector is there and holds finite entries only; a vector without entries is not usable."""
    fine = F.forall(embedding, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(fine & (F.size(embedding) > 0), F.lit(False))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The integer entries of a batch of vectors, a row each."""
    lists = column(batch, name)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * SCALE)
    if len(scaled) and np.abs(scaled).max() > 2**52:
        raise OverflowError(f"entries of {name} are too large for exact integers")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and sizes.min() != sizes.max():
        raise ValueError(f"vectors of {sizes.min()} and of {sizes.max()} entries in {name}")
    return scaled.astype(np.int64).reshape(len(sizes), -1) + OFFSET


@dataclass
class Whitening:
    """Fitted on ``n`` vectors: exact sums per dimension, eigenvalues and unit eigenvectors of the covariance."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    axes: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Exact ``n x - S``."""
        if self.n * float(np.abs(x).max(initial=0)) > _LONG_LIMIT:
            raise OverflowError(f"n x leaves 64 bits at {self.n} vectors")
        return self.n * x - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n) @ self.axes / np.sqrt(self.eigenvalues)


def _sums(vectors: DataFrame, name: str) -> tuple[int, np.ndarray]:
    """The number of vectors and their exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, name)
            if len(x):
                totals = pa.array(x.sum(axis=0))
                at = pa.array(np.arange(x.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([at, totals, pa.array(np.full(x.shape[1], len(x)))], names=["at", "total", "n"])

    rows = (
        vectors.mapInArrow(run, "at int, total bigint, n bigint")
        .groupBy("at")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .collect()  # one row per dimension
    )
    rows.sort(key=lambda r: r["at"])
    if len({r["n"] for r in rows}) > 1:
        raise ValueError(f"vectors of several lengths in {name}")
    return (rows[0]["n"] if rows else 0), np.array([r["total"] for r in rows], np.int64)


def _stacked(r: np.ndarray | None, block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block if r is None else np.concatenate([r, block]), mode="r")


def _triangle(vectors: DataFrame, name: str, start: Whitening) -> np.ndarray:
    """R of all centred rows."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.slice(first, BLOCK_ROWS), name)
                r = _stacked(r, start.centred(x) / start.n)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    d = len(start.sums)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        r = None
        for raw in group["r"]:
            r = _stacked(r, np.frombuffer(raw).reshape(-1, d))
        return pd.DataFrame({"r": [r.tobytes()]})

    left = vectors.mapInArrow(reduce, "r binary").checkpoint()
    n = left.count()
    while n > 1:
        numbered = left.withColumn("_id", F.monotonically_increasing_id())
        groups = -(-n // FAN_IN)
        # A running number deals the triangles out evenly; a hash of it may not.
        numbered = numbered.withColumn("_group", F.pmod(F.xxhash64("_id"), F.lit(groups)))
        left = numbered.groupBy("_group").applyInPandas(merge, "r binary").checkpoint()
        n = left.count()
    r = np.frombuffer(left.first()["r"]).reshape(-1, d)
    return np.concatenate([r, np.zeros((d - len(r), d))])


def _identity_error(vectors: DataFrame, name: str, model: Whitening) -> float:
    """Largest absolute entry of the whitened covariance minus the identity, over all rows."""
    k = len(model.eigenvalues)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.whitened(model.centred(_matrix(batch, name)))
            total[0] += w.sum(axis=0)
            total[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "total"])

    rows = vectors.mapInArrow(moments, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    total = np.zeros((k + 1) * k)
    for r in rows:
        total[r["at"]] = r["total"]
    mean, products = total[:k] / model.n, total[k:].reshape(k, k) / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def fit(vectors: DataFrame, embedding_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable vectors (`usable`) of a table.

    Components whose eigenvalue is zero up to rounding cannot be whitened and are left out, so fewer
    than ``components`` may come back; none for an empty table or for equal vectors. All vectors
    must have the same number of entries. Repeated rows count each time.
    """
    spark = vectors.sparkSession
    narrow = vectors.select(F.col(f"`{embedding_col}`").alias("embedding")).where(usable(F.col("embedding")))
    n, sums = _sums(narrow, "embedding")
    d = len(sums)
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    if not n:
        return model
    values, axes = principal_axes(_triangle(narrow, "embedding", model))
    eigenvalues = values / n
    model.trace = float(eigenvalues.sum())
    positive = values > (_EPS * max(n, d)) ** 2 * values[0] if values[0] > 0 else np.zeros(d, bool)
    kept = np.flatnonzero(positive)[:components]
    model.eigenvalues, model.axes = eigenvalues[kept], axes[:, kept]
    model.identity_error = _identity_error(narrow, "embedding", model)
    return model


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", embedding_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    ``deviation`` is the exact sum over dimensions of ``(n x - S)^2``; a sum beyond 64 bits stops
    the run instead of wrapping. ``explained`` is the eigenvalue's share of the trace. Vectors that
    are null or hold null or non-finite entries have no rows; a null id is passed on, repeated rows
    stay, other columns are left out whatever their names, and an empty table gives no rows. Rows
    with equal vectors get equal values. Nothing is shuffled.
    """
    narrow = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{embedding_col}`").alias("embedding"))
    narrow = narrow.where(usable(F.col("embedding")))
    k = len(model.eigenvalues)
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = T.StructType(
        [T.StructField(id_col, narrow.schema["id"].dataType)]
        + T.StructType.fromDDL(
            "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        ).fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                centred = model.centred(_matrix(part, "embedding"))
                if len(centred) and (centred.astype(np.float64) ** 2).sum(axis=1).max() > _LONG_LIMIT:
                    raise OverflowError(f"deviations leave 64 bits at {model.n} vectors")
                rows = np.repeat(np.arange(part.num_rows), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "id").take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1), part.num_rows), pa.int32()),
                        pa.array(np.full(len(rows), model.n)),
                        pa.array(np.repeat((centred**2).sum(axis=1), k)),
                        pa.array(model.whitened(centred).ravel()),
                        pa.array(np.tile(model.eigenvalues / (model.trace or 1.0), part.num_rows)),
                        pa.array(np.full(len(rows), model.identity_error)),
                    ],
                    names=names,
                )

    return narrow.mapInArrow(run, schema)
