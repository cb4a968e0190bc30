"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Vectors become integers, x = floor(64 c) + 1000000, so counts, sums and deviations are exact. A second pass adds up the products of the centred vectors. The scatter, one
square matrix whose size follows from the dimensions alone, is factored on the driver: P^T C P = L L^T by
Cholesky with pivots, then the columns of L are rotated in pairs until they are orthogonal. Their squared
norms are the eigenvalues, the normalised columns, rows put back in place, the components.

Defined cases: rows whose vector is null or empty, holds a null or non-finite entry, or an entry of 2^34 and
more in size (x would not stay exact) take no part; of vectors of several lengths only the most frequent
length does (the longer of equally frequent ones); null and repeated ids are kept row by row; a component
whose pivot is below 1e-12 of the largest is no component, so fewer than asked may come back, none for a
single or constant vector; a deviation beyond a long is null; an empty table gives an empty result; other
columns stay, those named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.session import materialise

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 34
COMPONENTS = 32
RANK_TOLERANCE = 1e-12
OUT = ["x", "n", "deviation", "whitened"]


@dataclass(frozen=True)
class Whitening:
    """A fit: rows, exact sums per dimension, components as rows with falling eigenvalues, trace of the
    covariance."""
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def integers(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows that take part, with `x`, an array of longs."""
    c = F.col(f"`{column}`").cast("array<double>")
    fine = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: F.coalesce(F.abs(v) < LARGEST, F.lit(False)))
    kept = rows.select(*[F.col(f"`{name}`") for name in rows.columns if name.lower() not in OUT],
                       F.when(fine, F.transform(c, lambda v: F.floor(v * SCALE) + F.lit(SHIFT))).alias("x"))
    kept = materialise(kept.where("x is not null"), "integers")
    sizes = kept.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return kept if top is None else kept.where(F.size("x") == top["size"])


def _matrix(column, kind) -> np.ndarray:
    return column.flatten().to_numpy().astype(kind).reshape(len(column), -1)


def totals(rows: DataFrame, column: str) -> tuple[int, list]:
    """(rows, sum per dimension) of an array column; exact for longs. One short row per batch is shuffled."""
    whole = isinstance(rows.schema[column].dataType.elementType, T.LongType)
    kind, arrow, name = ("<i8", pa.int64(), "bigint") if whole else ("<f8", pa.float64(), "double")

    def run(batches):
        for batch in batches:
            if len(batch):
                sums = _matrix(batch.column(0), kind).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([sums], pa.list_(arrow))],
                                                 ["n", "sums"])
    part = rows.select(column).mapInArrow(run, f"n bigint, sums array<{name}>")
    found = part.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()
    return (found[0]["n"], [r["s"] for r in found]) if found else (0, [])


def _centred(values: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Vectors less their mean; of longs the whole part of the mean is taken off first, without rounding."""
    return (values - sums // n) - sums % n / n if values.dtype.kind == "i" else values - sums / n


def _deviations(values: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n x - S)^2, exact; null beyond a long."""
    near, rest = values - sums // n, sums % n
    if ((float(np.abs(near).max(initial=0)) + 1) * n) ** 2 * values.shape[1] < 2.0 ** 62:
        u = near * n - rest
        return pa.array((u * u).sum(axis=1))
    about = ((near * float(n) - rest) ** 2).sum(axis=1)
    exact = [sum((v * n - r) ** 2 for v, r in zip(row, rest.tolist())) if a < 2.0 ** 64 else 1 << 64
             for row, a in zip(near.tolist(), about)]
    return pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())


def scatter(rows: DataFrame, column: str, n: int, sums: list) -> np.ndarray:
    """Sum of the products of the centred vectors, added up per task and then by entry."""
    whole = isinstance(rows.schema[column].dataType.elementType, T.LongType)
    kind, mean, d = "<i8" if whole else "<f8", np.array(sums), len(sums)

    def run(batches):
        total = np.zeros((d, d))
        for batch in (b for b in batches if len(b)):
            z = _centred(_matrix(batch.column(0), kind), n, mean)
            total += z.T @ z
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total[np.triu_indices(d)]], pa.list_(pa.float64()))], ["m"])
    part = rows.select(column).mapInArrow(run, "m array<double>")
    out = np.zeros(d * (d + 1) // 2)
    for at, value in part.select(F.posexplode("m").alias("at", "v")).groupBy("at").agg(F.sum("v")).collect():
        out[at] = value
    full = np.zeros((d, d))
    full[np.triu_indices(d)] = out
    return full + np.triu(full, 1).T


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor with as many columns as the rank, pivots): matrix[pivots][:, pivots] = factor @ factor.T."""
    rest, d = matrix.copy(), len(matrix)
    pivots, factor = np.arange(d), np.zeros((d, d))
    largest = rest.diagonal().max(initial=0.0)
    for k in range(d):
        j = k + int(rest.diagonal()[k:].argmax())
        if rest[j, j] <= RANK_TOLERANCE * largest:
            return factor[:, :k], pivots
        for swap in (rest, rest.T, factor, pivots):
            swap[[k, j]] = swap[[j, k]]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1:, k] = rest[k + 1:, k] / factor[k, k]
        rest[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, pivots


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of `factor` rotated in pairs until all are orthogonal. A sweep meets every pair once; the
    pairs of a round share no column and turn together."""
    a, r = factor.copy(), factor.shape[1]
    wheel = np.arange(r + r % 2)
    limit = np.finfo(float).eps * np.sqrt(len(a))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(wheel) - 1):
            p, q = wheel[:len(wheel) // 2], wheel[:len(wheel) // 2 - 1:-1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            left, right = a[:, p], a[:, q]
            aa, bb, ab = ((x * y).sum(axis=0) for x, y in ((left, left), (right, right), (left, right)))
            with np.errstate(all="ignore"):
                skew = np.abs(ab) / np.sqrt(aa * bb)
                zeta = (bb - aa) / (2 * ab)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(skew > limit, t, 0.0)
            worst = max(worst, float(np.nan_to_num(skew).max(initial=0.0)))
            c = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = c * left - c * t * right, c * t * left + c * right
            wheel = np.concatenate([wheel[:1], wheel[-1:], wheel[1:-1]])
        if worst <= limit:
            break
    return a


def decompose(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as rows) of a scatter; each has its largest entry positive."""
    factor, pivots = pivoted_cholesky(matrix)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    vectors = np.empty((len(order), len(matrix)))
    vectors[:, pivots] = (turned / norms)[:, order].T
    peak = np.abs(vectors).argmax(axis=1)
    return norms[order] ** 2, vectors * np.sign(vectors[np.arange(len(order)), peak])[:, None]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From all rows of `integers`; None without any."""
    n, sums = totals(rows, "x")
    if not n:
        return None
    matrix = scatter(rows, "x", n, sums)
    values, vectors = decompose(matrix)
    return Whitening(n, np.array(sums), vectors[:components], values[:components] / n, float(np.trace(matrix)) / n)


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """Adds `n`, `deviation` and `whitened`, an array with one entry per component."""
    turn = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    n, sums, names = model.n, model.sums, [f"_c{k}" for k in range(len(rows.columns))]
    kind = T.StructType([*rows.toDF(*names).schema.fields, T.StructField("deviation", T.LongType()),
                         T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    at, named = rows.columns.index("x"), [*names, "deviation", "whitened"]

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(at), "<i8")
            white = _centred(x, n, sums) @ turn
            ends = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _deviations(x, n, sums),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))], named)
    done = rows.toDF(*names).mapInArrow(run, kind)
    return done.select(*[F.col(a).alias(c) for c, a in zip(rows.columns, names)], F.lit(n).cast("bigint").alias("n"),
                       "deviation", "whitened")


def identity_error(whitened: DataFrame) -> float:
    """The largest entry of the covariance of `whitened` minus the identity."""
    n, sums = totals(whitened, "whitened")
    if not sums:
        return 0.0
    return float(np.abs(scatter(whitened, "whitened", n, sums) / n - np.eye(len(sums))).max())


def whiten(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """All columns of the rows that take part, once per component: component, n, deviation, whitened,
    explained, identity_error."""
    points = integers(rows, column)
    own = [F.col(f"`{c}`") for c in points.columns if c.lower() not in
           {*OUT, "component", "explained", "identity_error"}]
    model = fit(points, components)
    if model is None or not len(model.eigenvalues):
        return points.where("false").select(
            *own, *[F.lit(None).cast(kind).alias(name) for name, kind in (
                ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                ("explained", "double"), ("identity_error", "double"))])
    done = materialise(apply(points, model), "whitened")
    error = identity_error(done)
    long = done.select(*own, "n", "deviation", F.posexplode("whitened").alias("_at", "_w"))
    shares = F.array(*map(F.lit, model.explained))
    return long.select(*own, (F.col("_at") + 1).alias("component"), "n", "deviation", F.col("_w").alias("whitened"),
                       F.get(shares, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"))
