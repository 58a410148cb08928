"""Embedding whitening: Welford's updates in partitions, merged in parallel, then a symmetric QR eigen-solve.

A partition reads its vectors once and holds a count, a mean and the sums of
products about that mean, brought up to date by a rank-one term for each vector.
Two such states merge exactly into that of both, so partitions merge in rounds of
bounded fan-in and the driver gets a few states, each of the vectors' length
squared. Nothing is summed about zero, so means far above the spread lose no digits.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.llm.forest import finite, matrix
from heddle.plans.durable import Scratch
from heddle.sources import table

#: States that one task merges, and that the driver does.
FAN_IN = 32
#: Rank-one terms applied in one product of matrices.
TERMS = 256
COMPONENTS = 8
#: Components whose share of the largest eigenvalue is less have no scale to divide by.
LEAST_SHARE = 1e-12
STATE = "key long, n long, mean binary, products binary, sums array<decimal(38,0)>"


@dataclass
class Moments:
    """Count, mean, sums of products about the mean, and exact sums of vectors of whole numbers."""

    n: int
    mean: np.ndarray
    products: np.ndarray
    sums: list[int]

    @classmethod
    def none(cls, dim: int) -> "Moments":
        return cls(0, np.zeros(dim), np.zeros((dim, dim)), [0] * dim)

    def update(self, rows: np.ndarray) -> None:
        """Welford's update by each row in turn.

        Row i adds (x_i - m_{i-1})(x_i - m_i)', that is (1 - 1 / n_i) d_i d_i' with
        d_i = x_i - m_{i-1}; the terms of some rows are one product of matrices.
        """
        for at in range(0, len(rows), TERMS):
            some = rows[at : at + TERMS].astype(np.float64)
            if not self.n:
                self.mean = some[0].copy()
            n = self.n + np.arange(1, len(some) + 1)[:, None]
            moved = some - self.mean
            means = np.cumsum(moved, axis=0) / n  # after each row, less the mean at hand
            d = moved.copy()
            d[1:] -= means[:-1]
            self.products += (d * (1 - 1 / n)).T @ d
            self.mean = self.mean + means[-1]
            self.n += len(some)
        if rows.dtype.kind == "i":
            high, low = rows >> 32, rows & 0xFFFFFFFF
            self.sums = [s + (int(h) << 32) + int(w) for s, h, w in zip(self.sums, high.sum(axis=0), low.sum(axis=0))]

    def merge(self, other: "Moments") -> "Moments":
        """The state of both: products add up, and so does the step between the means."""
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        step = other.mean - self.mean
        products = self.products + other.products + np.outer(step, step) * (self.n * other.n / n)
        return Moments(n, self.mean + step * (other.n / n), products, [a + b for a, b in zip(self.sums, other.sums)])

    def row(self, key: int) -> dict:
        return {"key": key, "n": self.n, "mean": self.mean.tobytes(), "products": self.products.tobytes(), "sums": self.sums}

    @classmethod
    def of_rows(cls, batch: pa.RecordBatch | pa.Table) -> "Moments":
        held = None
        for r in batch.to_pylist():
            mean = np.frombuffer(r["mean"])
            one = cls(r["n"], mean, np.frombuffer(r["products"]).reshape(len(mean), -1), [int(s) for s in r["sums"]])
            held = one if held is None else held.merge(one)
        return held


def _states(rows: list[dict]) -> pa.RecordBatch:
    from decimal import Decimal

    schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("products", pa.binary()), ("sums", pa.list_(pa.decimal128(38, 0)))])
    return pa.RecordBatch.from_pylist([r | {"sums": [Decimal(s) for s in r["sums"]]} for r in rows], schema=schema)


def whole(vectors: np.ndarray, scale: int, shift: int) -> np.ndarray:
    """floor(scale * c) + shift for each component c."""
    return np.floor(scale * vectors).astype(np.int64) + shift


def moments(vectors: DataFrame, dim: int, scratch: Scratch, scale: int | None = None, shift: int = 0) -> Moments:
    """The moments of ``vectors(v)``, all of length ``dim``; with ``scale``, of their whole numbers."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Moments.none(dim)
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(0))
                held.update(rows if scale is None else whole(rows, scale, shift))
        if held.n:
            yield _states([held.row(TaskContext.get().partitionId())])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Moments.none(dim)
        for batch in batches:
            held = held.merge(Moments.of_rows(batch)) if batch.num_rows else held
        yield _states([held.row(key[0].as_py())])

    states = scratch.keep(vectors.select("v").mapInArrow(stream, STATE), "states")
    most = states.agg(F.max("key")).first()[0]
    while most is not None and most >= FAN_IN:
        states = scratch.keep(states.withColumn("key", F.floor(F.col("key") / FAN_IN)).groupBy("key").applyInArrow(merge, STATE), "states")
        most //= FAN_IN
    return Moments.of_rows(states.orderBy("key").toArrow()) or Moments.none(dim)


def _tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with q' a q tridiagonal, by Householder's reflections."""
    a, n = a.copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if not np.any(x[1:]):
            continue
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        a[k + 1 :, :] -= 2 * np.outer(v, v @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def symmetric_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix.

    Householder's reflections make it tridiagonal; implicit QR steps with
    Wilkinson's shift then chase the off-diagonal to zero from below.
    """
    scale = np.abs(a).max(initial=0.0)
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    d, e, q = _tridiagonal((a + a.T) / (2 * scale))
    end, steps = len(d) - 1, 0
    while end > 0:
        small = np.abs(e[:end]) <= np.finfo(np.float64).eps * (np.abs(d[:end]) + np.abs(d[1 : end + 1]))
        e[:end][small] = 0
        if e[end - 1] == 0:
            end, steps = end - 1, 0
            continue
        zeros = np.flatnonzero(e[:end] == 0)
        begin = int(zeros[-1]) + 1 if len(zeros) else 0
        steps += 1
        if steps > 200:
            raise ArithmeticError("symmetric_eigen: an eigenvalue did not converge")
        half = (d[end - 1] - d[end]) / 2
        shift = d[end] - e[end - 1] ** 2 / (half + np.copysign(np.hypot(half, e[end - 1]), half)) if half or e[end - 1] else d[end]
        x, z = d[begin] - shift, e[begin]
        for k in range(begin, end):
            r = np.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > begin:
                e[k - 1] = r
            low, high, off = d[k], d[k + 1], e[k]
            d[k] = c * c * low + 2 * c * s * off + s * s * high
            d[k + 1] = s * s * low - 2 * c * s * off + c * c * high
            e[k] = c * s * (high - low) + (c * c - s * s) * off
            x = e[k]
            if k + 1 < end:
                z, e[k + 1] = s * e[k + 1], c * e[k + 1]
            q[:, [k, k + 1]] = np.column_stack((c * q[:, k] + s * q[:, k + 1], c * q[:, k + 1] - s * q[:, k]))
    order = np.argsort(-d, kind="stable")
    return d[order] * scale, q[:, order]


@dataclass
class Whitening:
    """What whitens a vector: the fitted moments, unit components as columns and their eigenvalues."""

    fitted: Moments
    components: np.ndarray
    values: np.ndarray

    @classmethod
    def fit(cls, fitted: Moments, most: int | None = None) -> "Whitening":
        values, vectors = symmetric_eigen(fitted.products / max(fitted.n, 1))
        return cls(fitted, vectors[:, :most], values[:most])

    @property
    def explained(self) -> list[float | None]:
        total = float(np.trace(self.fitted.products)) / max(self.fitted.n, 1)
        return [float(max(v, 0.0)) / total if total > 0 else None for v in self.values]

    @property
    def sound(self) -> np.ndarray:
        """Which components have a spread to divide by."""
        return (self.values > 0) & (self.values > LEAST_SHARE * max(self.values.max(initial=0.0), 0.0))

    def __call__(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values of centred rows; not a number where a component has no spread."""
        scaled = np.where(self.sound, 1 / np.sqrt(np.where(self.sound, self.values, 1)), np.nan)
        return centred @ self.components * scaled

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """The exact sum over components of (n * x - sum)^2 of each row; None where that is beyond a long."""
        n, sums = self.fitted.n, np.array(self.fitted.sums, dtype=object)
        high = max((abs(int(x)) for x in (rows.max(initial=0), rows.min(initial=0))), default=0)
        most = n * high + max(map(abs, self.fitted.sums), default=0)
        if most < 2**62:  # differences fit a long; their squares may not
            apart = n * rows - np.array(self.fitted.sums, dtype=np.int64)
            if rows.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 < 2**63:
                return (apart * apart).sum(axis=1).tolist()
        exact = [int(((n * row.astype(object) - sums) ** 2).sum()) for row in rows]
        return [x if x < 2**63 else None for x in exact]


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int | None = None, shift: int = 0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    The fit list is all usable rows: those whose vector isn't null or empty and
    has no null or non-finite entry. With ``scale`` an entry c counts as the whole
    number floor(scale * c) + shift, rows with one beyond 2^62 aren't usable, and
    ``deviation`` is exact (null beyond a long, and without ``scale``). Vectors of
    each length are whitened by themselves. Components without spread, of which
    there are more than none if rows are few or alike, have a null ``whitened``.
    ``identity_error`` is measured on the whitened values: the largest absolute
    entry of their covariance minus the identity, over components with spread (null
    if none has). Rows that repeat an id, or have none, stay rows of their own;
    other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(finite(F.col("v")))
    if scale is not None:
        rows = rows.where(F.forall("v", lambda x: F.abs(x * scale + shift) < float(2**62)))
    found = None
    for dim in sorted(r[0] for r in rows.select(F.size("v")).distinct().collect()):
        one = _whitened(rows.where(F.size("v") == dim), dim, components, scale, shift, scratch)
        found = one if found is None else found.unionByName(one)
    if found is None:
        empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    return found


def _whitened(rows: DataFrame, dim: int, components: int, scale: int | None, shift: int, scratch: Scratch) -> DataFrame:
    model = Whitening.fit(moments(rows, dim, scratch, scale, shift), components)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            entries = matrix(batch.column(1))
            if scale is None:
                centred, deviation = entries - model.fitted.mean, [None] * len(entries)
            else:
                entries = whole(entries, scale, shift)
                # the mean of whole numbers is exact up to its last rounding
                centred, deviation = entries - np.array([s / model.fitted.n for s in model.fitted.sums]), model.deviations(entries)
            white = model(centred)
            flat = pa.array(white.ravel(), from_pandas=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, type=pa.int64()), lists], names=["vec_id", "deviation", "white"])

    kept = scratch.keep(rows.select("vec_id", "v").mapInArrow(project, "vec_id long, deviation long, white array<double>"), "white")
    sound = [int(i) for i in np.flatnonzero(model.sound)]
    error = None
    if sound:
        told = moments(kept.select(F.array(*(F.col("white")[i] for i in sound)).alias("v")), len(sound), scratch)
        error = float(np.abs(told.products / told.n - np.eye(len(sound))).max())
    shares = F.array(*(F.lit(x).cast("double") for x in model.explained))
    long = kept.select("vec_id", "deviation", F.posexplode("white").alias("place", "whitened"))
    return long.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, "place").alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, in steps of 1/1024, whitened on their first eight components."""
    return whiten(table(spark, sf_dir, "embeddings"), COMPONENTS, scale=1024, shift=100_000)


QUERIES = {"op12_whitening": op12_whitening}
ORACLE_SQL: dict[str, str] = {}
