"""Operator 12, whitening of embeddings by an incremental eigendecomposition that partitions build and combine."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import Scratch

#: Embedding entries are taken in whole steps of 1 / STEPS.
STEPS = 256
COMPONENTS = 4
#: Tasks' results that are combined in one place.
FAN = 16
EPS = np.finfo(float).eps
LARGEST = 2.0**63 * (1 - 1e-9)


# --- rank-one updates


@cache
def _below(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Ones where a pole stands at or below a root, and where above it."""
    below = np.tril(np.ones((m, m)))
    return below, 1 - below


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho * sum(z2 / (d - x)), one between each two neighbours of ``d`` (ascending, apart) and one beyond
    the last: the pole next to each, and the distance from it, so that no digits are lost near a pole.

    All roots go on together, from the middles of their intervals: rational interpolation from both sides, which doubles
    the right digits with each step, or a halving of the bracket where that leaves it.
    """
    m = len(d)
    weights, (below, above) = rho * z2, _below(m)
    poles = d - d[:, None]
    gap = np.append(np.diff(d), weights.sum())
    near, x, low, high = np.arange(m), gap / 2, np.zeros(m), gap.copy()
    own, after = np.zeros(m), np.append(gap[:-1], 0.0)
    for turn in range(60):
        away = poles - x[:, None]
        terms = weights / away
        slopes = terms / away
        psi, phi = np.einsum("ij,ij->i", terms, below), np.einsum("ij,ij->i", terms, above)
        psi1, phi1 = np.einsum("ij,ij->i", slopes, below), np.einsum("ij,ij->i", slopes, above)
        up = 1 + psi + phi < 0
        low, high = np.where(up, x, low), np.where(up, high, x)
        if not turn:  # roots of the right half are measured from the pole on their right
            right = up.copy()
            right[-1] = False
            near += right
            shift = np.where(right, gap, 0.0)
            poles, x, low, high, own, after = poles[near], x - shift, np.where(right, -gap / 2, low), np.where(right, 0.0, high), -shift, np.where(right, 0.0, after)
        a0, b0 = own - x, after - x
        q, s = psi1 * a0 * a0, phi1 * b0 * b0
        c = 1 + psi - psi1 * a0 + phi - phi1 * b0
        with np.errstate(all="ignore"):
            linear, free = c * (own + after) + q + s, c * own * after + q * after + s * own
            root = np.sqrt(np.maximum(linear * linear - 4 * c * free, 0))
            new = np.where(linear > 0, 2 * free / (linear + root), (linear - root) / (2 * c))
            new[-1] = own[-1] + q[-1] / c[-1]
        near_enough = np.abs(new - x) <= 1e-9 * np.abs(x)
        new = np.where(near_enough | (new > low) & (new < high), new, (low + high) / 2)
        done = (near_enough | (high - low <= 2 * EPS * np.abs(new))).all()
        x = new
        if done:
            break
    return near, x


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of u diag(d) u' + rho v v', for rho of 0 or more.

    Deflation: a direction without a share in v keeps its eigenpair, and of directions of one eigenvalue a reflection
    leaves a single one with a share. The others' eigenvalues solve the secular equation; the shares are computed anew from
    these, which keeps the eigenvectors orthogonal.
    """
    z = u.T @ v
    scale = max(abs(d[0]), abs(d[-1]), rho * (z @ z))
    if rho * (z @ z) <= EPS * scale:
        return d, u
    tiny = 8 * EPS * scale
    u, d = u.copy(), d.copy()
    begins = np.flatnonzero(np.r_[True, np.diff(d) > tiny])
    for a, b in zip(begins, np.r_[begins[1:], len(d)], strict=True):
        if b - a > 1:
            w = z[a:b].copy()
            size = np.linalg.norm(w)
            if size * size * rho <= tiny:
                continue
            w[-1] += np.copysign(size, w[-1])
            u[:, a:b] -= np.outer(u[:, a:b] @ w, 2 / (w @ w) * w)
            z[a : b - 1], z[b - 1] = 0.0, -np.copysign(size, z[b - 1])
    kept = np.flatnonzero(rho * np.abs(z) * np.linalg.norm(z) > tiny)
    if not len(kept):
        return d, u
    dk, zk = d[kept], z[kept]
    near, x = secular_roots(dk, zk * zk, rho)
    over = x[:, None] + (dk[near][:, None] - dk)  # root i less pole j
    apart = dk[:, None] - dk
    # Each root but the last goes with the pole next to it that isn't j.
    beside = np.where(_below(len(dk))[1][:-1] > 0, apart[:-1], apart[1:])
    share = np.sqrt(np.abs((over[:-1] / beside).prod(0) * over[-1])) * np.sign(zk)
    vectors = share / over
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    d[kept] = dk[near] + x
    u[:, kept] = u[:, kept] @ vectors.T
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


class Spectrum:
    """Count, sums, mean, and the eigendecomposition of the scatter (n times the covariance) of the rows added so far."""

    def __init__(self, width: int):
        self.n, self.sums, self.mean = 0, np.zeros(width, np.int64), np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, row: np.ndarray) -> None:
        """A centred rank-one update by one row."""
        apart = row - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n / (self.n + 1))
        self.n += 1
        self.sums += row
        self.mean += apart / self.n

    def merge(self, other: Spectrum) -> None:
        """Adds the other's rows: a rank-one update for each of its eigenvectors and one for the means' distance."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            self.values, self.vectors = rank_one(self.values, self.vectors, vector, max(value, 0.0))
        apart = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * other.n / (self.n + other.n))
        self.mean += apart * (other.n / (self.n + other.n))
        self.n += other.n
        self.sums += other.sums

    def packed(self) -> dict:
        return {"n": self.n, "sums": self.sums.tobytes(), "mean": self.mean.tobytes(), "eigenvalues": self.values.tobytes(), "eigenvectors": self.vectors.tobytes()}

    @staticmethod
    def unpacked(row) -> Spectrum:
        own = Spectrum(0)
        own.n, own.sums = int(row["n"]), np.frombuffer(row["sums"], np.int64).copy()
        own.mean, own.values = np.frombuffer(row["mean"]).copy(), np.frombuffer(row["eigenvalues"]).copy()
        own.vectors = np.frombuffer(row["eigenvectors"]).reshape(len(own.mean), -1).copy()
        return own


# --- distributed steps

SPECTRUM = "n long, sums binary, mean binary, eigenvalues binary, eigenvectors binary"


def _combined(df: DataFrame, combine, schema: str, tasks: int) -> DataFrame:
    """Rows of tasks brought together FAN at a time until one is left."""
    df = df.select(F.spark_partition_id().alias("task"), *df.columns)
    while True:
        df = df.withColumn("task", F.floor(F.col("task") / FAN).cast("int")).groupBy("task").applyInPandas(combine, f"task int, {schema}")
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            return df.drop("task")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def spectrum(fit: DataFrame, width: int) -> Spectrum:
    """The spectrum of the rows (x array<long> of ``width``): each task updates its own by rank one a row, and tasks'
    spectra are merged in a tree. A task holds two matrices of width x width whatever its rows."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(width)
        for batch in batches:
            for row in _matrix(batch.column(0), width):
                own.add(row)
        if own.n:
            yield pa.RecordBatch.from_pylist([own.packed()])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        rows = part.sort_values("mean").to_dict("records")
        own = Spectrum.unpacked(rows[0])
        for row in rows[1:]:
            own.merge(Spectrum.unpacked(row))
        return pd.DataFrame([{"task": part["task"].iloc[0]} | own.packed()])

    found = _combined(fit.select("x").mapInArrow(update, SPECTRUM), merge, SPECTRUM, fit.rdd.getNumPartitions()).collect()
    return Spectrum.unpacked(found[0]) if found else Spectrum(width)


def projected_covariance(fit: DataFrame, basis: np.ndarray, n: int, sums: np.ndarray, scale: np.ndarray | None = None) -> np.ndarray:
    """The covariance (divisor n, centred first) of the rows projected on the columns of ``basis``, each divided by
    ``scale``. Tasks add up their own products, and sums of tasks are added in a tree."""
    width, k = basis.shape
    mean = sums / n
    scale = np.ones(k) if scale is None else scale

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first, rows = np.zeros((k, k)), np.zeros(k), 0
        for batch in batches:
            y = (_matrix(batch.column(0), width) - mean) @ basis / scale
            total += y.T @ y
            first += y.sum(0)
            rows += len(y)
        if rows:
            yield pa.RecordBatch.from_pylist([{"first": first.tobytes(), "total": total.tobytes()}])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"task": [part["task"].iloc[0]], **{c: [sum(np.frombuffer(b) for b in sorted(part[c])).tobytes()] for c in ("first", "total")}})

    schema = "first binary, total binary"
    row = _combined(fit.select("x").mapInArrow(products, schema), add, schema, fit.rdd.getNumPartitions()).first()
    first = np.frombuffer(row.first) / n
    return np.frombuffer(row.total).reshape(k, k) / n - np.outer(first, first)


def usable(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) whose vector has entries and all of them are finite, as vec_id and x (whole steps)."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.filter(F.size("embedding") > 0).filter(finite).select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * STEPS).cast("long")).alias("x"))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Embeddings (vec_id, embedding) whitened on their first components: a row for each row and component, with vec_id,
    component, n, deviation, whitened, explained and identity_error.

    Entries become whole steps x = floor(256 c). The components are the unit eigenvectors of the covariance of the distinct
    x, n in number, by falling eigenvalue. deviation is the exact sum of (n x - S)^2, null where it doesn't fit into a long;
    whitened is x - S/n on the component over the root of the eigenvalue; explained is its share of the trace;
    identity_error is the largest deviation of whitened's own covariance from the identity.

    Rows whose vector is null, empty or holds null or non-finite entries are left out, and so are those of another length
    than most rows have (of equally frequent lengths the smallest counts). Repeated rows all come back. Components without
    variance have no whitened value and are left out, so that a table of equal vectors gives no rows, as an empty one does.
    Other columns are not read.

    Three passes over the distinct vectors: spectra by rank-one updates a row in each task, merged in a tree; then a
    Rayleigh-Ritz step, the covariance in the basis so found, whose own eigenvectors turn that basis; then the audit. What
    reaches the driver has the size of the covariance.
    """
    own = Scratch(embeddings.sparkSession, "whitening")
    rows = own.table(usable(embeddings))
    lengths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "width").first()
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        own.clear()
        return embeddings.sparkSession.createDataFrame([], schema)
    width = lengths.width
    rows = rows.filter(F.size("x") == width)
    fit = own.table(rows.select("x").distinct())
    found = spectrum(fit, width)
    n, sums = found.n, found.sums
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]
    ritz = projected_covariance(fit, basis, n, sums)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], basis @ turn[:, ::-1]
    trace = np.trace(ritz)
    k = int(min(components, np.count_nonzero(values > width * EPS * max(trace, 0)))) if n > 1 else 0
    if not k:
        own.clear()
        return embeddings.sparkSession.createDataFrame([], schema)
    vectors, roots = vectors[:, :k], np.sqrt(values[:k])
    audit = projected_covariance(fit, vectors, n, sums, roots)
    error, shares = float(np.abs(audit - np.eye(k)).max()), values[:k] / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            w = (x - sums / n) @ vectors / roots
            rough = n * x.astype(float) - sums
            fits = (np.abs(rough) < LARGEST).all(1) & ((rough * rough).sum(1) < LARGEST)
            with np.errstate(over="ignore"):
                apart = n * x - sums
                deviation = (apart * apart).sum(1)
            m = len(x)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                pa.array(np.repeat(deviation, k), mask=np.repeat(~fits, k)), pa.array(w.ravel()), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    result = own.keep(rows.select("vec_id", "x").mapInArrow(project, schema))
    own.clear()
    return result
