"""Embedding whitening by spectral divide and conquer (QDWH).

Spark gathers exact sums of the integer vectors, and then the covariance of vectors that are centred first; both are partial
sums of a task, added up by dimension or pair of dimensions.  What reaches the driver is one number for each pair of dimensions.  There the
covariance, shifted by a value inside its spectrum, is taken to its polar factor by dynamically weighted Halley steps
(QR factorisations only): the factor plus the identity, halved, projects on the invariant subspace above the shift.  Both
subspaces are split again until each is one component.  The components, a matrix of dimensions by 32, are broadcast to whiten all vectors.

Vectors are whole numbers, floor(64 c) + 1,000,000.  They are centred at the whole number next to the mean before they are
multiplied, so that products are small and their sums whole; the mean's fraction is taken off after.

Defined results: vectors that are null or hold a null or non-finite component, or one whose whole number does not fit a long,
take no part; a row without id does.  Shorter vectors are filled up with components of zero.  A deviation beyond a long is null.
A component without variance (below 1e-12 of the trace) is whitened to 0 and is no part of the identity error.
Repeated rows count each; an empty table has an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlake.llm.topk import matrix

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Share of the trace below which a component has no variance.
FLAT = 1e-12
#: Vectors that are multiplied at once, and rows of results in a batch.
ROWS = 4096


# -- the spectrum of a symmetric matrix

def polar(a: np.ndarray, max_steps: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by Halley steps whose weights follow a bound on its least singular value."""
    n = len(a)
    x = a / np.linalg.norm(a)
    # a lower bound of the least singular value; one that is too small only costs a step
    r = np.abs(np.diag(np.linalg.qr(x, mode="r")))
    low = max(float(r.min()) / np.sqrt(n) / 2, np.finfo(float).eps)
    for _ in range(max_steps):
        d = np.cbrt(4 * (1 - low * low) / low**4) if low < 1 else 0.0
        alpha = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d))) / 2
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(gamma) * x, np.eye(n))))
        after = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * q[:n] @ q[n:].T
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (alpha + beta * low * low) / (1 + gamma * low * low))
        if moved < 1e-15 * n and 1 - low < 1e-15 * n:
            break
    return x


def subspace(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal bases of a projector's range (first ``rank`` columns) and of what is orthogonal to it, by QR with column choice."""
    n = len(projector)
    left, chosen = projector.copy(), []
    for _ in range(rank):
        k = int(np.argmax((left * left).sum(axis=0)))
        chosen.append(k)
        v = left[:, k] / np.linalg.norm(left[:, k])
        left -= np.outer(v, v @ left)
    q, _ = np.linalg.qr(np.hstack((projector[:, chosen], np.eye(n))))
    # once more, so that the basis lies in the range to full precision
    q, _ = np.linalg.qr(np.hstack((projector @ q[:, :rank], np.eye(n) - projector)) if rank < n else projector @ q)
    q, _ = np.linalg.qr(np.hstack((q[:, :rank], _others(q[:, :rank]))))
    return q


def _others(basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what is orthogonal to the columns of ``basis``."""
    n, rank = basis.shape
    full, _ = np.linalg.qr(basis, mode="complete")
    rest = full[:, rank:]
    return rest - basis @ (basis.T @ rest)


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns, by spectral divide and conquer."""
    n = len(v)
    size = np.linalg.norm(v)
    if n == 0:
        return np.zeros(0), np.zeros((0, 0))
    values, vectors = [], []
    todo = [(np.eye(n), (v + v.T) / 2)]
    while todo:
        basis, a = todo.pop()
        m = len(a)
        off = np.linalg.norm(a - np.diag(np.diag(a)))
        if m == 1 or off <= np.finfo(float).eps * size:
            values.extend(np.diag(a))
            vectors.extend(basis.T)
            continue
        split = None
        for shift in _shifts(a):
            u = polar(a - shift * np.eye(m))
            rank = round(float((np.trace(u) + m) / 2))
            # a shift on an eigenvalue leaves that one between both subspaces: take another shift
            if 0 < rank < m and np.linalg.norm(u @ u - np.eye(m)) < 1e-8:
                split = subspace((u + np.eye(m)) / 2, rank)
                break
        if split is None:  # values that double precision cannot tell apart: any basis serves
            values.extend(np.diag(a))
            vectors.extend(basis.T)
            continue
        for part in (split[:, :rank], split[:, rank:]):
            small = part.T @ a @ part
            todo.append((basis @ part, (small + small.T) / 2))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order].T


def _shifts(a: np.ndarray) -> list[float]:
    """Values inside the spectrum: the diagonal's median first; the mean lies strictly inside unless all values are equal."""
    d = np.diag(a)
    mean = float(d.mean())
    spread = float(np.linalg.norm(a - mean * np.eye(len(a)))) / len(a)
    return [*([] if len(a) == 2 else [float(np.median(d)), float((d.min() + d.max()) / 2)]), *[mean + spread * t for t in (0, 0.1, -0.1, 0.3, -0.3)]]


# -- sums over all vectors

def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part: x = floor(64 c) + 1,000,000."""
    own = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fits = f"abs(c) < {float(1 << 62) / SCALE!r}D"  # false for NaN, and null for null
    # the sum asks again, as Spark may take it before the filter
    whole = f"transform(v, c -> CASE WHEN {fits} THEN floor({SCALE} * c) + {SHIFT}L END)"
    return own.where("v IS NOT NULL").where(f"forall(v, c -> coalesce({fits}, false))").select("vec_id", F.expr(whole).alias("x"))


@dataclass
class Whitening:
    """A fitted whitening: ``n`` vectors with exact sums ``s``; components as columns, their variances, all of the trace."""

    n: int
    s: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def near(self) -> np.ndarray:
        """The whole numbers below the means."""
        return np.array([v // self.n for v in self.s], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the means have beyond them."""
        return np.array([v % self.n / self.n for v in self.s])

    @property
    def scaled(self) -> np.ndarray:
        """Components over the root of their variance; 0 for those without."""
        real = self.values > FLAT * self.trace
        return self.vectors / np.sqrt(np.where(real, self.values, 1.0)) * real

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.near).astype(np.float64) - self.rest) @ self.scaled


def _gather(x: DataFrame, part) -> np.ndarray:
    """The sum over all tasks of the matrix that ``part`` makes of a batch of vectors; one number of each entry is collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for begin in range(0, len(batch), ROWS):
                own = part(batch.column("x").slice(begin, ROWS))
                total = own if total is None else total + own
        if total is not None:
            i, j = (k.ravel().astype(np.int32) for k in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "value"])

    got = x.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    i, j, value = (got[c].to_numpy() for c in ("i", "j", "value"))
    out = np.zeros((i.max() + 1, j.max() + 1))
    out[i, j] = value
    return out


def fit(x: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """Sums, covariance and components of all vectors of ``x`` (see ``whole_vectors``); None if no vector has a component."""
    size = x.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dims")).first()
    n, dims = size["n"], size["dims"]
    if not n or not dims:
        return None
    sums = x.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("own")).collect()
    at = {r["at"]: int(r["s"]) + SHIFT * (n - r["own"]) for r in sums}  # missing components count as c = 0
    own = Whitening(n, [at[k] for k in range(dims)], np.zeros((dims, 0)), np.zeros(0), 0.0)
    near, rest = own.near, own.rest
    v = _gather(x, lambda b: _squares(_filled(b, dims) - near)) / n - np.outer(rest, rest)
    values, vectors = components(v)
    return Whitening(n, own.s, vectors[:, :count], values[:count], float(np.trace(v)))


def _filled(x: pa.Array, dims: int) -> np.ndarray:
    got = matrix(x, dims)
    sizes = np.diff(x.offsets.to_numpy())
    if len(sizes) and sizes.min() < dims:
        got[np.arange(dims)[None] >= sizes[:, None]] = SHIFT
    return got


def _squares(y: np.ndarray) -> np.ndarray:
    y = y.astype(np.float64)
    return y.T @ y


def transform(x: DataFrame, fitted: Whitening) -> DataFrame:
    """Every vector as one row for each component: all columns but ``x``, and component and whitened."""
    shared, dims, step = x.sparkSession.sparkContext.broadcast(fitted), len(fitted.s), max(1, ROWS // max(1, len(fitted.values)))
    kept = [c for c in x.columns if c != "x"]
    schema = StructType([*[x.schema[c] for c in kept], *StructType.fromDDL("component int, whitened double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), step):
                part = batch.slice(begin, step)
                w = shared.value.whiten(_filled(part.column("x"), dims))
                own = pa.array(np.repeat(np.arange(len(part)), w.shape[1]))
                number = np.tile(np.arange(1, w.shape[1] + 1, dtype=np.int32), len(part))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(own) for c in kept], pa.array(number), pa.array(w.ravel())], names=schema.names)

    return x.mapInArrow(run, schema)


def identity_error(x: DataFrame, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over all vectors."""
    shared, dims = x.sparkSession.sparkContext.broadcast(fitted), len(fitted.s)

    def moments(b: pa.Array) -> np.ndarray:
        w = shared.value.whiten(_filled(b, dims))
        return np.vstack((w.sum(axis=0)[None], w.T @ w))

    got = _gather(x, moments) / fitted.n
    covariance = got[1:] - np.outer(got[0], got[0])
    real = fitted.values > FLAT * fitted.trace
    off = np.abs(covariance - np.eye(len(covariance)))[np.ix_(real, real)]
    return float(off.max(initial=0.0))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every vector that takes part."""
    x = whole_vectors(rows, id_col, vector_col)
    fitted = fit(x, count)
    if fitted is None:
        columns = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], StructType([x.schema["vec_id"], *StructType.fromDDL(columns).fields]))
    sums = ", ".join(f"{v}L" if abs(v) < 1 << 63 else "CAST(NULL AS BIGINT)" for v in fitted.s)
    one = f"try_subtract(try_multiply({fitted.n}L, coalesce(try_element_at(x, i + 1), {SHIFT}L)), s)"
    # a vector's own, so taken before it becomes a row for each component
    far = f"aggregate(transform(array({sums}), (s, i) -> {one}), 0L, (a, d) -> try_add(a, try_multiply(d, d)))"
    shares = F.array(*[F.lit(float(v) / fitted.trace if fitted.trace > 0 else 0.0) for v in fitted.values])
    return transform(x.withColumn("deviation", F.expr(far)), fitted).select(
        "vec_id", "component", F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("component")).alias("explained"), F.lit(identity_error(x, fitted)).alias("identity_error"))


def report(embeddings: DataFrame) -> DataFrame:
    """The whitened components of every vector of the table."""
    return whiten(embeddings.select("vec_id", "embedding"))
