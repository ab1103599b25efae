"""Embedding whitening by eigenvectors that are refined from single precision.

Entries become integers, so sums and products over the distinct vectors are exact,
whatever order the tasks finish in.  The covariance's eigenvectors are found in
float32 and corrected by Ogita and Aishima's iteration, which needs nothing but
matrix products in a higher precision (the widest float of the machine); where
eigenvalues lie closer together than their errors, the iteration cannot tell their
vectors apart, and a small eigenproblem inside the cluster, shifted by its mean, does.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releasemill.llm.frames import slices
from releasemill.workspace import materialise

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16

# Iterations; each squares the error, so single precision needs three or four.
ROUNDS = 12
# Vectors that a task multiplies at once.
ROWS = 4096
# Reach of centred entries up to which sums of products stay in 64 bits.
MOST_REACH = 1 << 24
# Eigenvalues below this share of the largest count as zero.
ZERO_SHARE = 1e-13

WIDE = np.longdouble


# --- eigenvectors --------------------------------------------------------------------


def _clusters(values: np.ndarray, near: np.ndarray) -> list[np.ndarray]:
    """Sets of two or more places whose values are chained by nearness, in order of value."""
    order = np.argsort(values, kind="stable")
    joined = near[order[:-1], order[1:]]
    edges = np.flatnonzero(~joined) + 1
    return [part for part in np.split(order, edges) if len(part) > 1]


def _solved(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """`vectors` of one cluster, turned inside their space to be eigenvectors of `matrix`."""
    image = matrix @ vectors
    inner = vectors.T @ image
    # The mean is taken off, so that what is left is the spread of the cluster alone.
    gram = vectors.T @ vectors
    mean = np.trace(inner) / np.trace(gram)
    spread = inner - mean * gram
    largest = np.abs(spread).max()
    if largest == 0:
        return vectors
    _, turn = np.linalg.eigh(_even(spread / largest).astype(np.float64))
    turned = vectors @ turn.astype(matrix.dtype)
    # The turn is orthogonal to float64 only; one Newton step makes the vectors so again.
    return turned + turned @ (np.eye(len(turn), dtype=matrix.dtype) - turned.T @ turned) / 2


def _even(matrix: np.ndarray) -> np.ndarray:
    """The matrix without the skew that rounding left."""
    return (matrix + matrix.T) / 2


def refined(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step: better eigenvectors, the eigenvalues of the given ones, the size of the change."""
    # Both even: a skew, divided by a small gap, would cost the vectors their right angles.
    residue = np.eye(len(matrix), dtype=matrix.dtype) - _even(vectors.T @ vectors)
    inner = _even(vectors.T @ (matrix @ vectors))
    values = np.diag(inner) / (1 - np.diag(residue))
    norms = [np.linalg.norm(m.astype(np.float64), 2) for m in (inner - np.diag(values), matrix, residue)]
    error = 2 * (norms[0] + norms[1] * norms[2])
    gap = values[None, :] - values[:, None]
    near = np.abs(gap) <= error
    with np.errstate(divide="ignore", invalid="ignore"):
        change = np.where(near, residue / 2, (inner + values[None, :] * residue) / np.where(near, 1, gap))
    better = vectors + vectors @ change
    for part in _clusters(values, near):
        better[:, part] = _solved(matrix, better[:, part])
    return better, values, float(np.abs(change).max())


def eigenpairs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    A vector's largest entry is positive; zero matrices give unit vectors.
    """
    matrix = matrix.astype(WIDE)
    scale = np.abs(matrix).max() if matrix.size else 0
    if not scale:
        return np.zeros(len(matrix), dtype=WIDE), np.eye(len(matrix), dtype=WIDE)
    matrix = matrix / scale
    _, start = np.linalg.eigh(matrix.astype(np.float32))
    vectors = start.astype(WIDE)
    enough = 4 * len(matrix) * np.finfo(WIDE).eps
    for _ in range(ROUNDS):
        vectors, _, change = refined(matrix, vectors)
        if change <= enough:
            break
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    values = (vectors * (matrix @ vectors)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(matrix))]
    return values[order] * scale, vectors * np.sign(largest)


# --- sums in Spark -------------------------------------------------------------------


def usable(vector: str) -> Column:
    """Whether a vector has entries, all of them present and finite."""
    value = F.col(f"`{vector}`")
    bad = F.exists(value, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(value) > 0) & ~bad, F.lit(False))


def integer_vector(vector: str) -> Column:
    """Each entry as a long: floor(64 c) + 1,000,000."""
    return F.transform(
        F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long")
    )


@dataclass(frozen=True)
class Space:
    """Exact sums of the fit list, and its centre in whole numbers."""

    n: int
    sums: list[int]
    centre: np.ndarray  # whole number next to the mean of each dimension
    reach: int  # largest distance of an entry from the centre

    @property
    def rest(self) -> np.ndarray:
        """Mean minus centre, at most one half."""
        return np.array(
            [float(Fraction(s - self.n * int(c), self.n)) for s, c in zip(self.sums, self.centre)]
        )


def measured(fit: DataFrame) -> Space:
    """Size, sums and extent of the distinct vectors; a few numbers for each dimension."""
    rows = (
        fit.select(F.posexplode("x").alias("dim", "x"))
        .groupBy("dim")
        .agg(F.count("*").alias("n"), F.sum(F.col("x") - OFFSET).alias("total"),
             F.min("x").alias("low"), F.max("x").alias("high"))
        .orderBy("dim").collect()
    )
    n = rows[0]["n"] if rows else 0
    if any(r["n"] != n for r in rows):
        raise ValueError("vectors of several lengths have no common covariance")
    sums = [r["total"] + n * OFFSET for r in rows]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    reach = max((max(r["high"] - c, c - r["low"]) for r, c in zip(rows, centre)), default=0)
    if reach >= MOST_REACH:
        raise ValueError(f"entries lie up to {reach / SCALE:g} from their mean: sums would not be exact")
    return Space(n, sums, np.array(centre, dtype=np.int64), reach)


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


def _pairs(total: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    i, j = np.triu_indices(len(total))
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j], kind)],
        names=["i", "j", "total"],
    )


def _gathered(sums: DataFrame, dims: int, total: Column, kind: type) -> np.ndarray:
    """A symmetric matrix from the tasks' sums; its size is that of the dimensions."""
    out = np.zeros((dims, dims), dtype=object if kind is int else kind)
    for row in sums.groupBy("i", "j").agg(total.alias("total")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = kind(row["total"])
    return out


def covariance(fit: DataFrame, space: Space) -> np.ndarray:
    """The covariance of the fit list, each entry rounded once, from exact sums."""
    centre, dims = space.centre, len(space.centre)
    square = max(1, space.reach**2)
    exact = square * ROWS < 1 << 53  # products of a batch are whole numbers in float64

    def run(batches):
        total, seen = np.zeros((dims, dims), dtype=np.int64), 0
        for batch in slices(batches, ROWS):
            centred = _vectors(batch, dims) - centre
            if exact:
                centred = centred.astype(np.float64)
            total += (centred.T @ centred).astype(np.int64)
            seen += batch.num_rows
            if seen * square > 1 << 61:
                yield _pairs(total, pa.int64())
                total, seen = np.zeros((dims, dims), dtype=np.int64), 0
        if seen:
            yield _pairs(total, pa.int64())

    sums = fit.mapInArrow(run, "i int, j int, total long")
    products = _gathered(sums, dims, F.sum(F.col("total").cast("decimal(38,0)")), int)
    n = space.n
    rest = [s - n * int(c) for s, c in zip(space.sums, space.centre)]
    out = np.zeros((dims, dims), dtype=WIDE)
    for i in range(dims):
        for j in range(dims):
            # Whole numbers until the last division.
            above = n * products[i, j] - rest[i] * rest[j]
            whole, part = divmod(above, n * n)
            out[i, j] = WIDE(whole) + WIDE(part) / WIDE(n * n)
    return out


def identity_error(fit: DataFrame, space: Space, projection: np.ndarray) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    centre, rest, count = space.centre, space.rest, projection.shape[1]
    if not count:
        return None

    def run(batches):
        # A column of ones gives the sums of the components as well.
        total = np.zeros((count + 1, count + 1))
        for batch in slices(batches, ROWS):
            white = ((_vectors(batch, len(centre)) - centre).astype(np.float64) - rest) @ projection
            white = np.hstack([white, np.ones((len(white), 1))])
            total += white.T @ white
        yield _pairs(total, pa.float64())

    sums = fit.mapInArrow(run, "i int, j int, total double")
    total = _gathered(sums, count + 1, F.sum("total"), float) / space.n
    means = total[:count, count]
    return float(np.abs(total[:count, :count] - np.outer(means, means) - np.eye(count)).max())


# --- the operator --------------------------------------------------------------------


def _deviations(vectors: np.ndarray, space: Space) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact."""
    rest = [s - space.n * int(c) for s, c in zip(space.sums, space.centre)]
    centred = vectors - space.centre
    largest = space.n * (int(np.abs(centred).max(initial=0)) + 1)
    if len(rest) * largest**2 >= 1 << 63:
        centred = centred.astype(object)  # whole numbers of any size; too large a sum fails
        apart = centred * space.n - np.array(rest, dtype=object)
    else:
        apart = centred * space.n - np.array(rest, dtype=np.int64)
    return pa.array((apart * apart).sum(axis=1).tolist(), pa.int64())


def whitened(embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """`id, component, n, deviation, whitened, explained, identity_error`, a row for each vector and component.

    Vectors that are null or empty, or hold null or non-finite entries, are left out;
    those of several lengths are an error.  The fit list holds each distinct integer
    vector once, all rows are projected: rows that repeat an id or a vector, or have no
    id, get rows of their own.  There are at most as many components as dimensions.  A
    component without variance (fewer distinct vectors than dimensions) has a null
    `whitened` and no part in `identity_error`; where no component has any, `explained`
    and `identity_error` are null.
    """
    name = F.col(f"`{id_column}`").alias("__id")
    rows = embeddings.where(usable(vector)).select(name, integer_vector(vector).alias("x"))
    fit = materialise(rows.select("x").distinct(), "fit")
    space = measured(fit)
    dims = len(space.centre)
    shown = min(components, dims)
    matrix = covariance(fit, space) if dims else np.zeros((0, 0), dtype=WIDE)
    values, vectors = eigenpairs(matrix)
    alive = values[:shown] > ZERO_SHARE * (values[0] if dims else 0)
    held = int(alive.sum())  # eigenvalues fall, so these come first
    projection = (vectors[:, :held] / np.sqrt(values[:held])).astype(np.float64)
    trace = np.trace(matrix)
    shares = [float(v / trace) if trace > 0 else None for v in values[:shown]]
    error = identity_error(fit, space, projection)
    rest = space.rest
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for batch in slices(batches, ROWS):
            if not batch.num_rows or not shown:
                continue
            x = _vectors(batch, dims)
            white = ((x - space.centre).astype(np.float64) - rest) @ projection
            out = np.full((len(x), shown), np.nan)
            out[:, :held] = white
            each = np.repeat(np.arange(len(x)), shown)
            missing = np.tile(np.arange(shown) >= held, len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, shown + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(each), space.n), pa.int64()),
                    _deviations(x, space).take(pa.array(each)),
                    pa.array(out.ravel(), pa.float64(), mask=missing),
                    pa.array(shares * len(x), pa.float64()),
                    pa.array([error] * len(each), pa.float64()),
                ],
                names=names,
            )

    schema = rows.select(F.col("__id").alias(id_column)).schema
    for field, spark_type in zip(names[1:], ("integer", "long", "long", "double", "double", "double")):
        schema = schema.add(field, spark_type)
    return rows.mapInArrow(run, schema)
