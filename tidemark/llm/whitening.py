"""Embedding whitening by spectrum slicing.

The leading eigenvalues of the covariance are isolated by counting: by Sylvester's
law the negative pivots of an LDL' factorisation of A - s I tell how many
eigenvalues lie below s. Halving intervals by these counts separates an eigenvalue
from its neighbours, Rayleigh quotient iteration then converges on it cubically,
and counts on both sides of what it found certify the eigenvalue's number.
"""

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import record_batch, written

COMPONENTS = 4
SCALE = 256
TINY = float(np.finfo(float).eps)
# An eigenvalue below this share of the largest counts as zero: it can't be scaled to one.
LEAST_SHARE = 1e-12

_MOMENTS = pa.schema([("place", pa.int32()), ("row", pa.list_(pa.float64()))])
RESULT = """vec_id long, component int, n long, deviation long, whitened double, explained double,
    identity_error double"""


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to a symmetric one, by Householder
    reflections."""
    a = matrix.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        block = a[k + 1 :, k + 1 :]
        p = block @ x
        q = 2 * (p - (x @ p) * x)
        block -= np.outer(x, q) + np.outer(q, x)
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """Counts of a symmetric matrix's eigenvalues above a shift.

    The matrix is brought to tridiagonal form once; the LDL' factorisation of the
    shifted form, which has the same inertia, then takes one pass over its diagonal.
    """

    def __init__(self, matrix: np.ndarray):
        self._diagonal, self._beside = (x.tolist() for x in tridiagonal(matrix))
        self._least = max(TINY * float(np.abs(matrix).max(initial=0.0)), np.finfo(float).tiny)

    def above(self, shift: float) -> int:
        """How many eigenvalues exceed the shift: the positive pivots."""
        positive, pivot = 0, 0.0
        for i, entry in enumerate(self._diagonal):
            pivot = entry - shift - (self._beside[i - 1] ** 2 / pivot if i else 0.0)
            if abs(pivot) < self._least:
                pivot = -self._least
            positive += pivot > 0
        return positive


def _isolated(inertia: Inertia, number: int, low: float, high: float, least: float) -> tuple[float, float]:
    """An interval that holds the eigenvalue of that number, and no other unless it is as narrow as
    rounding allows."""
    while high - low > least:
        if inertia.above(high) == number - 1 and inertia.above(low) == number and high - low < 0.1 * abs(high):
            break
        middle = (low + high) / 2
        if inertia.above(middle) >= number:
            low = middle
        else:
            high = middle
    return low, high


def _iterate(matrix: np.ndarray, shift: float, start: np.ndarray, known: np.ndarray, fixed: int, free: int):
    """Inverse iteration at the shift, then Rayleigh quotient iteration, orthogonal to known vectors."""
    identity, v = np.eye(len(matrix)), start
    for step in range(fixed + free):
        try:
            w = np.linalg.solve(matrix - shift * identity, v)
        except np.linalg.LinAlgError:
            w = np.linalg.solve(matrix - (shift + TINY * np.abs(matrix).max()) * identity, v)
        w -= known.T @ (known @ w)
        norm = np.linalg.norm(w)
        if not np.isfinite(norm) or norm == 0:
            break
        v = w / norm
        value = v @ matrix @ v
        if np.linalg.norm(matrix @ v - value * v) <= TINY * np.abs(matrix).max():
            break
        if step >= fixed - 1:
            shift = value
    return float(v @ matrix @ v), v


def leading_components(matrix: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues of a symmetric matrix, falling, and their unit vectors as rows.

    Those that are zero but for rounding are left out, so there may be fewer.
    Eigenvalues that rounding can't tell apart share an interval, and their vectors
    are kept orthogonal.
    """
    d = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    values, vectors = [], np.zeros((0, d))
    if not size:
        return np.array(values), vectors
    inertia, least = Inertia(matrix), 4 * d * TINY * size
    rng = np.random.default_rng(0)
    for number in range(1, min(components, d) + 1):
        low, high = _isolated(inertia, number, -least, size + least, least)
        while True:
            start = rng.standard_normal(d)
            value, v = _iterate(matrix, (low + high) / 2, start - vectors.T @ (vectors @ start), vectors, 3, 12)
            off = np.linalg.norm(matrix @ v - value * v) + least
            # The counts certify the number; if the iteration went astray, narrow the interval.
            if inertia.above(value + off) < number <= inertia.above(value - off) or high - low <= least:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if inertia.above(middle) >= number else (low, middle)
        if value <= LEAST_SHARE * (values[0] if values else size):
            break
        values.append(value)
        vectors = np.vstack([vectors, v])
    return np.array(values), vectors


def integer_vectors(
    table: DataFrame, scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """id and x: floor(scale * entry) of each entry, of rows whose vector is there, has the table's
    commonest length (the greater of equally common ones) and only finite entries."""
    rows = table.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"))
    sound = rows.filter(
        F.col("v").isNotNull()
        & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        & (F.size("v") > 0)
    )
    found = sound.select("id", F.transform("v", lambda c: F.floor(c.cast("double") * scale)).alias("x"))
    commonest = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found.filter(F.size("x") == (commonest["d"] if commonest else 0))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _second_moments(frame: DataFrame, rows: Column, d: int, values) -> np.ndarray:
    """Sum of the outer products of ``values(x)``, each task's rows first; d rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                part = values(batch.column(0))
                total += part.T @ part
        yield record_batch(_MOMENTS, np.arange(d), list(total))

    summed = (
        frame.select(rows)
        .mapInArrow(run, "place int, row array<double>")
        .groupBy("place")
        .agg(F.array(*[F.sum(F.col("row")[i]) for i in range(d)]).alias("row"))
    )
    matrix = np.zeros((d, d))
    for row in summed.collect():
        matrix[row["place"]] = row["row"]
    return matrix


def whitened(
    table: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error), one for each sound
    vector and leading component.

    Fitted on the distinct integer vectors, each once: n of them, with sums S per
    dimension. deviation is the sum of (n x - S)^2, exact, null where a long can't
    hold it. explained is the component's share of the whole variance;
    identity_error the largest entry by which the fitted vectors' covariance, once
    whitened, is off the identity.

    Vectors null, empty, of an unusual length or with a null or non-finite entry take
    no part; a null id is kept as it is. Rows that repeat an id or a vector each have
    their rows. Equal eigenvalues have orthogonal vectors, any of those there are.
    Components without variance are left out, so a table of one vector, or none, gives
    no rows. Other columns are not read. The driver holds a few matrices of the
    vectors' length squared.
    """
    vectors = written(integer_vectors(table, scale, id_column, vector_column), "integer-vectors")
    kind = dict(table.dtypes)[id_column]
    result = RESULT.replace("vec_id long", f"`{id_column}` {kind}")
    first = vectors.select(F.size("x").alias("d")).first()
    if first is None:
        return table.sparkSession.createDataFrame([], result)
    d = first["d"]
    fit = written(vectors.select("x").distinct(), "fit-vectors")
    sums = [F.sum(F.col("x")[i].cast("decimal(38,0)")) for i in range(d)]
    n, *totals = fit.agg(F.count("*"), *sums).first()
    totals = [int(s) for s in totals]
    mean = np.array([s / n for s in totals])

    def centred(column: pa.Array) -> np.ndarray:
        return _matrix(column, d) - mean

    covariance = _second_moments(fit, F.col("x"), d, centred) / n
    covariance = (covariance + covariance.T) / 2
    values, axes = leading_components(covariance, components)
    if not len(values):
        return table.sparkSession.createDataFrame([], result)
    turned = (axes / np.sqrt(values)[:, None]).T
    k = len(values)
    shares = values / np.trace(covariance)
    # The whitened vectors' mean is that of vectors centred already.
    off = _second_moments(fit, F.col("x"), k, lambda c: centred(c) @ turned) / n - np.eye(k)
    error = float(np.abs(off).max())

    def deviations(x: np.ndarray) -> list[int | None]:
        if n * int(np.abs(x).max()) + max(map(abs, totals)) <= isqrt((2**63 - 1) // d):
            return ((n * x - np.array(totals)) ** 2).sum(axis=1).tolist()
        exact = ((n * x.astype(object) - np.array(totals, object)) ** 2).sum(axis=1)
        return [v if v < 2**63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores, rows = centred(batch.column(1)) @ turned, batch.num_rows
            schema = pa.schema(
                [batch.schema.field(0), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
                + [(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]
            )
            found = pa.array(deviations(_matrix(batch.column(1), d)), pa.int64())
            yield record_batch(
                schema,
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                np.tile(np.arange(1, k + 1), rows),
                np.full(rows * k, n),
                found.take(pa.array(np.repeat(np.arange(rows), k))),
                scores.ravel(),
                np.tile(shares, rows),
                np.full(rows * k, error),
            )

    scored = vectors.select("id", "x").mapInArrow(run, result.replace(f"`{id_column}`", "id"))
    return scored.withColumnRenamed("id", id_column)
