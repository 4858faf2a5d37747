"""Whitening of embeddings; components by contour integration (FEAST) with inertia counts."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import finite_vector, parts_of


@dataclass(frozen=True)
class Whitening:
    """Settings.

    ``components``: most components. ``scale``, ``shift``: an entry c counts as
    floor(scale * c) + shift. ``smallest``: share of the largest eigenvalue, rounded down to at most
    half of it less, below which one counts as zero: double precision leaves it no four right digits.
    ``slice_size``: how
    many eigenvalues an interval holds at most, unless they are too close to be told apart.
    ``nodes``: points of the quadrature on the upper half of a contour.
    """

    components: int = 32
    scale: int = 64
    shift: int = 1_000_000
    smallest: float = 1e-10
    slice_size: int = 8
    nodes: int = 8


# --- eigenvalues of a symmetric matrix that fits into one task ------------------------------------


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are larger than ``shift``.

    By Sylvester's law they are as many as the positive pivots of a symmetric elimination of the
    shifted matrix. Pivots are single entries of the diagonal or, where those are small, two by two
    blocks around the largest other entry, which have one positive and one negative eigenvalue.
    """
    left = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(left):
        diagonal = np.abs(np.diagonal(left))
        i = int(diagonal.argmax())
        across = np.abs(left - np.diag(np.diagonal(left)))
        p, q = divmod(int(across.argmax()), len(left))
        if diagonal[i] == 0 and across[p, q] == 0:
            break
        if diagonal[i] >= 0.6404 * across[p, q]:  # (1 + sqrt(17)) / 8 keeps the growth of entries small
            positive += int(left[i, i] > 0)
            chosen = [i]
        else:
            positive += 1
            chosen = [p, q]
        rest = np.setdiff1d(np.arange(len(left)), chosen)
        block, side = left[np.ix_(chosen, chosen)], left[np.ix_(rest, chosen)]
        left = left[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        left = (left + left.T) / 2
    return positive


@dataclass(frozen=True)
class Interval:
    low: float
    high: float
    count: int


def slices(matrix: np.ndarray, settings: Whitening) -> list[Interval]:
    """Intervals that together hold at least the largest ``components`` eigenvalues above zero, a
    few in each, by counts of inertia at their ends. No end lies on an eigenvalue."""
    bound = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
    if bound == 0:
        return []
    top = bound * 1.01
    least = _largest_eigenvalue_bound(matrix, top) * settings.smallest
    known = {top: 0, least: inertia(matrix, least)}
    wanted = min(settings.components, known[least])
    if not wanted:
        return []
    thin = bound * 1e-9

    def cut(low: float, high: float) -> float | None:
        """A place between two ends with no eigenvalue next to it, nearest to the middle."""
        width = high - low
        for step in range(1, 16):
            for side in (1, -1):
                at = low + width * (0.5 + side * (step - 1) / 32)
                near = width * 1e-3
                above = inertia(matrix, at + near)
                if above == inertia(matrix, at - near):
                    known[at] = above
                    return at
        return None

    found, waiting = [], [(least, top)]
    while waiting:
        low, high = waiting.pop()  # the highest first
        inside = known[low] - known[high]
        if not inside or known[high] >= wanted:
            continue
        middle = cut(low, high) if inside > settings.slice_size and high - low > thin else None
        if middle is None:
            found.append(Interval(low, high, inside))
        else:
            waiting += [(low, middle), (middle, high)]
    return found


def _largest_eigenvalue_bound(matrix: np.ndarray, top: float) -> float:
    """The largest eigenvalue to a factor of two, from below."""
    while not inertia(matrix, top / 2):
        top /= 2
    return top / 2


def feast(matrix: np.ndarray, interval: Interval, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of a symmetric matrix within an interval that holds
    ``interval.count`` of them.

    A random block is filtered by a quadrature of the resolvent along a circle through the ends of
    the interval, which leaves of it what lies in the wanted eigenspace; the Ritz pairs of what is
    left are filtered again until they are eigenpairs to rounding. The number of Ritz values in the
    interval has to be the one that the inertia of its ends gives; else a larger block is tried.
    """
    size = len(matrix)
    centre, radius = (interval.low + interval.high) / 2, (interval.high - interval.low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    angles = np.pi / 2 * (points + 1)  # the lower half is the conjugate of the upper
    turns = np.exp(1j * angles)
    scale = np.abs(matrix).sum(axis=1).max()
    block = min(size, interval.count + interval.count // 2 + 3)
    for attempt in range(6):
        basis = np.random.default_rng(attempt).standard_normal((size, block))
        for _ in range(40):
            filtered = np.zeros_like(basis)
            for turn, weight in zip(turns, weights, strict=True):
                shifted = (centre + radius * turn) * np.eye(size) - matrix
                filtered += (weight * radius * turn * np.linalg.solve(shifted, basis)).real / 2
            basis, spread, _ = np.linalg.svd(filtered, full_matrices=False)
            basis = basis[:, spread > spread[0] * 1e-13]
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)
            basis = basis @ small
            inside = (values > interval.low) & (values < interval.high)
            error = np.linalg.norm(matrix @ basis[:, inside] - basis[:, inside] * values[inside], axis=0)
            if inside.sum() == interval.count and error.max(initial=0) <= 1e-14 * size * scale:
                return values[inside], basis[:, inside]
        block = min(size, 2 * block)
    raise ArithmeticError(f"{inside.sum()} of {interval.count} eigenvalues found in {interval}")


# --- sums over all rows --------------------------------------------------------------------------


def integer_vectors(embeddings: DataFrame, settings: Whitening) -> DataFrame:
    """(vec_id, x): the vectors that take part, their entries as integers."""
    number = lambda c: F.floor(c.cast("double") * settings.scale) + settings.shift
    return embeddings.where(finite_vector(F.col("embedding")) & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", number).alias("x")
    )


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, size)


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each dimension."""

    def add(batches):
        count, total, size = 0, None, None
        for batch in parts_of(batches, 4096):
            sizes = batch.column("x").value_lengths().to_numpy()
            size = size or int(sizes[0])
            if (sizes != size).any():
                raise ValueError("the vectors differ in length")
            part = _matrix(batch, size)
            if max(int(part.max()), -int(part.min())) >= 2**50:
                raise ValueError("the entries are too large for exact sums")
            total = part.sum(axis=0).astype(object) + (0 if total is None else total)
            count += batch.num_rows
        if count:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(size), pa.int32()),
                    pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
                    pa.array([count] * size, pa.int64()),
                ],
                names=["i", "total", "n"],
            )

    sums = vectors.select("x").mapInArrow(add, "i int, total decimal(38,0), n long")
    rows = sums.groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("i").collect()
    if len({row.n for row in rows}) > 1:
        raise ValueError("the vectors differ in length")
    return (rows[0].n if rows else 0), [int(row.total) for row in rows]


def _exact_product(part: np.ndarray) -> np.ndarray:
    """part.T @ part of integers, exact."""
    most = max(int(part.max()), -int(part.min()), 1)
    rows = 2**53 // (most * most)
    if not rows:
        return part.T.astype(object) @ part.astype(object)
    total = np.zeros((part.shape[1],) * 2, object)
    for at in range(0, len(part), rows):
        real = part[at : at + rows].astype(np.float64)  # sums stay below 2**53, so they are exact
        total += (real.T @ real).astype(np.int64).astype(object)
    return total


def covariance(vectors: DataFrame, count: int, totals: list[int]) -> np.ndarray:
    """The covariance of all vectors, divisor n, each entry the double nearest to the exact value.

    Vectors are centred at the whole number nearest to the mean before they are multiplied; products
    are summed as integers, and what the mean lies off that number is taken out exactly.
    """
    size = len(totals)
    centre = np.array([(2 * t + count) // (2 * count) for t in totals], np.int64)

    def multiply(batches):
        total, (above, beside) = 0, np.triu_indices(size)
        for batch in parts_of(batches, 4096):
            total = total + _exact_product(_matrix(batch, size) - centre)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(above, pa.int32()),
                    pa.array(beside, pa.int32()),
                    pa.array([Decimal(int(t)) for t in total[above, beside]], pa.decimal128(38, 0)),
                ],
                names=["i", "j", "product"],
            )

    products = vectors.select("x").mapInArrow(multiply, "i int, j int, product decimal(38,0)")
    off = [t - count * int(c) for t, c in zip(totals, centre, strict=True)]
    matrix = np.zeros((size, size))
    for row in products.groupBy("i", "j").agg(F.sum("product").alias("product")).toLocalIterator():
        exact = Fraction(count * int(row["product"]) - off[row["i"]] * off[row["j"]], count * count)
        matrix[row["i"], row["j"]] = matrix[row["j"], row["i"]] = float(exact)
    return matrix


def principal_components(spark, matrix: np.ndarray, settings: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns.

    The spectrum is cut into intervals by counts of inertia; each interval is a task. A last
    Rayleigh-Ritz step over all that was found makes the vectors of different intervals orthogonal.
    """
    intervals = slices(matrix, settings)
    if not intervals:
        return np.zeros(0), np.zeros((len(matrix), 0))
    nodes = settings.nodes

    def solve(batches):
        for batch in batches:
            for place in batch.column("id").to_pylist():
                values, vectors = feast(matrix, intervals[place], nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["value", "vector"]
                )

    places = spark.range(0, len(intervals), 1, len(intervals))
    found = places.mapInArrow(solve, "value double, vector array<double>").collect()
    if len(found) != sum(interval.count for interval in intervals):
        raise ArithmeticError("an interval has lost eigenvalues")
    found.sort(key=lambda row: -row.value)
    basis, _ = np.linalg.qr(np.array([row.vector for row in found]).T)
    values, small = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values)[: settings.components]
    return values[order], (basis @ small)[:, order]


def whiten(embeddings: DataFrame, settings: Whitening = Whitening()) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): every vector of
    ``embeddings`` (vec_id, embedding), projected on the leading components of their covariance.

    Each entry c counts as x = floor(scale * c) + shift. n and the sums are exact, deviation is the
    exact sum of (n * x - S)^2 over the dimensions, null where it is beyond a long. whitened is the
    centred vector's part along a component over the square root of its eigenvalue, explained the
    eigenvalue's share of the trace, identity_error how far the covariance of all whitened values is
    from the identity, measured over all rows.

    Three passes over the vectors gather sums (per dimension, per pair of dimensions, per pair of
    components), each with one partial sum a task; the result is a fourth, with no shuffle. What the
    driver holds is the covariance, of a size that the dimensions set, not the rows.

    Null and empty vectors, and those with an entry that is null or not finite, are left out; every
    other row is kept, repeated rows and those with a null vec_id too. Components whose eigenvalue is
    zero to rounding are left out, so one row alone, equal rows, and no rows give no result. Vectors
    of different lengths, or with entries of 2^50 and more, are an error. Of components with equal
    eigenvalues any basis may come. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings, settings)
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    count, totals = _sums(vectors)
    matrix = covariance(vectors, count, totals) if count else np.zeros((0, 0))
    eigenvalues, axes = principal_components(spark, matrix, settings) if count else (np.zeros(0), None)
    if not len(eigenvalues):
        return spark.createDataFrame([], schema)
    size, most = len(totals), len(eigenvalues)
    axes = axes / np.sqrt(eigenvalues)
    explained = eigenvalues / np.trace(matrix)

    def centred(part: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        reach = max(int(np.abs(part).max()) * count, max(map(abs, totals)))
        kind = np.int64 if 4 * reach * reach * size < 2**63 else object
        return part.astype(kind) * count - np.array(totals, kind)

    def project(part: np.ndarray) -> np.ndarray:
        return (part / count).astype(np.float64) @ axes

    def multiply(batches):
        total, along, rows = np.zeros((most, most)), np.zeros(most), 0
        for batch in parts_of(batches, 4096):
            whitened = project(centred(_matrix(batch, size)))
            total += whitened.T @ whitened
            along += whitened.sum(axis=0)
            rows += batch.num_rows
        if rows:
            places = np.indices((most, most + 1)).reshape(2, -1)
            content = np.column_stack([total, along]).ravel()  # the last column holds the sums
            yield pa.RecordBatch.from_arrays(
                [pa.array(places[0], pa.int32()), pa.array(places[1], pa.int32()), pa.array(content)], names=["i", "j", "s"]
            )

    measured = np.zeros((most, most + 1))
    products = vectors.select("x").mapInArrow(multiply, "i int, j int, s double")
    for row in products.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        measured[row["i"], row["j"]] = row["s"] / count
    means = measured[:, most]
    identity_error = float(np.abs(measured[:, :most] - np.outer(means, means) - np.eye(most)).max())

    def result(batches):
        for batch in parts_of(batches, 1024):
            apart = centred(_matrix(batch, size))
            squares = [int(s) if s < 2**63 else None for s in (apart * apart).sum(axis=1).tolist()]
            rows = batch.num_rows
            every = np.repeat(np.arange(rows), most)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(every)),
                    pa.array(np.tile(np.arange(1, most + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * most, count, np.int64)),
                    pa.array(squares, pa.int64()).take(pa.array(every)),
                    pa.array(project(apart).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * most, identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(result, schema)
