import math

import numpy as np
import pytest

from stratalake.llm.whitening import Whitening, feast, inertia, slices, whiten

SCHEMA = "vec_id long, embedding array<float>, n string, component int, `a.b` int"


def symmetric(eigenvalues, seed=0):
    axes, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(eigenvalues),) * 2))
    matrix = (axes * eigenvalues) @ axes.T
    return (matrix + matrix.T) / 2


SPECTRA = {
    "spread": np.linspace(0.1, 1, 48),
    "repeated": np.repeat([5.0, 2.0, 1.0], 16),
    "low rank": np.r_[np.linspace(1, 2, 10), np.zeros(38)],
    "falling": 10.0 ** (-0.9 * np.arange(48)),
    "equal": np.full(48, 3.0),
    "close": np.linspace(1, 1 + 1e-4, 48),
    "one": np.array([4.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_components_of_matrices(name):
    matrix, settings = symmetric(SPECTRA[name]), Whitening()
    want = np.linalg.eigvalsh(matrix)[::-1]
    found = [feast(matrix, interval, settings.nodes) for interval in slices(matrix, settings)]
    values = np.sort(np.concatenate([values for values, _ in found]))[::-1]
    kept = want[want > settings.smallest * want[0]]
    assert len(kept) >= len(values) >= min(32, len(kept))
    assert np.abs(values - want[: len(values)]).max() < 1e-13 * want[0]
    for values, vectors in found:
        assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_inertia_counts_eigenvalues():
    r = np.random.default_rng(1)
    for size in (1, 2, 7, 30):
        matrix = r.standard_normal((size, size))
        matrix += matrix.T
        values = np.linalg.eigvalsh(matrix)
        for shift in [*((values[1:] + values[:-1]) / 2), -100, 100]:
            assert inertia(matrix, shift) == (values > shift).sum()
    hollow = np.array([[0.0, 1.0], [1.0, 0.0]])  # no pivot on the diagonal
    assert inertia(hollow, 0.0) == 1 and inertia(np.zeros((3, 3)), 0.0) == 0


def brute_force(vectors, most=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return ((n * x - total) ** 2).sum(axis=1), centred @ axes / np.sqrt(values), values / np.trace(v)


def compare(result, names, vectors, most=32):
    deviation, whitened, explained = brute_force(vectors, most)
    got = sorted(map(tuple, result.collect()), key=lambda row: (row[0], row[1]))
    most = whitened.shape[1]
    assert [row[:2] for row in got] == [(n, c) for n in sorted(names) for c in range(1, most + 1)]
    order = np.argsort(names, kind="stable")
    assert {row[2] for row in got} == {len(names)}
    assert [row[3] for row in got[::most]] == deviation[order].tolist()
    found = np.array([row[4] for row in got]).reshape(-1, most)
    sign = np.sign((found * whitened[order]).sum(axis=0))
    assert np.abs(found * sign - whitened[order]).max() < 1e-8
    assert np.allclose([row[5] for row in got[:most]], explained, rtol=1e-9)
    assert len({row[6] for row in got}) == 1 and got[0][6] < 1e-8
    covariance = np.cov(found.T, bias=True).reshape(most, most)
    assert np.abs(covariance - np.eye(most)).max() == pytest.approx(got[0][6], abs=1e-10)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("size", [1, 5, 40])
def test_equals_plain_decomposition(spark, size):
    r = np.random.default_rng(size)
    vectors = (r.standard_normal((300, size)) * np.linspace(1, 3, size) + 7).tolist()
    names = r.permutation(300).tolist()
    compare(whiten(frame(spark, list(zip(names, vectors)))), names, vectors)


def test_odd_rows(spark):
    r = np.random.default_rng(3)
    vectors = r.standard_normal((50, 4)).tolist()
    rows = [(n, v) for n, v in enumerate(vectors)]
    odd = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0]), (93, [math.nan] * 4), (94, [1.0, 1.0, 1.0, -math.inf])]
    compare(whiten(frame(spark, rows + odd)), list(range(50)), vectors)
    # A constant dimension and one that repeats another have no component.
    flat = [v[:3] + [v[0], 0.25] for v in vectors]
    got = whiten(frame(spark, list(enumerate(flat)))).collect()
    assert {row.component for row in got} == {1, 2, 3} and got[0].identity_error < 1e-8
    # Repeated rows and rows without vec_id count like others.
    again = whiten(frame(spark, rows + rows[:7] + [(None, v) for v in vectors[:3]]))
    assert again.count() == 60 * 4 and {row.n for row in again.collect()} == {60}
    for few in ([], [(1, [1.0, 2.0])], [(n, [1.0, 2.0]) for n in range(9)]):
        assert whiten(frame(spark, few)).collect() == []
    with pytest.raises(Exception, match="differ in length"):
        whiten(frame(spark, rows + [(70, [1.0])]))
    with pytest.raises(Exception, match="too large|overflow"):
        whiten(frame(spark, rows + [(70, [1e30] * 4)]))


def test_large_deviations(spark):
    """Beyond a long: null, while all else holds."""
    big = [(n, [float((-1) ** n * 2**40), float(n)]) for n in range(40)]
    got = whiten(frame(spark, big)).collect()
    assert got and {row.deviation for row in got} == {None} and got[0].identity_error < 1e-4
