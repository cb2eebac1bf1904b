import math

import numpy as np
import pytest

from stardw.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, N long, whitened string"


def brute(vectors, k=8):
    """By numpy over all rows at once: values, vectors, deviations."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    centred = ((n * x - s) / n).astype(float)
    v = centred.T @ centred / n
    value, vector = np.linalg.eigh(v)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    return value, centred @ vector / np.sqrt(value), deviation, np.trace(v)


def made(rng, n, d, groups):
    centre = rng.normal(0, 0.3, (groups, d))
    return (centre[rng.integers(groups, size=n)] + rng.normal(0, 0.1, (n, d)) * rng.uniform(0.2, 1, d)).astype(np.float32)


@pytest.mark.parametrize("n,d,k", [(400, 64, 8), (300, 5, 8), (60, 40, 3), (50, 1, 8)])
def test_like_numpy(spark, n, d, k):
    vectors = made(np.random.default_rng(n), n, d, 4)
    rows = [(i, v.tolist(), 1, 2, "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = W.whiten(df, k=k).collect()
    value, whitened, deviation, trace = brute(vectors, k)
    assert len(found) == n * min(k, d)
    mine = np.zeros_like(whitened)
    for r in found:
        mine[r.vec_id, r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert r.explained == pytest.approx(value[r.component - 1] / trace, rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
    for a, b in zip(mine.T, whitened.T):
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7


def test_rows_without_a_whole_vector_are_dropped(spark):
    rng = np.random.default_rng(3)
    good = made(rng, 80, 6, 3)
    rows = [(i % 70, v.tolist(), 1, None, None) for i, v in enumerate(good)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0], [1.0] * 7, [nan] + [0.0] * 5, [inf] + [0.0] * 5, [-inf] + [0.0] * 5, [None] + [0.0] * 5]
    rows += [(100 + i, v, None, 1, "y") for i, v in enumerate(bad)]
    rows.append((None, good[0].tolist(), None, None, None))
    found = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.n for r in found} == {81} and len(found) == 81 * 6
    assert sum(r.vec_id is None for r in found) == 6 and max(r.vec_id or 0 for r in found) < 100
    # Rows of one id and one vector each have theirs.
    assert sum(r.vec_id == 3 for r in found) == 12


@pytest.mark.parametrize("rows", [[], [(1, None, 1, 1, "")], [(i, [0.5, 0.25], 1, 1, "") for i in range(4)]])
def test_nothing_to_fit(spark, rows):
    found = W.whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["vec_id", *W.RESULTS] and found.count() == 0


def test_directions_without_variance_are_left_out(spark):
    rng = np.random.default_rng(5)
    flat = np.repeat(rng.normal(size=(50, 2)), 3, axis=1).astype(np.float32)
    found = W.whiten(spark.createDataFrame([(i, v.tolist(), 1, 1, "") for i, v in enumerate(flat)], SCHEMA)).collect()
    assert {r.component for r in found} == {1, 2} and found[0].identity_error < 1e-9


def test_large_entries(spark):
    rows = [(i, [float(i % 3) * 1e12, float(i)], 1, 1, "") for i in range(30)] + [(99, [3e38, -3e38], 1, 1, "")]
    found = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 62 and found[0].deviation is None
    assert all(math.isfinite(r.whitened) for r in found)


@pytest.mark.parametrize("d,rank", [(64, 64), (200, 40), (80, 80), (300, 300)])
def test_certified(d, rank):
    """Flat, steep and deficient spectra, where the block may have to grow."""
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    for spectrum in (np.linspace(1, 0.9, d), 0.5 ** np.arange(d), 1 / (1 + np.arange(d))):
        spectrum = np.where(np.arange(d) < rank, spectrum, 0)
        v = (turn * spectrum) @ turn.T
        value, vector = W.components(lambda q: v @ q, d, 8)
        assert np.abs(value - spectrum[:len(value)]).max() < 1e-12 and len(value) == 8
        assert np.abs(v @ vector - vector * value).max() < 1e-11


def test_copies_of_one_vector(spark):
    vectors = np.vstack([made(np.random.default_rng(1), 60, 12, 3), np.tile(np.full(12, 0.75, np.float32), (300, 1))])
    rows = [(i, v.tolist(), 1, 1, "") for i, v in enumerate(vectors)]
    found = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 360 * 8 and found[0].identity_error < 1e-9
    assert len({(r.component, r.whitened) for r in found if r.vec_id >= 60}) == 8
