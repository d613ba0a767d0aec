import math

import numpy as np
import pytest

from folioflow.llm import whitening

COLUMNS = "vec_id long, embedding array<float>"


def close_to_sum(d, u, v, rho, tol=2e-13):
    want = u @ np.diag(d) @ u.T + rho * np.outer(v, v)
    e, q = whitening.rank_one(d, u, v, rho)
    scale = max(1e-300, np.abs(want).max())
    assert np.abs(q @ np.diag(e) @ q.T - want).max() <= tol * scale
    assert np.abs(q.T @ q - np.eye(len(d))).max() <= tol * 10 and (np.diff(e) >= -tol * scale).all()
    assert np.abs(e - np.linalg.eigvalsh(want)).max() <= tol * scale


@pytest.mark.parametrize("m", [1, 2, 3, 8, 40])
def test_rank_one_updates(m):
    rng = np.random.default_rng(m)
    q = np.linalg.qr(rng.normal(size=(m, m)))[0]
    spectra = [np.sort(rng.random(m)), np.zeros(m), np.ones(m), np.sort(rng.integers(0, 3, m)).astype(float), np.sort(np.r_[1.0, 1 + 1e-13 * rng.random(m - 1)]), np.sort(10.0 ** rng.uniform(-12, 6, m))]
    for d in spectra:
        for v in (rng.normal(size=m), q[:, 0] * 3, q[:, -1] * 1e-9, np.zeros(m), q @ np.where(rng.random(m) < 0.3, 1.0, 0.0), q @ (10.0 ** rng.uniform(-14, 0, m))):
            for rho in (0.0, 1e-6, 1.0, 1e5):
                close_to_sum(d, q, v, rho)


def test_many_updates_stay_orthogonal():
    rng = np.random.default_rng(0)
    x = rng.integers(-200, 200, (600, 16))
    x[:, 3] = x[:, 2]
    one, other = whitening.Spectrum(16), whitening.Spectrum(16)
    for r in x[:250]:
        one.add(r)
    for r in x[250:]:
        other.add(r)
    one.merge(other)
    c = x - x.mean(0)
    assert one.n == 600 and (one.sums == x.sum(0)).all()
    assert np.abs(one.vectors.T @ one.vectors - np.eye(16)).max() < 1e-11
    assert np.abs(one.vectors @ np.diag(one.values) @ one.vectors.T - c.T @ c).max() < 1e-9 * np.abs(c.T @ c).max()


def brute(rows, k=4):
    """vec_id -> (n, deviation, whitened by component), and the shares, by one eigendecomposition."""
    fine = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in fine}))
    n, sums = len(x), x.sum(0)
    c = x - sums / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    out = [(i, n, sum((n * a - int(s)) ** 2 for a, s in zip(v, sums, strict=True)), (np.array(v) - sums / n) @ q[:, :k] / np.sqrt(e[:k])) for i, v in fine]
    return out, e[:k] / e.sum()


def test_against_one_decomposition(spark):
    rng = np.random.default_rng(4)
    base = (rng.normal(size=(500, 12)) * np.linspace(1, 0.2, 12)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)] + [(1000 + i, [float(c) for c in base[7]]) for i in range(200)]
    rows += [(2000, None), (2001, []), (2002, [float("nan")] * 12), (2003, [1.0] * 11 + [None]), (2004, [float("inf")] * 12), (2005, [-0.0] * 12), (None, [0.5] * 12), (3, [0.25] * 12)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS + ", x string, n int").repartition(7)
    want, shares = brute(rows)
    got = {}
    for r in whitening.whiten(df).collect():
        got.setdefault((r.vec_id, r.deviation), []).append(r)
    assert len(want) == 500 + 200 + 3
    signs = np.ones(4)
    for i, n, deviation, w in want:
        found = sorted(got[i, deviation], key=lambda r: r.component)[:4]
        assert [r.component for r in found] == [1, 2, 3, 4] and all(r.n == n for r in found)
        mine = np.array([r.whitened for r in found])
        if i == 0:
            signs = np.sign(mine * w)
        assert np.abs(mine * signs - w).max() < 1e-9
        assert np.abs(np.array([r.explained for r in found]) / shares - 1).max() < 1e-10 and found[0].identity_error < 1e-10


def test_small_and_odd_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, COLUMNS)
    assert whitening.whiten(frame([])).collect() == [] and whitening.whiten(frame([(1, None)])).collect() == []
    assert whitening.whiten(frame([(1, [1.0, 2.0])] * 3)).collect() == []
    two = whitening.whiten(frame([(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 0.0]), (3, [9.0]), (4, [])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in two) == [(1, 1, 2, 2 * 256**2), (2, 1, 2, 2 * 256**2)]
    assert {round(abs(r.whitened), 12) for r in two} == {1.0} and {round(r.explained, 12) for r in two} == {1.0}
    huge = whitening.whiten(frame([(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])])).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and all(r.deviation is None for r in huge)
