"""Whitening against a library's eigenvectors, and the spectral split on hard matrices."""

import math

import numpy as np
import pytest

from chronoloom.llm import whitening as W


def spectrum(kind, n, rng):
    a = rng.standard_normal((n, 3 * n + 2))
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    return {
        "plain": a @ a.T,
        "steep": (a * np.exp(-np.arange(n) * 20 / n)[:, None]) @ (a * np.exp(-np.arange(n) * 20 / n)[:, None]).T,
        "one": np.eye(n),
        "zero": np.zeros((n, n)),
        "repeated": np.diag(np.repeat([1.0, 2.0, 5.0], n)[:n]),
        "clusters": q @ np.diag(np.where(np.arange(n) < n // 2, 3.0, 1.0) + (np.arange(n) == 0) * 1e-9) @ q.T,
        "shift on an eigenvalue": q @ np.diag(np.arange(n) - (n - 1) / 2) @ q.T,
    }[kind]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["plain", "steep", "one", "zero", "repeated", "clusters", "shift on an eigenvalue"])
def test_spectral(kind, n):
    m = spectrum(kind, n, np.random.default_rng(n))
    m = (m + m.T) / 2
    got, norm = W.Spectral(m), max(np.linalg.norm(m), 1e-300)
    assert np.abs(got.values - np.linalg.eigvalsh(m)[::-1]).max() <= 1e-12 * norm
    assert np.abs(m @ got.vectors - got.vectors * got.values).max() <= 1e-12 * norm
    assert np.abs(got.vectors.T @ got.vectors - np.eye(n)).max() <= 1e-12


def test_polar_factor():
    a = np.random.default_rng(3).standard_normal((20, 20))
    u = W.polar(a + a.T)
    assert np.abs(u @ u - np.eye(20)).max() < 1e-12 and np.linalg.eigvalsh(u @ (a + a.T)).min() > -1e-10


def vectors(n=400, dim=40):
    rng = np.random.default_rng(7)
    return (rng.standard_normal((n, dim)) @ rng.standard_normal((dim, dim)) * 0.3 + 5).astype(np.float32)


def test_against_a_library(spark):
    v = vectors()
    rows = [(i, x.tolist(), 1, "a") for i, x in enumerate(v)]
    rows += [(900, None, 1, "a"), (901, [1.0, None] * 20, 1, "a"), (902, [math.nan] * 40, 1, "a"), (903, [math.inf] * 40, 1, "a"), (904, [], 1, "a"), (905, [1.0] * 39, 1, "a")]
    rows += [(0, rows[0][1], 1, "a"), (None, rows[1][1], 1, "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, z string").repartition(3)
    got = W.whitening(df).collect()
    kept = [(i, x) for i, x, *_ in rows if x and len(x) == 40 and all(c is not None and math.isfinite(c) for c in x)]
    whole = np.floor(64 * np.array([x for _, x in kept], np.float64)).astype(np.int64) + 1_000_000
    n, total = len(whole), whole.sum(axis=0)
    centred = whole - total / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1][:32], vector[:, ::-1][:, :32]
    want = centred @ vector / np.sqrt(value)
    assert len(got) == 32 * n and {r["n"] for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert len(by[None, 1]) == 1 and len(by[0, 32]) == 2
    for c in range(32):
        mine = np.array([by[i, c + 1][0]["whitened"] for i, _ in kept])
        assert np.abs(mine * np.sign(mine @ want[:, c]) - want[:, c]).max() < 1e-7
        assert math.isclose(by[5, c + 1][0]["explained"], value[c] / np.trace(centred.T @ centred / n), rel_tol=1e-9)
    away = ((n * whole.astype(object) - total) ** 2).sum(axis=1)
    assert {by[i, 1][0]["deviation"] for i, _ in kept} == set(away.tolist())
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_few_rows_and_great_numbers(spark):
    make = lambda rows: W.whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert make([]) == [] and make([(1, None)]) == [] and make([(1, [1.0, 2.0])]) == [] and make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    two = make([(1, [0.0, 0.0]), (2, [1.0, 1.0])])
    assert [r["component"] for r in two] == [1, 1] and sorted(round(r["whitened"], 9) for r in two) == [-1, 1] and two[0]["explained"] == pytest.approx(1)
    assert {r["deviation"] for r in two} == {2 * 64**2}
    great = make([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])])
    assert {r["component"] for r in great} == {1} or {r["component"] for r in great} == {1, 2}
    assert {r["deviation"] for r in great if r["vec_id"] == 1} == {None}
