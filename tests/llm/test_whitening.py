"""Embedding whitening against numpy's eigensolver and whole-number sums."""

import math
import random

import numpy as np
import pytest

from tablekit.llm import whitening as W


def spectrum_of(rows, d):
    values, basis = np.zeros(d), np.eye(d)
    for z in rows:
        values, basis = W.rank_one(values, basis, z)
    return values, basis


@pytest.mark.parametrize("d, seed", [(1, 0), (2, 1), (3, 2), (8, 3), (33, 4)])
def test_rank_one_updates_equal_a_full_decomposition(d, seed):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(150, d)) * rng.uniform(0.01, 4, size=d) + rng.normal(size=d)
    rows[10:20], rows[20] = rows[0], 0                       # copies, and nothing
    rows[30:40] = np.round(rows[30:40])
    values, basis = spectrum_of(rows, d)
    scatter = rows.T @ rows
    assert np.allclose(basis @ np.diag(values) @ basis.T, scatter, rtol=0, atol=1e-12 * np.abs(scatter).max())
    assert np.allclose(basis.T @ basis, np.eye(d), atol=1e-11) and (np.diff(values) >= 0).all()


def test_equal_poles_are_deflated():
    for rows in (np.repeat(np.eye(5), 4, axis=0), np.eye(5)[[0, 0, 0, 2]], np.ones((9, 5)),
                 np.vstack([np.eye(5) * 3, np.ones((2, 5))]), np.eye(5) * [1e-9, 1, 1e6, 1, 1e-9]):
        values, basis = spectrum_of(rows, 5)
        assert np.allclose(basis @ np.diag(values) @ basis.T, rows.T @ rows, atol=1e-12 * max(1, np.abs(rows).max() ** 2))
        assert np.allclose(basis.T @ basis, np.eye(5), atol=1e-12)


def test_secular_roots_lie_between_their_poles():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        d = np.sort(rng.uniform(-1, 1, n) * 10.0 ** rng.integers(-6, 6))
        d += np.arange(n) * 1e-6
        w = 10.0 ** rng.uniform(-9, 3, n)
        roots, gap = W.secular_roots(d, w)
        assert (roots >= d).all() and (roots[:-1] <= d[1:]).all() and roots[-1] <= d[-1] + w.sum() * (1 + 1e-12)
        f = 1 + (w / gap).sum(axis=1)
        assert (np.abs(f) <= 1e-9 * (1 + np.abs(w / gap).sum(axis=1))).all()


def test_combined_spectra_are_those_of_all_rows():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(40, 6))
    values, basis = W.combine(spectrum_of(rows[:3], 6), spectrum_of(rows[3:], 6))
    assert np.allclose(basis @ np.diag(values) @ basis.T, rows.T @ rows)


def brute(rows, scale=64, shift=1_000_000, k=16):
    used = [(i, [math.floor(scale * float(c)) + shift for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in used})
    n = len(fit)
    total = [sum(c) for c in zip(*fit)]
    z = np.array([[(n * a - s) / n for a, s in zip(x, total)] for x in fit])
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in used:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, total))
        y = np.array([(n * a - s) / n for a, s in zip(x, total)]) @ vectors
        for c in range(min(k, len(values))):
            if values[c] > len(values) * W.EPS * values[0]:
                out.append((i, c + 1, n, dev, y[c] / math.sqrt(values[c]), values[c] / cov.trace()))
    return out


def test_whitened_rows_equal_brute_force(spark):
    rnd = random.Random(11)
    base = [[rnd.gauss(0, 0.2 + 0.15 * j) for j in range(7)] for _ in range(260)]
    rows = [(i, v) for i, v in enumerate(base)] + [(1000 + i, base[0]) for i in range(150)]    # a hot vector
    rows += [(3, base[9]), (None, base[8]), (500, None), (501, base[1][:6] + [None]), (502, base[1][:6] + [float("nan")]),
             (503, base[1][:6] + [float("inf")]), (504, base[1][:6] + [-float("inf")])]
    frame = spark.createDataFrame([(*r, 1, "y") for r in rows], "vec_id long, embedding array<double>, N int, x string").repartition(5)
    got = W.whiten(frame, components=5, rows_per_task=30).collect()
    want = brute(rows, k=5)
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    flip = {}
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g)[:4] == w[:4]
        sign = flip.setdefault(g["component"], 1 if g["whitened"] * w[4] > 0 else -1)
        assert abs(sign * g["whitened"] - w[4]) < 1e-8
        assert abs(g["explained"] / w[5] - 1) < 1e-9 and g["identity_error"] < 1e-9


def test_floats_constant_entries_and_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(i, [float(i % 4), 2.5, float(i % 3) - 1, 0.0]) for i in range(40)]
    got = W.whiten(spark.createDataFrame(rows, schema)).collect()
    assert {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {12}
    assert abs(sum(r["explained"] for r in got if r["vec_id"] == 0) - 1) < 1e-12
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3 + [(2, None)], schema)).count() == 0   # one distinct vector
    assert W.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).count() == 0
    two = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], schema)).collect()
    assert sorted(abs(r["whitened"]) for r in two) == pytest.approx([1, 1])
    with pytest.raises(ValueError):
        W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], schema))


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(i) * 1e8, 1.0]) for i in range(30)]
    got = {r["vec_id"]: r["deviation"] for r in W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = {i: d for i, c, n, d, *_ in brute(rows)}
    assert {i: (d if d < 1 << 63 else None) for i, d in want.items()} == got and None in got.values()
