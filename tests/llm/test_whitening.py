"""Jacobi-Davidson against a dense eigensolver, and whitening of hostile tables against plain integers."""

import math

import numpy as np
import pytest

from tapeloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x long, n long, rows long"


def spectrum(kind, d):
    return {
        "spread": np.linspace(1, 2, d), "equal": np.ones(d), "tie": np.array([5, 3, 3, 3, 3] + [1] * (d - 5)),
        "flat": np.array([2, 1] + [0] * (d - 2)), "steep": 10.0 ** -np.arange(d),
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "equal", "tie", "flat", "steep"])
@pytest.mark.parametrize("d", [5, 12, 60])
def test_directions_reach_double_precision(kind, d):
    turn = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    matrix = turn @ np.diag(spectrum(kind, d)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.jacobi_davidson(lambda u: matrix @ u, d, 4)
    assert np.allclose(values, np.sort(spectrum(kind, d))[::-1][:4], rtol=0, atol=1e-13 * values[0])
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-13


def test_fewer_dimensions_than_components():
    values, vectors = whitening.jacobi_davidson(lambda u: np.diag([1.0, 3.0]) @ u, 2, 4)
    assert values.tolist() == pytest.approx([3, 1]) and vectors.shape == (2, 2)


@pytest.mark.parametrize("seed", range(5))
def test_minres_solves_symmetric_systems_side_by_side(seed):
    draw = np.random.default_rng(seed)
    turn = np.linalg.qr(draw.standard_normal((20, 20)))[0]
    matrix = turn @ np.diag(draw.choice([-1, 1], 20) * draw.uniform(1, 3, 20)) @ turn.T  # indefinite
    rights = draw.standard_normal((20, 3))
    rights[:, 1] = turn[:, 0]  # solved in one step, while the others go on
    found = whitening.minres_in_step(lambda u: matrix @ u, rights, 60, 1e-12)
    assert np.abs(matrix @ found - rights).max() < 1e-8


def plainly(rows):
    """Everything the operator gives, with Python integers and a dense eigensolver."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], dtype=float) / n
    matrix = centred.T @ centred / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    found = {}
    for vec_id, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        whitened = (np.array([n * c - s for c, s in zip(x, sums)]) / n) @ vectors / np.sqrt(values)
        found.setdefault(vec_id, []).append((deviation, whitened))
    return n, found, values / np.trace(matrix)


def test_whitening_of_hostile_rows(spark, frame):
    draw = np.random.default_rng(3)
    good = [(i, [float(c) for c in np.float32(draw.standard_normal(6) * [4, 3, 2, 1, 1, 1])]) for i in range(60)]
    good += [good[0], (None, good[1][1]), (70, good[2][1]), (71, [-0.0, 0.0, 0.001, -0.001, 1.0, 1.0])]
    bad = [
        (80, None), (81, []), (82, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (83, [float("nan")] * 6),
        (84, [float("inf")] + [0.0] * 5), (85, [1.0, 2.0]),
    ]
    table = frame([(i, v, None, 1, 2, 3) for i, v in good + bad], SCHEMA)
    rows = whitening.whiten(table).collect()
    n, wanted, explained = plainly(good)
    assert len(rows) == 4 * len(good) and {r.n for r in rows} == {n}
    signs = {}
    for r in sorted(rows, key=lambda r: r.component):
        assert r.deviation in [d for d, _ in wanted[r.vec_id]]
        value = next(w for d, w in wanted[r.vec_id] if d == r.deviation)[r.component - 1]
        sign = signs.setdefault(r.component, math.copysign(1, r.whitened * value))
        assert r.whitened == pytest.approx(sign * value, abs=1e-11)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-11)
        assert r.identity_error < 1e-11


def test_tables_without_variance_or_rows(spark, frame):
    same = frame([(i, [1.0, 2.0], None, 1, 2, 3) for i in range(3)], SCHEMA)
    rows = whitening.whiten(same).collect()
    assert len(rows) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(1, 0, None, 0.0, None)}
    assert whitening.whiten(frame([], SCHEMA)).collect() == []
    assert whitening.whiten(frame([(1, None, None, 1, 2, 3)], SCHEMA)).collect() == []


def test_large_entries_leave_longs_exact_or_null(spark, frame):
    table = frame([(0, [2.0**30, 0.0], None, 1, 2, 3), (1, [0.0, 1.0], None, 1, 2, 3), (2, [-(2.0**20), 3.0], None, 1, 2, 3)], SCHEMA)
    rows = {r.vec_id: r for r in whitening.whiten(table).collect() if r.component == 1}
    _, wanted, _ = plainly([(0, [2.0**30, 0.0]), (1, [0.0, 1.0]), (2, [-(2.0**20), 3.0])])
    for vec_id, row in rows.items():
        exact = wanted[vec_id][0][0]
        assert row.deviation == (exact if exact < 1 << 63 else None)
