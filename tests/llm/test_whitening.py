"""Whitening against NumPy's eigenvectors of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from stemma.llm import whitening


def _rows(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)


def _usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) and abs(c) < 2.0**40 for c in v)


def _check(got, rows, d, most=32):
    kept = [(i, v) for i, v in rows if _usable(v) and len(v) == d]
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    away = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums, strict=True)] for r in x])
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > values[0] * 1e-12).sum()))
    assert len(got) == k * n and {r.component for r in got} == set(range(1, k + 1)) and {r.n for r in got} == {n}
    deviation = {}
    for (i, _), r in zip(kept, x, strict=True):
        deviation.setdefault(i, []).append(sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)))
    assert all(int(r.deviation_exact) in deviation[r.vec_id] and r.deviation == (int(r.deviation_exact) if int(r.deviation_exact) < 1 << 63 else None) for r in got)
    trace = float(sum(map(sum, deviation.values()))) / n**3
    for c in range(1, k + 1):
        mine = sorted((r for r in got if r.component == c), key=lambda r: (r.vec_id, r.whitened))
        assert len({r.explained for r in mine}) == 1 and mine[0].explained == pytest.approx(values[c - 1] / trace, rel=1e-9)
        want = away @ vectors[:, c - 1] / math.sqrt(values[c - 1])
        own = np.array([r.whitened for r in mine])
        if len({i for i, _ in kept}) == n:
            want = np.array([w for _, w in sorted(zip([i for i, _ in kept], want, strict=True))])
            assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-6
        assert abs((own**2).sum() / n - 1) < 1e-9
    assert {r.identity_error <= 1e-4 for r in got} == {True}


def test_against_eigenvectors(spark):
    r = np.random.default_rng(7)
    base = r.normal(size=(300, 12)) @ np.diag([3.0**-k for k in range(12)]) * 50
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(900, None), (901, []), (902, [1.0, None] * 6), (903, [math.nan] * 12), (904, [math.inf] + [0.0] * 11), (905, [1.0, 2.0]), (906, [1e30] * 12)]
    got = whitening.whiten(_rows(spark, rows)).collect()
    _check(got, rows, 12)
    assert len(whitening.whiten(_rows(spark, rows), most=3).collect()) == 900


def test_more_dimensions_than_components_and_doubles(spark):
    r = np.random.default_rng(8)
    rows = [(i, (r.normal(size=40) * (1 + np.arange(40))).tolist()) for i in range(200)]
    _check(whitening.whiten(_rows(spark, rows, "double")).collect(), rows, 40)


def test_repeated_rows_and_directions_without_variance(spark):
    r = np.random.default_rng(9)
    rows = []
    for i in range(120):
        a, b = r.normal(size=2).tolist()
        rows.append((i % 100, [a, b, a, 0.5, -a]))
    got = whitening.whiten(_rows(spark, rows)).collect()
    x = {r.component for r in got}
    assert len(got) == 120 * len(x) and len(x) == 2 and max(r.identity_error for r in got) < 1e-4


def test_far_entries_are_exact(spark):
    r = np.random.default_rng(10)
    rows = [(i, (r.normal(size=3) * 2.0**30).tolist()) for i in range(50)]
    _check(whitening.whiten(_rows(spark, rows, "double")).collect(), rows, 3)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0]), (3, [1.0])]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(_rows(spark, rows))
    assert got.count() == 0 and got.columns == "vec_id component n deviation whitened explained identity_error deviation_exact".split()


def test_batches_do_not_matter(spark):
    r = np.random.default_rng(11)
    rows = [(i, r.normal(size=5).tolist()) for i in range(400)]
    a, b = (sorted((x.vec_id, x.component, abs(x.whitened)) for x in whitening.whiten(_rows(spark, rows).repartition(k)).collect()) for k in (1, 7))
    assert all(x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-9 for x, y in zip(a, b, strict=True))
