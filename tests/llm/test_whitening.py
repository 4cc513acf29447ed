from __future__ import annotations

import math
import random

import numpy as np
import pytest

from clickloom.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x string, component int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows, components=16):
    """By an eigenvalue decomposition of the covariance; whitened columns up to their sign."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable]
    fit = sorted({tuple(v) for v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = lambda rows: np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in rows])
    a = centred(fit)
    e, w = np.linalg.eigh(a.T @ a / n)
    e, w = e[::-1][:components], w[:, ::-1][:, :components]
    e, w = e[e > e[0] * 1e-12], w[:, : (e > e[0] * 1e-12).sum()]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    return [i for i, _ in usable], n, deviations, centred(x) @ w / np.sqrt(e), e / np.trace(a.T @ a / n)


def check(spark, rows, tolerance=1e-8):
    out = whitening.whiten(frame(spark, rows)).collect()
    ids, n, deviations, whitened, explained = brute(rows)
    k = whitened.shape[1]
    assert len(out) == len(ids) * k
    assert {r["component"] for r in out} == set(range(1, k + 1)) and {r["n"] for r in out} == {n}
    assert max(r["identity_error"] for r in out) < 1e-8
    for r in out:
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    # A row is told by its deviation and id; signs are those of the longest projection.
    order = lambda rows: sorted(rows, key=lambda r: (repr(r[0]), r[1], [round(abs(c), 5) for c in r[2]]))
    parts = {}
    for at, r in enumerate(out):
        parts.setdefault(at // k, []).append(r)
    got = order([(p[0]["vec_id"], int(p[0]["deviation"]), [r["whitened"] for r in p]) for p in parts.values()])
    want = order([(i, d, w) for i, d, w in zip(ids, deviations, whitened)])
    assert [g[:2] for g in got] == [w[:2] for w in want]
    g, w = np.array([g[2] for g in got]), np.array([w[2] for w in want])
    signs = np.sign((g * w).sum(axis=0))
    assert np.abs(g * signs - w).max() < tolerance
    return out


def vectors(n, d, seed=1):
    """Entries with clearly different variances."""
    rng = random.Random(seed)
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    scale = 1.3 ** np.arange(d)
    return [(i, (np.array([rng.gauss(0, 1) for _ in range(d)]) * scale @ turn).tolist()) for i in range(n)]


def test_equals_an_eigenvalue_decomposition(spark):
    out = check(spark, vectors(400, 24))
    assert max(r["component"] for r in out) == 16


def test_edges(spark):
    rows = vectors(80, 6)
    odd = [None, [None] + [1.0] * 5, [math.nan] + [1.0] * 5, [-math.inf] + [1.0] * 5]
    rows += [(500 + i, v) for i, v in enumerate(odd)] + rows[:10] + [(900 + i, rows[3][1]) for i in range(100)] + [(None, rows[4][1])]
    out = check(spark, rows)
    assert {r["n"] for r in out} == {80}


def test_dimensions_without_variance_have_no_component(spark):
    rows = [(i, [*v, 0.5, v[0] * 2, v[1] + 1]) for i, v in ((i, [math.floor(c * 64) / 64 for c in v]) for i, v in vectors(90, 4))]
    out = check(spark, rows, 1e-7)
    assert max(r["component"] for r in out) == 4


def test_ill_conditioned_rows(spark):
    """Variances twelve orders apart: the Gram matrix alone has no Cholesky factor to speak of."""
    rows = [(i, [c * 10.0 ** (2 * j) for j, c in enumerate(v)]) for i, v in vectors(200, 5)]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in out} == {1, 2, 3, 4, 5}
    assert max(r["identity_error"] for r in out) < 1e-6


def test_deviations_are_exact_beyond_longs(spark):
    rows = [(i, [float(i * 2**40), 1.0]) for i in range(5)]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert {(r["vec_id"], int(r["deviation"])) for r in out} == set(zip(*[brute(rows)[j] for j in (0, 2)]))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, []), (2, [])]])
def test_without_variance_the_result_is_empty(spark, rows):
    out = whitening.whiten(frame(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.collect() == []


def test_other_lengths_are_left_out(spark):
    rows = vectors(50, 5)
    out = whitening.whiten(frame(spark, rows + [(100, [1.0] * 4), (101, [])])).collect()
    assert {r["vec_id"] for r in out} == set(range(50))


def test_entries_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="is beyond"):
        whitening.whiten(frame(spark, [(1, [1e30, 1.0]), (2, [0.0, 1.0])])).collect()


def test_triangular_solve():
    rng = np.random.default_rng(3)
    r = np.triu(rng.normal(size=(7, 7))) + np.eye(7) * 4
    rows = rng.normal(size=(20, 7))
    assert np.allclose(whitening.solve_upper(rows, r) @ r, rows)
