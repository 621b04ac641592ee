"""Contour-integral whitening against a dense eigensolver and exact whole numbers."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def spread(values, seed=0):
    """A symmetric matrix with these eigenvalues."""
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


def pairs(v, k):
    wanted, cut = whitening.spectrum_slices(v, k)
    found = [whitening.contour_pairs(v, *s) for s in cut]
    values = np.concatenate([x for x, _ in found]) if found else np.zeros(0)
    order = np.argsort(-values)[:wanted]
    return values[order], np.concatenate([y for _, y in found], axis=1)[:, order] if found else np.zeros((len(v), 0))


@pytest.mark.parametrize(
    "values",
    [
        np.geomspace(1e6, 1.0, 40),
        np.arange(60, 0, -1.0),
        [5.0] * 40,
        [9.0, 9.0, 9.0 - 1e-12, 4.0, 4.0, 1.0] * 7,
        np.geomspace(1e8, 1e-2, 70),
        [3.0, 2.0, 0.0, 0.0],
        [1.0],
        list(np.linspace(10, 9.9, 50)) + [1e-3] * 14,
    ],
)
def test_eigenpairs_equal_the_dense_solver(values):
    v = spread(values)
    v = (v + v.T) / 2
    got, vectors = pairs(v, 32)
    want = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(32, int((want > 1e-11 * want[0]).sum()))
    assert len(got) == k
    assert np.allclose(got, want[:k], rtol=1e-9, atol=1e-13 * want[0] * len(v))
    assert np.abs(v @ vectors - vectors * got).max() < 1e-13 * want[0] * len(v)


def test_inertia_counts_eigenvalues():
    v = spread(np.arange(1.0, 21.0))
    diagonal, off = whitening.tridiagonal(v)
    assert np.allclose(np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)), np.arange(1.0, 21.0))
    assert whitening.count_above(diagonal, off, np.array([0.5, 10.5, 20.5])).tolist() == [20, 10, 0]


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError):
        whitening.contour_pairs(spread([5.0, 4.0, 1.0]), 3.0, 6.0, 3)


ROWS = "vec_id bigint, embedding array<double>, label int, row string, component string, vector string"


def frame(spark, vectors):
    vectors = [(i, v if v is None else [c if c is None else float(c) for c in v]) for i, v in vectors]
    return spark.createDataFrame([(i, v, 1, "r", "c", "v") for i, v in vectors], ROWS)


def check(vectors, out, k=32):
    """Compare with exact sums and numpy's eigensolver."""
    good = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in good), default=0)
    x = np.array([[int(np.floor(64 * c)) + 1000000 for c in [*v, *[0.0] * (dims - len(v))]] for _, v in good], dtype=object)
    n = len(good)
    got = {}
    for r in out.collect():
        got.setdefault((r.row.vec_id, float(r.deviation)), {}).setdefault(r.component, []).append(r)
    sums = [sum(c) for c in x.T]
    dev = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[float(a - Fraction(s, n)) for a, s in zip(row, sums)] for row in x], dtype=float)
    v = centred.T @ centred / n
    want = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(k, int((want > 1e-10 * want[0]).sum()) if want[0] > 1e-9 else 0)
    rows = [r for by in got.values() for rs in by.values() for r in rs]
    assert len(rows) == n * k and {r.component for r in rows} == set(range(1, k + 1))
    assert sorted(float(r.deviation) for r in rows if r.component == 1) == sorted(map(float, dev)) if k else True
    for r in rows:
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained * want.sum() / want[r.component - 1] - 1) < 1e-8
    whole = {}
    for r in rows:
        whole.setdefault(r.component, []).append(r.whitened)
    for c in range(1, k + 1):
        assert abs(np.var(whole[c]) - 1) < 1e-8 and abs(np.mean(whole[c])) < 1e-8
    # Projections onto single eigenvectors, where the eigenvalue stands alone.
    values, vecs = np.linalg.eigh(v)
    for c in range(1, k + 1):
        at = len(values) - c
        alone = min([abs(values[at] - values[j]) for j in range(len(values)) if j != at], default=1.0)
        if alone > 1e-3 * values[at]:
            want_w = np.sort(np.abs(centred @ vecs[:, at]) / np.sqrt(values[at]))
            assert np.allclose(np.sort(np.abs(whole[c])), want_w, atol=1e-7)


def test_awkward_vectors(spark):
    rnd = np.random.default_rng(3)
    vectors = [(i, (rnd.standard_normal(6) * [9, 5, 3, 1, 0.5, 0]).tolist()) for i in range(300)]
    vectors += [(300, None), (301, [1.0, None, 0, 0, 0, 0]), (302, [NAN] * 6), (303, [0, 0, INF, 0, 0, 0]), (None, [1.0] * 6)]
    vectors += [(304, []), (305, [2.5]), (7, vectors[7][1]), (306, [-30.0, 50.0, 0.0, 0, 0, 0])]
    out = whitening.whiten(frame(spark, vectors))
    check(vectors, out)
    assert out.select("row.row", "row.component", "row.vector", "row.label").distinct().collect() == [("r", "c", "v", 1)]
    check(vectors, whitening.whiten(frame(spark, vectors), components=2), k=2)


def test_sums_beyond_doubles_stay_exact(spark):
    vectors = [(i, [1e9 * (i % 7), 3e12 * (i % 3) + i]) for i in range(50)]
    check(vectors, whitening.whiten(frame(spark, vectors)))


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [])], [(1, [3.0]), (2, [3.0])]])
def test_no_spread_no_components(spark, vectors):
    assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_an_entry_too_large_to_tell_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e300]), (2, [0.0])])).collect()


def test_registered_query_against_the_dense_solver(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    out = queries.QUERIES["op13_contour_whitening"](spark, sf)
    assert dict(out.dtypes)["deviation"] == "bigint"
    check([(r.vec_id, r.embedding) for r in source], out.withColumn("row", F.struct("vec_id")))
