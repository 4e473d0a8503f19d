import math
import random
from fractions import Fraction

import numpy as np
import pytest

from corposcope.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1000000 for c in vector]


def kept(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def exact_covariance(xs):
    """Entries as fractions, from rows centred on their means: ``n`` times as large, so that they are whole numbers."""
    n, dim = len(xs), len(xs[0])
    sums = [sum(x[d] for x in xs) for d in range(dim)]
    centred = [[n * x[d] - sums[d] for d in range(dim)] for x in xs]
    return [[Fraction(sum(c[a] * c[b] for c in centred), n**3) for b in range(dim)] for a in range(dim)], centred


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def check(spark, rows, got=None):
    """Against fractions: counts and deviations exactly; eigenvalues and coordinates of separate ones by another solver."""
    rows_ = kept(rows)
    xs = [integers(v) for _, v, *_ in rows_]
    n, dim = len(xs), len(xs[0])
    cov, centred = exact_covariance(xs)
    trace = sum(cov[d][d] for d in range(dim))
    got = got or whitening.whitened(table(spark, rows)).collect()
    assert len(got) == n * min(dim, 32) and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    sums = [sum(x[d] for x in xs) for d in range(dim)]
    want = sorted((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for (i, *_), x in zip(rows_, xs) for _ in range(min(dim, 32)))
    assert sorted((r.vec_id, r.deviation) for r in got) == want
    values, vectors = np.linalg.eigh(np.array([[float(c / (trace or 1)) for c in row] for row in cov]))
    values, vectors = values[::-1], vectors[:, ::-1]
    for r in got:
        assert r.explained == pytest.approx(max(values[r.component - 1], 0), rel=1e-6, abs=1e-13)
    if len({i for i, *_ in rows_}) == n and trace:
        gaps = np.abs(np.subtract.outer(values, values) + np.eye(dim)).min(axis=1)
        z = np.array([[float(Fraction(v, n)) for v in c] for c in centred]) @ vectors / np.sqrt(np.maximum(values, 1e-300) * float(trace))
        place = {i: k for k, (i, *_) in enumerate(rows_)}
        for r in got:
            if gaps[r.component - 1] > 1e-5 and values[r.component - 1] > 1e-9:
                assert abs(r.whitened) == pytest.approx(abs(z[place[r.vec_id], r.component - 1]), rel=1e-6, abs=1e-7)
    return got, xs


def random_rows(n, dim, seed=1, spread=None):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, (spread or [1] * dim)[d]) for d in range(dim)], 0) for i in range(n)]


def test_random_rows(spark):
    got, xs = check(spark, random_rows(60, 5))
    w = {(r.vec_id, r.component): r.whitened for r in got}
    for a in range(1, 6):
        for b in range(1, 6):
            assert sum(w[i, a] * w[i, b] for i in range(60)) / 60 == pytest.approx(float(a == b), abs=1e-10)


def test_odd_rows(spark):
    rows = random_rows(40, 4) + [(90, None, 1), (91, [1.0, None, 2.0, 3.0], 1), (92, [1.0, float("nan"), 2.0, 3.0], 1), (93, [float("inf"), 0.0, 0.0, 0.0], 1)]
    rows += [(None, [0.5, -0.25, 1e-9, -1e-9], None), (3, [0.0] * 4, 0), (3, [0.0] * 4, 0)]
    rows_ = [(r[0] if r[0] is not None else -1, *r[1:]) for r in rows]
    check(spark, rows_)
    assert len(whitening.whitened(table(spark, rows)).collect()) == 43 * 4
    ragged = rows + [(94, [1.0, 2.0], 0), (95, [], 0)]
    assert {r.vec_id for r in whitening.whitened(table(spark, ragged)).collect()} == {r[0] for r in kept(rows)}


def test_directions_without_spread(spark):
    rows = [(i, [float(i % 7), 3.0, float(i % 7) * 2, float(i % 3)], 0) for i in range(42)]
    got = whitening.whitened(table(spark, rows)).collect()
    flat = [r for r in got if r.whitened is None]
    assert {r.component for r in flat} == {3, 4} and all(r.explained < 1e-15 for r in flat)
    same = whitening.whitened(table(spark, [(i, [1.0, 2.0], 0) for i in range(5)])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(0, None, 0.0, 0.0)] * 10


def test_large_entries(spark):
    rows = [(0, [3e38, 1.0], 0), (1, [-3e38, 2.0], 0), (2, [0.0, 5.0], 0)]
    got = whitening.whitened(table(spark, rows)).collect()
    assert len(got) == 6 and any(r.deviation is None for r in got)
    check(spark, [(i, [1e5 * (i % 5), float(i % 3), 1e4 * (i % 7)], 0) for i in range(30)])


def test_empty(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 1], [1, 1 + 1e-9, 1 + 2e-9, 5, 5 + 1e-7], [1, 1e-7, 1e-9, 1e-12, 0], [2, 2, 2, 2, 2]])
def test_close_eigenvalues(values):
    """Vectors as good as the double allows, from float32 ones that clusters have mixed up."""
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(5, 5)))[0].astype(np.longdouble)
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined(a, np.linalg.eigh(a.astype(np.float32))[1])
    assert np.abs(x.T @ x - np.eye(5)).max() < 1e-15
    assert np.abs(a @ x - x * got).max() < 1e-16 * max(values)
    assert np.sort(got) == pytest.approx(np.sort(np.array(values, float)), abs=1e-14)


def test_product_has_more_than_double_precision():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(7, 40)), rng.normal(size=(40, 3))
    exact = [[float(sum(Fraction(x) * Fraction(y) for x, y in zip(r, c)) - Fraction(float(p))) for c, p in zip(b.T, ps)] for r, ps in zip(a, whitening.product(a, b))]
    assert np.abs(whitening.product(a, b) - whitening.product(a, b).astype(float) - np.array(exact)).max() < 1e-18


def test_the_query(spark, folder):
    from corposcope.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op12_whitening"](spark, folder)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(spark, rows, got.collect())
