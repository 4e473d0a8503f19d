"""Descent and ridge regression against plain numpy restatements."""

import hashlib

import numpy as np
import pytest

from corposcope.operators import regression as G


def draw(key, purpose, values):
    return int(hashlib.md5(f"{key}|{purpose}|42".encode()).hexdigest()[:8], 16) % values


def data(n=90, dim=4, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    return [(i, x[i].tolist(), float(x[i] @ np.arange(1, dim + 1) + 0.5 + rng.normal() / 10)) for i in range(n)]


def table(spark, rows, folds=1, partitions=3):
    df = spark.createDataFrame(rows, "id long, v array<double>, s double").repartition(partitions)
    return G.as_features(df, "v", "s", "id", folds=folds)


def restated(rows, model, *, max_iter, tol, shards, folds=1):
    """One sample at a time, plain loops over shards and epochs."""
    dim = len(rows[0][1])
    dealt = {}
    for i, x, y in rows:
        order = hashlib.md5(f"{i}|order|42".encode()).hexdigest()
        dealt.setdefault(draw(i, "shard", shards), []).append((order, i, np.array(x), y, draw(i, "fold", folds)))
    w, b, t, best, waited, epochs = np.zeros(dim), 0.0, dict.fromkeys(dealt, 0), np.inf, 0, 0
    for _ in range(max_iter):
        parts, loss, n = [], 0.0, 0
        for shard, part in dealt.items():
            sw, sb, m = w.copy(), b, 0
            for _, _, x, y, fold in sorted(part, key=lambda r: r[:2]):
                t[shard] += 1
                if fold == model.without:
                    continue
                eta = model.eta0 / t[shard] ** 0.25
                err = sw @ x + sb - y
                loss += err * err / 2
                if model.penalty == "l2":
                    sw = sw * max(1 - eta * model.alpha, 0)
                sw = sw - eta * err * x
                if model.penalty == "l1":
                    sw = np.sign(sw) * np.maximum(abs(sw) - eta * model.alpha, 0)
                sb, m = sb - eta * err, m + 1
            parts.append((m, sw, sb))
            n += m
        w, b, epochs = sum(m * p for m, p, _ in parts) / n, sum(m * p for m, _, p in parts) / n, epochs + 1
        if tol is not None:
            waited = waited + 1 if loss / n > best - tol else 0
            best = min(best, loss / n)
            if waited >= 5:
                break
    return w, b, epochs


@pytest.mark.parametrize("penalty", ["l2", "l1", None])
def test_descent(spark, penalty):
    rows, models = data(), [G.Descent(1e-2, 5e-2, penalty), G.Descent(1e-1, 1e-2, penalty, 1)]
    found = G.descend(table(spark, rows, 3), models, key="id", max_iter=4, tol=None, shards=3)
    for model, fit in zip(models, found):
        w, b, epochs = restated(rows, model, max_iter=4, tol=None, shards=3, folds=3)
        assert fit.weights == pytest.approx(w, abs=1e-9) and fit.intercept == pytest.approx(b, abs=1e-9) and fit.epochs == epochs


def test_stop_rule_and_partitions(spark):
    rows, model = data(40), G.Descent(1e-3, 5e-2)
    [one] = G.descend(table(spark, rows, partitions=1), [model], key="id", max_iter=40, tol=1e-2, shards=2)
    [two] = G.descend(table(spark, rows, partitions=7), [model], key="id", max_iter=40, tol=1e-2, shards=2)
    w, b, epochs = restated(rows, model, max_iter=40, tol=1e-2, shards=2)
    assert one.epochs == two.epochs == epochs < 40
    assert (one.weights == two.weights).all() and one.weights == pytest.approx(w, abs=1e-9)


def test_a_rate_that_is_too_high_is_told(spark):
    scores, (chosen, fit) = G.grid_search(table(spark, data(), 2), key="id", alphas=[1e-4], eta0s=[1e6, 5e-2], folds=2, max_iter=8, shards=2)
    assert scores[0][2] == float("inf") and chosen.eta0 == 5e-2 and fit.loss < 0.5


def test_grid_errors(spark):
    rows = data(60)
    scores, _ = G.grid_search(table(spark, rows, 3), key="id", alphas=[1e-3, 1e-1], eta0s=[1e-2], folds=3, max_iter=2, tol=None, shards=2, refit=False)
    for alpha, eta0, mse in scores:
        errors = []
        for f in range(3):
            w, b, _ = restated(rows, G.Descent(alpha, eta0, "l2", f), max_iter=2, tol=None, shards=2, folds=3)
            errors.append(np.mean([(np.dot(w, x) + b - y) ** 2 for i, x, y in rows if draw(i, "fold", 3) == f]))
        assert mse == pytest.approx(np.mean(errors), abs=1e-9)


def test_odd_rows(spark):
    odd = [(100, None, 1.0), (101, [1.0, None, 2.0, 3.0], 1.0), (102, [1.0, 2.0, 3.0, 4.0], None)]
    assert table(spark, data(5) + odd).count() == 5
    [fit] = G.descend(table(spark, odd), [G.Descent()], key="id")
    assert fit.epochs == 0 and len(fit.weights) == 0
    with pytest.raises(ValueError, match="penalty"):
        G.descend(table(spark, data(5)), [G.Descent(penalty="l3")], key="id")


def test_ridge_from_sums(spark):
    rows = data(80)
    moments = G.fold_moments(table(spark, rows, 4), 4)
    scores = dict(G.ridge_search(moments, [1e-3, 1.0]))
    for alpha, mse in scores.items():
        errors = []
        for f in range(4):
            train = [(x, y) for i, x, y in rows if draw(i, "fold", 4) != f]
            x, y = np.array([[*r, 1.0] for r, _ in train]), np.array([v for _, v in train])
            w = np.linalg.solve(x.T @ x + alpha * len(y) * np.diag([1.0] * 4 + [0.0]), x.T @ y)
            errors.append(np.mean([(np.dot(w[:-1], r) + w[-1] - v) ** 2 for i, r, v in rows if draw(i, "fold", 4) == f]))
        assert mse == pytest.approx(np.mean(errors), rel=1e-9)


def test_moments_need_no_python(spark):
    df = table(spark, data(20), 2)
    spread = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in spread and "Arrow" not in spread
