"""Linear models on sentence vectors: stochastic gradient descent, its grid, and ridge regression from statistics.

Descent runs in shards: every shard goes through its rows one by one in a seeded order, from the same weights, and the
weights are averaged between epochs. All models of a grid, with and without each fold, are trained in the same
pass. A row's shard, place and fold are hashes of its key, so results do not depend on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.keys import hash_key
from ..session import staged

PENALTIES = ("l2", "l1", None)
POWER = 0.25  # the rate falls with this power of the number of steps
PATIENCE = 5  # epochs without enough improvement before a model stops


@dataclass(frozen=True)
class Descent:
    """One model: how it learns, and the fold it does not see."""

    alpha: float = 1e-4
    eta0: float = 1e-2
    penalty: str | None = "l2"
    without: int | None = None


@dataclass
class Fitted:
    weights: np.ndarray
    intercept: float
    epochs: int
    loss: float  # mean of half the squared errors of the last epoch, each before its step


def _hashed(digest, values: int):
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % values).cast("int")


def as_features(df: DataFrame, vector: str, target: str, key: str, *, folds: int = 1, seed: int = 42) -> DataFrame:
    """``key``, ``x`` (doubles), ``y`` and ``fold``, without rows that lack a vector, an entry or a target."""
    x, y = F.col(vector).cast("array<double>"), F.col(target).cast("double")
    rows = df.select(F.col(key), x.alias("x"), y.alias("y"), _hashed(hash_key(key, F.lit("fold"), seed=seed), folds).alias("fold"))
    return rows.where("x is not null and y is not null and not exists(x, v -> v is null)")


# --- stochastic gradient descent -------------------------------------------------------


def _epoch(models: list[Descent], start: np.ndarray, done: np.ndarray, first_step: dict[int, int]):
    """Each shard from ``start`` (a row of weights and intercept per model) through all its rows."""
    alpha, eta0 = (np.array([getattr(m, n) for m in models]) for n in ("alpha", "eta0"))
    ridge, lasso = (np.array([m.penalty == p for m in models]) for p in ("l2", "l1"))
    without = np.array([-1 if m.without is None else m.without for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, w = None, None

        def result() -> pa.RecordBatch:
            rows = np.column_stack([w, loss, seen])
            return pa.record_batch([pa.array([shard] * len(w), pa.int32()), pa.array(range(len(w)), pa.int32()), pa.array([steps] * len(w), pa.int64()),
                                    pa.array(rows.tolist(), pa.list_(pa.float64()))], ["shard", "model", "steps", "values"])

        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "y", "fold")]
            for s, y, fold, x in zip(*columns, flat):
                fold = int(fold)
                if s != shard:
                    if shard is not None:
                        yield result()
                    shard, w, steps = int(s), start.copy(), 0
                    loss, seen = np.zeros(len(w)), np.zeros(len(w))
                steps += 1
                learns = (without != fold) & ~done
                with np.errstate(over="ignore", invalid="ignore"):
                    eta = eta0 / (first_step.get(shard, 0) + steps) ** POWER
                    error = w[:, :-1] @ x + w[:, -1] - y
                    shrunk = w[:, :-1] * np.where(ridge, np.maximum(1 - eta * alpha, 0), 1)[:, None]
                    new = shrunk - (eta * error)[:, None] * x
                    cut = np.where(lasso, eta * alpha, 0)[:, None]
                    w[:, :-1] = np.where(learns[:, None], np.sign(new) * np.maximum(np.abs(new) - cut, 0), w[:, :-1])
                    w[:, -1] = np.where(learns, w[:, -1] - eta * error, w[:, -1])
                    loss += np.where(learns, error * error / 2, 0)
                seen += learns
        if shard is not None:
            yield result()

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights of a model over its shards, by their rows; losses and rows are added."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for model, values in zip(batch.column("model").to_pylist(), batch.column("values").to_pylist()):
            row = np.array(values)
            row[:-2] *= row[-1]
            total[model] = total[model] + row if model in total else row
    yield pa.record_batch([pa.array(total, pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], ["model", "values"])


def descend(
    rows: DataFrame, models: list[Descent], *, key: str, max_iter: int = 60, tol: float | None = 1e-3, shards: int = 8, seed: int = 42
) -> list[Fitted]:
    """Every model fitted to ``rows`` (``as_features``), one pass over them an epoch for all.

    The rate of a step is ``eta0 / t ** 0.25``, ``t`` counting the steps of a shard through all epochs. A model stops once its loss
    has not fallen by ``tol`` below its best in ``PATIENCE`` epochs, or is no number any more, as when the rate is too
    high. Rows are stored once, by shard and in order; an epoch sends a row of weights per shard and model.
    """
    if any(m.penalty not in PENALTIES for m in models):
        raise ValueError(f"penalty must be one of {PENALTIES}")
    first = rows.select(F.size("x").alias("n")).first()
    dim = first["n"] if first else 0
    digest = hash_key(key, F.lit("order"), seed=seed)
    dealt = rows.select("x", "y", "fold", _hashed(hash_key(key, F.lit("shard"), seed=seed), shards).alias("shard"), digest.alias("at"), key)
    dealt = staged(dealt, "shards")
    # Kept where it was sorted; what is lost with an executor is dealt out again from the stored table.
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "at", key).select("shard", "x", "y", "fold").persist()
    w = np.zeros((len(models), dim + 1))
    done, best, waited = np.zeros(len(models), bool), np.full(len(models), np.inf), np.zeros(len(models), int)
    epochs, losses, step = np.zeros(len(models), int), np.full(len(models), np.nan), dict[int, int]()
    for _ in range(max_iter):
        if done.all() or not first:
            break
        out = ordered.mapInArrow(_epoch(models, w, done, dict(step)), "shard int, model int, steps long, values array<double>")
        out = staged(out, "epoch")
        for r in out.where("model = 0").select("shard", "steps").collect():  # a row for each shard
            step[r["shard"]] = step.get(r["shard"], 0) + r["steps"]
        summed = out.repartition("model").sortWithinPartitions("model", "shard").select("model", "values").mapInArrow(_averaged, "model int, values array<double>")
        for r in summed.collect():  # a row for each model
            m, values = r["model"], np.array(r["values"])
            if done[m] or not values[-1]:
                done[m] = True
                continue
            loss = values[-2] / values[-1]
            if not np.isfinite(values).all():
                done[m], losses[m] = True, np.inf
                continue
            w[m], losses[m] = values[:-2] / values[-1], loss
            epochs[m] += 1
            if tol is not None:
                waited[m] = waited[m] + 1 if loss > best[m] - tol else 0
                best[m] = min(best[m], loss)
                done[m] = waited[m] >= PATIENCE
    ordered.unpersist()
    return [Fitted(w[m, :-1], float(w[m, -1]), int(epochs[m]), float(losses[m])) for m in range(len(models))]


def predicted(rows: DataFrame, weights, intercept: float, name: str = "prediction"):
    """``rows`` with ``name``, the value of a linear model at ``x``, as a column expression."""
    terms = F.zip_with("x", F.array(*[F.lit(float(v)) for v in weights]), lambda a, b: a * b)
    return rows.withColumn(name, F.aggregate(terms, F.lit(float(intercept)), lambda total, v: total + v))


def grid_search(
    rows: DataFrame, *, key: str, alphas: list[float], eta0s: list[float], folds: int = 5, penalty: str | None = "l2", refit: bool = True, **descent
) -> tuple[list[tuple[float, float, float]], tuple[Descent, Fitted] | None]:
    """``[(alpha, eta0, mean squared error over the folds)]`` of every pair, and the best pair fitted to all ``rows``.

    ``rows`` come from ``as_features`` with the same number of folds. All pairs and folds learn in the same passes; their errors
    on the folds they have not seen come from one more. Of equal pairs the first is the best; one that
    diverges has an infinite error.
    """
    rows = staged(rows, "grid_rows")
    pairs = [(a, e) for a in alphas for e in eta0s]
    models = [Descent(a, e, penalty, f) for a, e in pairs for f in range(folds)]
    fitted = descend(rows, models, key=key, **descent)
    # A fold meets only the models that have not seen it.
    errors = []
    for f in range(folds):
        own = rows.where(F.col("fold") == f)
        for i in range(len(pairs)):
            m = fitted[i * folds + f]
            own = predicted(own, m.weights, m.intercept, f"_p{i}")
        errors.append(own.agg(F.lit(f).alias("fold"), *[F.avg(F.pow(F.col(f"_p{i}") - F.col("y"), 2.0)).alias(f"e{i}") for i in range(len(pairs))]))
    table = errors[0]
    for more in errors[1:]:
        table = table.unionByName(more)
    by_fold = table.collect()  # a row for each fold
    scores = []
    for i, (a, e) in enumerate(pairs):
        diverged = any(not np.isfinite(fitted[i * folds + f].loss) for f in range(folds))
        found = [r[f"e{i}"] for r in by_fold if r[f"e{i}"] is not None]
        scores.append((a, e, float("inf") if diverged or not found else float(np.mean(found))))
    best = min(range(len(scores)), key=lambda i: scores[i][2])
    chosen = Descent(*pairs[best], penalty)
    return scores, (chosen, descend(rows, [chosen], key=key, **descent)[0]) if refit else None


# --- ridge regression from sums ---------------------------------------------------------


@dataclass
class Moments:
    """Sums over rows with a constant 1 after their entries: what can be added and taken away."""

    n: int
    gram: np.ndarray
    cross: np.ndarray
    square: float

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.gram - other.gram, self.cross - other.cross, self.square - other.square)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.gram + other.gram, self.cross + other.cross, self.square + other.square)

    def ridge(self, alpha: float) -> np.ndarray:
        """Weights and intercept that minimise the mean of half the squared errors and ``alpha / 2`` times the squared weights."""
        penalty = np.full(len(self.cross), alpha * self.n)
        penalty[-1] = 0
        lower = np.linalg.cholesky(self.gram + np.diag(penalty))
        return np.linalg.solve(lower.T, np.linalg.solve(lower, self.cross))

    def mse(self, weights: np.ndarray) -> float:
        return float((self.square - 2 * weights @ self.cross + weights @ self.gram @ weights) / self.n)


def fold_moments(rows: DataFrame, dim: int) -> dict[int, Moments]:
    """The sums of each fold of ``rows`` (``as_features``) in one aggregate without Python: a row per
    fold and entry, combined before the shuffle."""
    z = F.concat("x", F.array(F.lit(1.0)))
    spread = rows.where(F.size("x") == dim).select("fold", "y", z.alias("z")).select("fold", "y", "z", F.posexplode("z").alias("i", "v"))
    sums = [F.sum(F.col("v") * F.get("z", F.lit(j))).alias(f"g{j}") for j in range(dim + 1)]
    found = spread.groupBy("fold", "i").agg(F.count("*").alias("n"), F.sum(F.col("v") * F.col("y")).alias("c"), F.sum(F.col("y") * F.col("y")).alias("s"), *sums)
    out: dict[int, Moments] = {}
    for r in found.collect():  # folds times entries
        m = out.setdefault(r["fold"], Moments(r["n"], np.zeros((dim + 1, dim + 1)), np.zeros(dim + 1), r["s"]))
        m.gram[r["i"]], m.cross[r["i"]] = [r[f"g{j}"] for j in range(dim + 1)], r["c"]
    return out


def ridge_search(moments: dict[int, Moments], alphas: list[float]) -> list[tuple[float, float]]:
    """``[(alpha, mean squared error over the folds)]`` for any number of penalties, from the sums alone; the rows a fold
    is not part of are all rows but its own."""
    whole = sum(list(moments.values())[1:], start=list(moments.values())[0])
    return [(a, float(np.mean([own.mse((whole - own).ridge(a)) for own in moments.values()]))) for a in alphas]
