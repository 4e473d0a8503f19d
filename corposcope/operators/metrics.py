"""Evaluation metrics as aggregates.

Every function reduces rows to a few counts or sums with map-side combining;
the formulas then run on the small aggregate. ``by`` names grouping columns
(for example the run), empty for one overall row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

AVERAGES = ("binary", "micro", "macro", "weighted", "samples", None)


def _weight(weight: str | None) -> Column:
    return F.lit(1.0) if weight is None else F.col(weight).cast("double")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def accuracy(
    df: DataFrame, predicted: str, reference: str, *,
    normalize: bool = True, weight: str | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """Share (or weight) of equal labels; arrays count when they are equal as a whole."""
    w = _weight(weight)
    right = F.sum(F.when(F.col(predicted) == F.col(reference), w).otherwise(0.0))
    value = F.try_divide(right, F.sum(w)) if normalize else right
    return df.groupBy(*by).agg(value.alias("accuracy"))


def visible_accuracy(df: DataFrame, predicted: str, labels: str, *, ignored: int = -100) -> DataFrame:
    """Accuracy over the positions of two parallel arrays whose label is not ignored."""
    pairs = F.zip_with(
        predicted, labels, lambda p, l: F.when(l != ignored, (p == l).cast("int"))
    )
    seen = F.filter(pairs, lambda x: x.isNotNull())
    counted = df.select(
        F.size(seen).alias("n"), F.size(F.filter(seen, lambda x: x == 1)).alias("hits")
    )
    return counted.agg(F.try_divide(F.sum("hits"), F.sum("n")).alias("accuracy"), F.sum("n").alias("positions"))


def label_counts(
    df: DataFrame, predicted: str, reference: str, *,
    weight: str | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """``(label, tp, n_pred, n_ref)`` for single labels or 0/1 vectors."""
    w = _weight(weight).alias("w")
    if isinstance(df.schema[predicted].dataType, ArrayType):
        pairs = F.arrays_zip(F.col(predicted).alias("p"), F.col(reference).alias("r"))
        cells = df.select(*by, w, F.posexplode(pairs).alias("label", "x"))
        p, r = F.col("x.p") == 1, F.col("x.r") == 1
        return cells.groupBy(*by, "label").agg(
            F.sum(F.when(p & r, F.col("w")).otherwise(0.0)).alias("tp"),
            F.sum(F.when(p, F.col("w")).otherwise(0.0)).alias("n_pred"),
            F.sum(F.when(r, F.col("w")).otherwise(0.0)).alias("n_ref"),
        )
    # A table of label pairs is small, so the two rows per pair are made after it.
    pairs = df.select(*by, w, F.col(predicted).alias("p"), F.col(reference).alias("r"))
    table = pairs.groupBy(*by, "p", "r").agg(F.sum("w").alias("w"))
    sides = F.array(
        F.struct(F.col("p").alias("label"), F.col("w").alias("n_pred"), F.lit(0.0).alias("n_ref"),
                 F.when(F.col("p") == F.col("r"), F.col("w")).otherwise(0.0).alias("tp")),
        F.struct(F.col("r").alias("label"), F.lit(0.0).alias("n_pred"), F.col("w").alias("n_ref"),
                 F.lit(0.0).alias("tp")),
    )
    return table.select(*by, F.inline(sides)).groupBy(*by, "label").agg(
        F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"), F.sum("n_ref").alias("n_ref")
    )


def f1(
    df: DataFrame, predicted: str, reference: str, *,
    average: str | None = "binary", labels: list | None = None, pos_label: int | str = 1,
    weight: str | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """F1 score; ``average=None`` gives one row per label. A label that is
    neither predicted nor present scores 0."""
    if average not in AVERAGES:
        raise ValueError(f"average must be one of {AVERAGES}")
    if average == "samples":
        return _f1_samples(df, predicted, reference, weight, by)
    counts = label_counts(df, predicted, reference, weight=weight, by=by)
    if average == "binary":
        labels = [pos_label]
    if labels is not None:
        # Every group has every asked label, also one that occurs in none of its rows.
        kind = counts.schema["label"].dataType
        asked = F.array(*[F.lit(str(l)) for l in labels]).cast(ArrayType(kind))
        groups = df.select(*by).distinct() if by else df.sparkSession.range(1)
        absent = groups.select(*by, F.explode(asked).alias("label"), *[F.lit(0.0).alias(c) for c in ("tp", "n_pred", "n_ref")])
        counts = counts.where(F.col("label").isin(labels)).unionByName(absent).groupBy(*by, "label").agg(
            F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"), F.sum("n_ref").alias("n_ref")
        )
    score = _ratio(2 * F.col("tp"), F.col("n_pred") + F.col("n_ref"))
    if average is None:
        return counts.select(*by, "label", score.alias("f1"))
    if average == "micro":
        value = _ratio(2 * F.sum("tp"), F.sum("n_pred") + F.sum("n_ref"))
    elif average == "weighted":
        value = _ratio(F.sum(score * F.col("n_ref")), F.sum("n_ref"))
    else:
        value = F.avg(score)
    return counts.groupBy(*by).agg(value.alias("f1"))


def _f1_samples(df, predicted, reference, weight, by) -> DataFrame:
    if not isinstance(df.schema[predicted].dataType, ArrayType):
        raise ValueError("average='samples' needs 0/1 vectors")

    def ones(flags: Column) -> Column:
        return F.size(F.filter(flags, lambda v: v == 1))

    both = F.zip_with(predicted, reference, lambda p, r: F.when((p == 1) & (r == 1), 1).otherwise(0))
    score = _ratio(2 * ones(both), ones(F.col(predicted)) + ones(F.col(reference)))
    w = _weight(weight)
    return df.groupBy(*by).agg(F.try_divide(F.sum(score * w), F.sum(w)).alias("f1"))


def mse(
    df: DataFrame, predicted: str, reference: str, *,
    weight: str | None = None, multioutput: str | list[float] = "uniform_average",
    squared: bool = True,
) -> DataFrame:
    """Mean squared error of numbers or vectors; ``squared=False`` takes the root
    per output. ``raw_values`` gives one row per output, a list weighs the outputs."""
    w = _weight(weight).alias("w")
    if isinstance(df.schema[predicted].dataType, ArrayType):
        gaps = F.zip_with(
            predicted, reference, lambda p, r: F.pow(p.cast("double") - r.cast("double"), F.lit(2.0))
        )
        rows = df.select(w, F.posexplode(gaps).alias("output", "e"))
    else:
        gap = F.col(predicted).cast("double") - F.col(reference).cast("double")
        rows = df.select(w, F.lit(0).alias("output"), F.pow(gap, F.lit(2.0)).alias("e"))
    error = F.try_divide(F.sum(F.col("w") * F.col("e")), F.sum("w"))
    outputs = rows.groupBy("output").agg((error if squared else F.sqrt(error)).alias("mse"))
    if multioutput == "raw_values":
        return outputs
    if multioutput == "uniform_average":
        return outputs.agg(F.avg("mse").alias("mse"))
    share = F.get(F.array(*[F.lit(float(x)) for x in multioutput]), F.col("output"))
    return outputs.agg(F.try_divide(F.sum(share * F.col("mse")), F.sum(share)).alias("mse"))


def pearson_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation ``r`` of ``n`` pairs under no association.

    The density of a correlation is ``(1 - x^2)^(a - 1)`` with ``a = n / 2 - 1``. With ``1 - x^2 = exp(-v^2)`` its tail is the
    integral of ``exp(-a v^2) v / sqrt(1 - exp(-v^2))``, smooth and alike for any ``n``: the tail beyond ``r`` over
    the tail beyond 0, each by the same Gaussian quadrature from its start to where nothing is left.
    """
    places, weights = np.polynomial.legendre.leggauss(64)
    nodes = F.array(*[F.struct(F.lit((x + 1) / 2).alias("x"), F.lit(w / 2).alias("w")) for x, w in zip(places.tolist(), weights.tolist())])
    a = n.cast("double") / 2 - 1
    zero = F.lit(0.0)

    def tail(start: Column) -> Column:
        end = F.sqrt(start * start + 40) - start

        def term(node: Column) -> Column:
            y = node["x"] * end
            v = (start + y) / F.sqrt(a)
            return node["w"] * F.exp(-y * (2 * start + y)) * v / F.sqrt(-F.expm1(-v * v))

        return end * F.aggregate(nodes, zero, lambda total, node: total + term(node))

    start = F.sqrt(-a * F.log1p(-r * r))
    p = F.exp(-start * start) * tail(start) / tail(zero)
    known = r.isNotNull() & ~F.isnan(r) & (n >= 2)
    return F.when(known, F.when(n == 2, F.lit(1.0)).when(F.abs(r) >= 1, zero).otherwise(F.least(p, F.lit(1.0))))


def pearson(
    df: DataFrame, predicted: str, reference: str, *, pvalue: bool = False, by: tuple[str, ...] = ()
) -> DataFrame:
    """Pearson correlation, with the p-value on request."""
    x, y = F.col(predicted).cast("double"), F.col(reference).cast("double")
    both = F.count_if(x.isNotNull() & y.isNotNull())
    row = df.groupBy(*by).agg(F.corr(x, y).alias("pearsonr"), both.alias("_n"))
    if pvalue:
        row = row.withColumn("p_value", pearson_pvalue(F.col("pearsonr"), F.col("_n")))
    return row.drop("_n")


def perplexity(df: DataFrame, loss: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``exp(mean loss)``; infinite when that overflows."""
    return df.groupBy(*by).agg(F.exp(F.avg(loss)).alias("perplexity"))


def mean_loss(df: DataFrame, loss: str, by: tuple[str, ...] = ("run", "epoch")) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(loss).alias("train_loss"), F.count(loss).alias("steps"))


def combined_score(records: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Mean of the metrics of a record ``(by, metric, value)`` that has more than one."""
    scores = records.groupBy(*by).agg(F.avg("value").alias("combined_score"), F.count("*").alias("_n"))
    return scores.where("_n > 1").drop("_n")
