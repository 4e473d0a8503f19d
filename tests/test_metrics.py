"""Published example values and edge cases of the metrics."""

import math

import pytest
from pyspark.sql import functions as F

from corposcope.operators import metrics as M


def rows(spark, *columns, schema):
    return spark.createDataFrame(list(zip(*columns)), schema)


def value(df):
    return df.first()[0]


REF, PRED = [0, 1, 2, 0, 1, 2], [0, 1, 1, 2, 1, 0]


def test_accuracy(spark):
    df = rows(spark, PRED, REF, [0.5, 2.0, 0.7, 0.5, 9.0, 0.4], schema="p int, r int, w double")
    assert value(M.accuracy(df, "p", "r")) == 0.5
    assert value(M.accuracy(df, "p", "r", normalize=False)) == 3.0
    assert value(M.accuracy(df, "p", "r", weight="w")) == pytest.approx(0.8778625954198473)


def test_f1_binary(spark):
    df = rows(spark, [0, 0, 1, 1, 0], [0, 1, 0, 1, 0], [0.9, 0.5, 3.9, 1.2, 0.3], schema="p int, r int, w double")
    assert value(M.f1(df, "p", "r")) == 0.5
    assert round(value(M.f1(df, "p", "r", pos_label=0)), 2) == 0.67
    assert round(value(M.f1(df, "p", "r", weight="w")), 2) == 0.35


@pytest.mark.parametrize("average, expected", [("macro", 0.27), ("micro", 0.33), ("weighted", 0.27)])
def test_f1_multiclass(spark, average, expected):
    df = rows(spark, [0, 2, 1, 0, 0, 1], REF, schema="p int, r int")
    assert round(value(M.f1(df, "p", "r", average=average)), 2) == expected


def test_f1_per_label(spark):
    df = rows(spark, [0, 2, 1, 0, 0, 1], REF, schema="p int, r int")
    got = {r["label"]: r["f1"] for r in M.f1(df, "p", "r", average=None).collect()}
    assert got == {0: pytest.approx(0.8), 1: 0.0, 2: 0.0}


def test_f1_of_text_labels(spark):
    df = rows(spark, ["a", "b", "b"], ["a", "b", "a"], schema="p string, r string")
    assert value(M.f1(df, "p", "r", pos_label="b")) == pytest.approx(2 / 3)
    assert value(M.f1(df, "p", "r", average="macro", labels=["a", "z"])) == pytest.approx(1 / 3)


def test_f1_multilabel(spark):
    df = rows(spark, [[0, 1, 1], [1, 1, 0]], [[0, 1, 1], [0, 1, 0]], schema="p array<int>, r array<int>")
    assert round(value(M.f1(df, "p", "r", average="macro")), 2) == 0.67
    assert value(M.f1(df, "p", "r", average="samples")) == pytest.approx((1 + 2 / 3) / 2)


def test_f1_arguments(spark):
    df = rows(spark, [0], [0], schema="p int, r int")
    with pytest.raises(ValueError):
        M.f1(df, "p", "r", average="mean")
    with pytest.raises(ValueError):
        M.f1(df, "p", "r", average="samples")


def test_mse(spark):
    df = rows(spark, [2.5, 0.0, 2.0, 8.0], [3.0, -0.5, 2.0, 7.0], schema="p double, r double")
    assert value(M.mse(df, "p", "r")) == 0.375
    assert value(M.mse(df, "p", "r", squared=False)) == 0.6123724356957945


def test_mse_outputs(spark):
    p, r = [[0.5, 1.0], [-1.0, 1.0], [7.0, -6.0]], [[0.0, 2.0], [-1.0, 2.0], [8.0, -5.0]]
    df = rows(spark, p, r, schema="p array<double>, r array<double>")
    assert value(M.mse(df, "p", "r")) == pytest.approx(0.7083333333333334)
    raw = {x["output"]: x["mse"] for x in M.mse(df, "p", "r", multioutput="raw_values").collect()}
    assert raw == {0: pytest.approx(0.41666667), 1: pytest.approx(1.0)}
    assert value(M.mse(df, "p", "r", multioutput=[0.3, 0.7])) == pytest.approx(0.825)


def test_pearson(spark):
    df = rows(spark, [10.0, 9.0, 2.5, 6.0, 4.0], [1.0, 2.0, 3.0, 4.0, 5.0], schema="p double, r double")
    got = M.pearson(df, "p", "r", pvalue=True).first()
    assert round(got["pearsonr"], 2) == -0.74
    assert round(got["p_value"], 2) == 0.15


def pvalue(spark, r, n):
    return spark.createDataFrame([(r, n)], "r double, n long").select(M.pearson_pvalue(F.col("r"), F.col("n"))).first()[0]


@pytest.mark.parametrize("n", [3, 4, 6, 12, 200])
@pytest.mark.parametrize("r", [0.02, 0.3, 0.8, 0.99])
def test_pvalue_against_integration(spark, r, n):
    """The tail equals the numeric integral of the density (1 - x^2)^(n/2 - 2)."""
    a = n / 2 - 1

    def mass(low, high, steps=20_000):
        # Substituting x = sin(t) removes the singular ends.
        lo, hi = math.asin(low), math.asin(high)
        h = (hi - lo) / steps
        return sum(math.cos(lo + (i + 0.5) * h) ** (2 * a - 1) for i in range(steps)) * h

    expected = 1 - mass(0, r) / mass(0, 1)
    assert pvalue(spark, r, n) == pytest.approx(expected, abs=1e-6)


def test_pvalues_at_the_ends(spark):
    """Closed forms: three pairs give an arc, four a line; very many pairs are normal."""
    for r in (1e-9, 0.1, 0.7, 0.999999):
        assert pvalue(spark, r, 3) == pytest.approx(1 - 2 * math.asin(r) / math.pi, rel=1e-9)
        assert pvalue(spark, -r, 4) == pytest.approx(1 - r, rel=1e-9)
    z = 2.5
    assert pvalue(spark, z / 1e5, 10**10) == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-8)
    assert [pvalue(spark, r, n) for r, n in ((1.0, 9), (-1.0, 3), (0.5, 2), (0.0, 7))] == [0, 0, 1, pytest.approx(1)]
    assert [pvalue(spark, r, n) for r, n in ((None, 9), (math.nan, 9), (0.5, 1))] == [None] * 3


def test_perplexity_overflows_to_infinity(spark):
    df = spark.createDataFrame([(1000.0,), (900.0,)], "loss double")
    assert value(M.perplexity(df, "loss")) == math.inf


def test_visible_accuracy(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, -100, 4]), ([5], [5])], "p array<int>, l array<int>")
    got = M.visible_accuracy(df, "p", "l").first()
    assert (got["accuracy"], got["positions"]) == (pytest.approx(2 / 3), 3)


def test_combined_score_needs_two_metrics(spark):
    df = spark.createDataFrame([("a", "f1", 0.5), ("a", "acc", 1.0), ("b", "f1", 0.3)], "run string, metric string, value double")
    assert [tuple(r) for r in M.combined_score(df, ("run",)).collect()] == [("a", 0.75)]
