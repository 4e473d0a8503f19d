"""Figures per shard: replaced, merged, and kept by the intake."""

import random

import pytest
from pyspark.sql import functions as F

from corposcope.operators import figures as FG, scoring as S

def tokens():
    return F.size(F.split("text", " "))


def scored(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = [(i, "word " * (i % 5), rng.randrange(300), 0.0 if i % 3 else rng.random() * 3, rng.random(), f"s{i % 7}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string, h_index int, sjr double, random double, shard string").repartition(4)


def bands_of(df):
    return sorted(map(tuple, df.select("band", "documents", "tokens", "share").collect()))


def test_shards_are_replaced_and_merged(spark, tmp_path):
    rows, path = scored(spark), str(tmp_path / "figures")
    wrong = rows.where("shard in ('s1', 's2')").withColumn("text", F.lit("lost batch"))
    for part in (wrong, rows.where("shard < 's3'"), rows.where("shard >= 's3'"), rows.where("shard = 's5'")):
        FG.store_figures(FG.shard_figures(part, tokens()), path)
    figures = FG.read_figures(spark, path)
    assert figures.count() == 7
    assert FG.merged_corpus(figures).first() == S.corpus_figures(rows, tokens()).first()
    assert bands_of(FG.merged_bands(figures)) == bands_of(S.band_summary(rows, tokens()))


def test_percentiles_are_near(spark, tmp_path):
    rows = scored(spark, 4000)
    merged = {(r["metric"], r["pct"]): r["value"] for r in FG.merged_percentiles(FG.shard_figures(rows, tokens())).collect()}
    assert len(merged) == 21
    for metric, column in S.METRIC_COLUMNS.items():
        values = sorted(r[0] for r in rows.select(column).collect())
        for p in S.PERCENT_STEPS:
            low, high = (values[int((p / 100 + side * 2 * FG.RANK_ERROR) * (len(values) - 1))] for side in (-1, 1))
            assert low <= merged[metric, p] <= high


def test_nulls_and_no_rows(spark):
    schema = "id long, text string, h_index int, sjr double, random double, shard string"
    none = FG.shard_figures(spark.createDataFrame([], schema), tokens())
    assert none.count() == 0 and tuple(FG.merged_corpus(none).first()) == (0, 0, 0) and FG.merged_percentiles(none).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None, "a"), (2, "x y", 5, None, 0.5, None)], schema)
    figures = FG.shard_figures(odd, tokens())
    assert tuple(FG.merged_corpus(figures).first()) == tuple(S.corpus_figures(odd, tokens()).first())
    assert {r["metric"] for r in FG.merged_percentiles(figures).collect()} == {"h-index", "random"}


@pytest.mark.parametrize("again", [False, True])
def test_intake_keeps_figures(spark, tmp_path, again):
    from corposcope.streaming.intake import start_intake
    from test_articles import ODD, write

    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    profiles = spark.sql("select '1234567X' issn, 40 h_index, array(struct(2000 as year, 1.25D as sjr)) metrics")
    write(source / "one0001.xml.gz", ODD)
    for turn in range(2):
        start_intake(spark, str(source), profiles, target, str(tmp_path / ("state" if turn or not again else "lost")), tokens=tokens()).awaitTermination()
        write(source / "two0002.xml.gz", ODD.replace(">18<", ">19<").replace(" 17 ", "20"))
    landed = spark.read.schema("id long, text string, h_index int, sjr double, random double, shard string").json(f"{target}/scored")
    figures = FG.read_figures(spark, f"{target}/figures")
    assert sorted(r["shard"] for r in figures.collect()) == ["one0001", "two0002"]
    assert FG.merged_corpus(figures).first() == S.corpus_figures(landed.dropDuplicates(["id"]), tokens()).first()
