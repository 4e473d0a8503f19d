"""Corpus figures that follow the intake: one mergeable row per shard, merged when they are read.

A shard's row holds its counts, its counts per band and a quantile sketch of each metric. Scoring a shard again
replaces its row, so a repeated batch changes nothing, and no figure needs the articles once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .scoring import BANDS, METRIC_COLUMNS, PERCENT_STEPS, Band

# Size of a sketch: with 99 % confidence the rank of a quantile is off by less than ``RANK_ERROR``.
SKETCH_SIZE = 200
RANK_ERROR = 0.0133
SCHEMA = (
    "articles long, tokens long, bytes long, bands array<struct<band: string, documents: bigint, tokens: bigint>>, "
    + ", ".join(f"{column} binary" for column in METRIC_COLUMNS.values())
    + ", shard string"
)


def shard_figures(scored: DataFrame, tokens: Column, *, bands: list[Band] = BANDS, text: str = "text", shard: str = "shard") -> DataFrame:
    """A row per shard of scored articles; each task sends one row a shard, whatever the number of articles."""
    cells = []
    for i, band in enumerate(bands):
        cells += [F.count_if(band.contains()).alias(f"d{i}"), F.coalesce(F.sum(F.when(band.contains(), tokens)), F.lit(0)).cast("long").alias(f"t{i}")]
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_SIZE)).alias(c) for c in METRIC_COLUMNS.values()]
    sums = scored.groupBy(F.col(shard).alias("shard")).agg(
        F.count("*").alias("articles"), F.coalesce(F.sum(tokens.cast("long")), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).alias("bytes"), *cells, *sketches,
    )
    rows = [F.struct(F.lit(b.label).alias("band"), F.col(f"d{i}").alias("documents"), F.col(f"t{i}").alias("tokens")) for i, b in enumerate(bands)]
    return sums.select("articles", "tokens", "bytes", F.array(*rows).alias("bands"), *METRIC_COLUMNS.values(), "shard")


def store_figures(figures: DataFrame, path: str) -> None:
    """Put the rows of some shards in place of what ``path`` has of them; other shards stay."""
    figures.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def merged_corpus(figures: DataFrame) -> DataFrame:
    """Articles, tokens and bytes of all shards, as ``corpus_figures`` of their articles."""
    return figures.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("articles", "tokens", "bytes")])


def merged_bands(figures: DataFrame) -> DataFrame:
    """``band, documents, tokens, share`` of all shards, as ``band_summary`` of their articles."""
    rows = figures.select("articles", F.inline("bands")).groupBy("band").agg(
        F.sum("documents").alias("documents"), F.sum(F.col("tokens")).alias("tokens"), F.sum("articles").alias("_all")
    )
    return rows.select("band", "documents", "tokens", F.round(F.try_divide("documents", "_all"), 6).alias("share"))


def merged_percentiles(figures: DataFrame, percents: list[float] = PERCENT_STEPS) -> DataFrame:
    """``metric, pct, value``: values of the articles whose ranks are within ``RANK_ERROR`` of the percentiles."""
    shares = F.array(*[F.lit(p / 100) for p in percents])
    pcts = F.array(*[F.lit(float(p)) for p in percents])
    whole = figures.agg(*[F.kll_merge_agg_double(c, F.lit(SKETCH_SIZE)).alias(c) for c in METRIC_COLUMNS.values()])
    rows = [
        # An empty corpus has no quantiles.
        F.when(F.kll_sketch_get_n_double(c) > 0, F.struct(F.lit(metric).alias("metric"), F.kll_sketch_get_quantile_double(c, shares).alias("values")))
        for metric, c in METRIC_COLUMNS.items()
    ]
    found = whole.select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r"))
    return found.select("r.metric", F.inline(F.arrays_zip(pcts.alias("pct"), F.col("r.values").alias("value"))))
