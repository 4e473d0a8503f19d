"""Journal metrics for articles, metric bands and corpus figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordering import sorted_table
from .cleaning import article_text, normal_issn, valid_articles, with_random_key
from .lookup import lookup_join

# Column that holds each selectable metric.
METRIC_COLUMNS = {"sjr": "sjr", "h-index": "h_index", "random": "random"}


@dataclass(frozen=True)
class Band:
    """A closed metric interval; no metric means the whole corpus."""

    metric: str
    low: float | None
    high: float | None
    name: str

    @property
    def label(self) -> str:
        return f"{self.metric}_{self.name}"

    def contains(self) -> Column:
        if self.metric == "none":
            return F.lit(True)
        return F.col(METRIC_COLUMNS[self.metric]).between(self.low, self.high)


# The selection bands.
BANDS = [
    Band("none", None, None, "all"),
    Band("random", 0.0, 0.5, "50%"),
    Band("random", 0.0, 0.25, "25%"),
    Band("h-index", 103.0, 1400.0, "top50%"),
    Band("h-index", 53.0, 190.0, "mid50%"),
    Band("h-index", 190.0, 1400.0, "top25%"),
    Band("h-index", 77.0, 142.0, "mid25%"),
    Band("sjr", 1.312, 100.0, "top25%"),
    Band("sjr", 0.462, 0.984, "mid25%"),
    Band("sjr", 0.759, 100.0, "top50%"),
]


def nearest_year_metric(metrics: Column, year: Column) -> Column:
    """Metric of the year closest to ``year``; of two equally close years the earlier one.

    Years before the first or after the last take the end of the list, which
    also covers a missing year given as 0.
    """
    ranked = F.transform(
        metrics,
        lambda m: F.struct(
            F.abs(m["year"] - year).alias("gap"), m["year"].alias("year"), m["sjr"].alias("sjr")
        ),
    )
    return F.array_min(ranked)["sjr"]


def with_journal_metrics(
    articles: DataFrame, profiles: DataFrame, *, shuffled: bool = False
) -> DataFrame:
    """Add ``h_index`` and the nearest-year ``sjr``; unknown journals score 0.

    ``articles`` needs a normalised ``issn`` and ``year``. Each article meets at
    most one row of the dimension, so nothing fans out, and while the dimension
    fits a broadcast the articles stay where they are.
    """
    joined = lookup_join(articles, profiles, "issn", "left", shuffled=shuffled)
    return joined.select(
        *articles.columns,
        F.coalesce("h_index", F.lit(0)).cast("int").alias("h_index"),
        F.coalesce(nearest_year_metric(F.col("metrics"), F.col("year")), F.lit(0.0)).alias("sjr"),
    )


def score_articles(articles: DataFrame, profiles: DataFrame, *, seed: int = 0, **join) -> DataFrame:
    """Valid articles as ``id, text, h_index, sjr, random``; other columns follow."""
    known = ("id", "title", "abstract", "issn", "language", "year", "month", "day")
    extra = [c for c in articles.columns if c not in known]
    rows = valid_articles(articles).withColumn("issn", normal_issn(F.col("issn")))
    scored = with_random_key(with_journal_metrics(rows, profiles, **join), "id", seed)
    return scored.select("id", article_text().alias("text"), "h_index", "sjr", "random", *extra)


def in_journals(articles: DataFrame, journals: DataFrame, *, known: bool = True, **join) -> DataFrame:
    """Articles whose journal is (or is not) in the dimension."""
    how = "left_semi" if known else "left_anti"
    return lookup_join(articles, journals.select("issn").distinct(), "issn", how, **join)


def select_band(df: DataFrame, metric: str, low: float, high: float) -> DataFrame:
    """Rows with ``low <= metric <= high``."""
    return df.where(_band_condition(metric, low, high))


def select_band_in_train(df: DataFrame, metric: str, low: float, high: float) -> DataFrame:
    """The same on the training split only; other splits pass whole."""
    return df.where((F.col("split") != "train") | _band_condition(metric, low, high))


def _band_condition(metric: str, low: float, high: float) -> Column:
    if metric not in METRIC_COLUMNS:
        raise ValueError(f"metric must be one of {sorted(METRIC_COLUMNS)}")
    if low is None or high is None:
        raise ValueError("a band needs both bounds")
    if low >= high:
        raise ValueError("the lower bound must be below the upper bound")
    return F.col(METRIC_COLUMNS[metric]).between(low, high)


def band_membership(df: DataFrame, bands: list[Band] = BANDS) -> DataFrame:
    """One row per document and band that holds it; the bands are part of the plan."""
    labels = F.array(*[F.when(b.contains(), F.lit(b.label)) for b in bands])
    held = F.filter(labels, lambda label: label.isNotNull())
    # The outer form keeps Spark from testing every band a second time as a filter.
    return df.withColumn("band", F.explode_outer(held)).where("band is not null")


def band_summary(df: DataFrame, tokens: Column, bands: list[Band] = BANDS) -> DataFrame:
    """Documents, tokens and share of the corpus per band, from one pass.

    Every band is a pair of conditional aggregates, so each task sends a single
    row whatever the size of the corpus.
    """
    cells = []
    for i, band in enumerate(bands):
        cells.append(F.count_if(band.contains()).alias(f"d{i}"))
        cells.append(F.coalesce(F.sum(F.when(band.contains(), tokens)), F.lit(0)).alias(f"t{i}"))
    wide = df.agg(F.count("*").alias("total"), *cells)
    rows = F.array(
        *[
            F.struct(
                F.lit(b.label).alias("band"),
                F.col(f"d{i}").alias("documents"),
                F.col(f"t{i}").cast("long").alias("tokens"),
            )
            for i, b in enumerate(bands)
        ]
    )
    return wide.select("total", F.inline(rows)).select(
        "band", "documents", "tokens", F.round(F.try_divide("documents", "total"), 6).alias("share")
    )


def corpus_figures(df: DataFrame, tokens: Column, text: str = "text") -> DataFrame:
    """Articles, tokens and bytes of the corpus."""
    return df.agg(
        F.count("*").alias("articles"),
        F.sum(tokens.cast("long")).alias("tokens"),
        F.sum(F.octet_length(text).cast("long")).alias("bytes"),
    )


def training_budget(
    figures: DataFrame,
    *,
    train_share: float = 0.95,
    target_batch: int = 8192,
    devices: int = 2,
    device_batch: int = 32,
    length: int = 512,
) -> DataFrame:
    """Gradient accumulation, tokens per step and steps for one epoch."""
    per_step = target_batch * length
    return figures.select(
        F.lit(target_batch // (devices * device_batch)).cast("long").alias("accumulation"),
        F.lit(per_step).cast("long").alias("tokens_per_step"),
        F.floor(F.col("tokens") * F.lit(train_share) / per_step).cast("long").alias("steps"),
    )


# Eighths, as percentages.
PERCENT_STEPS = [12.5, 25.0, 37.5, 50.0, 62.5, 75.0, 87.5]


def exact_percentiles(df: DataFrame, column: str, percents: list[float] = PERCENT_STEPS) -> DataFrame:
    """``(pct, value)``: exact percentiles with linear interpolation.

    Equal values are counted first, so a value that fills a third of the rows
    is one row afterwards. The distinct values are sorted by ranges and written;
    running sums go over the files and inside each, so no task sees all of them.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count("*").alias("n")
    )
    ranged = sorted_table(counts, F.asc("v"), name="values")
    starts = ranged.groupBy("_file").agg(F.sum("n").alias("_rows")).select(
        "_file",
        (F.sum("_rows").over(Window.orderBy("_file")) - F.col("_rows")).alias("_start"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_file").orderBy("_index")
    # One row per written file: bounded by the number of shuffle partitions.
    placed = ranged.withColumn("_through", F.sum("n").over(inside)).join(F.broadcast(starts), "_file")
    first = F.col("_start") + F.col("_through") - F.col("n")
    wanted = F.array(*[F.lit(float(p)) for p in percents])

    def covers(p: Column) -> Column:
        at = p / 100 * (F.col("_total") - 1)
        return (F.ceil(at) >= F.col("_first")) & (F.floor(at) < F.col("_first") + F.col("n"))

    hits = (
        placed.withColumn("_first", first)
        .withColumn("pct", F.explode(F.filter(wanted, covers)))
        .withColumn("_at", F.col("pct") / 100 * (F.col("_total") - 1))
    )
    low, high = F.min("v"), F.max("v")
    part = F.first(F.col("_at") - F.floor("_at"))
    return hits.groupBy("pct").agg((low + part * (high - low)).alias("value"))
