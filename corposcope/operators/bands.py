"""Metric bands that come as a table: any number of them, overlapping, both ends included.

The ends of all bands of a metric cut its axis into cells: each end is a cell, and so is each gap between
neighbouring ends. A value finds its cell by binary search in the sorted ends, a band covers a run of cells, which is
a few aligned runs of 1, 2, 4, ... cells. Membership is an equi join on these, and no value is compared with every band.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable
from .scoring import METRIC_COLUMNS

# The ends are part of the plan; a table with more of them is a mistake.
MOST_ENDS = 1_000_000
# So many ends, with a few rows each, may be sent around.
SENT_ENDS = 50_000


def _ends(bands: DataFrame) -> dict[str, list[float]]:
    """Per metric its sorted distinct ends; open ends have none."""
    ends = bands.select("metric", F.explode(F.array("low", "high")).alias("v")).where("v is not null").distinct()
    if ends.count() > MOST_ENDS:
        raise ValueError(f"more than {MOST_ENDS} ends of bands")
    out: dict[str, list[float]] = {}
    for r in ends.groupBy("metric").agg(F.sort_array(F.collect_list("v")).alias("vs")).collect():
        out[r["metric"]] = r["vs"]
    return out


def cell_of(value: Column, ends: list[float]) -> Column:
    """Twice the number of ends below a value, and one more on an end: by halving, whatever the number of ends."""
    table = F.from_json(F.lit(json.dumps(ends)), "array<double>")
    value = value.cast("double")
    rounds = max(len(ends), 1).bit_length()
    span = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        F.struct(F.lit(0).alias("low"), F.lit(len(ends)).alias("high")),
        lambda s, _: F.when(
            s["low"] < s["high"],
            F.when(
                F.get(table, F.shiftright(s["low"] + s["high"], 1)) < value,
                F.struct((F.shiftright(s["low"] + s["high"], 1) + 1).alias("low"), s["high"].alias("high")),
            ).otherwise(F.struct(s["low"].alias("low"), F.shiftright(s["low"] + s["high"], 1).alias("high"))),
        ).otherwise(s),
    )["low"]
    # Found once; the end itself is looked up with the number of ends below the value.
    return F.element_at(F.transform(F.array(span), lambda a: 2 * a + F.coalesce(F.get(table, a) == value, F.lit(False)).cast("int")), 1)


def checked_bands(bands: DataFrame) -> DataFrame:
    """``metric, low, high, band``; an unknown metric or a band that is upside down fails the job."""
    known = F.col("metric").isin("none", *METRIC_COLUMNS)
    wrong = ~known | F.coalesce(F.col("low") >= F.col("high"), F.lit(False))
    label = F.concat_ws("_", "metric", "name")
    checked = F.when(F.coalesce(wrong, F.lit(True)), F.raise_error(F.concat(F.lit("not a band: "), label)).cast("string")).otherwise(label)
    return bands.select("metric", "low", "high", checked.alias("band"))


def band_nodes(bands: DataFrame, ends: dict[str, list[float]]) -> DataFrame:
    """``(metric, level, node, band)``: the cells each band covers, as the fewest aligned runs of two to the power
    ``level`` cells, at most two of a level; the whole axis for a metric of ``none``."""
    parts = []
    for metric, values in {"none": [], **ends}.items():
        first = F.when(F.col("low").isNull(), F.lit(0)).otherwise(cell_of(F.col("low"), values))
        last = F.when(F.col("high").isNull(), F.lit(2 * len(values))).otherwise(cell_of(F.col("high"), values))
        own = bands.where(F.col("metric") == metric).select("metric", "band", first.alias("_first"), (last + 1).alias("_stop"))
        levels = range((2 * len(values) + 1).bit_length())
        parts.append(own.select("metric", F.explode(F.flatten(F.array(*[_aligned(level) for level in levels]))).alias("_n"), "band"))
    # A metric none of whose bands has an end has one cell.
    bare = bands.where(~F.col("metric").isin("none", *ends))
    parts.append(bare.select("metric", F.struct(F.lit(0).alias("level"), F.lit(0).alias("node")).alias("_n"), "band"))
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    return nodes.select("metric", "_n.level", "_n.node", "band")


def _aligned(level: int) -> Column:
    """The runs of a level that ``_first`` up to ``_stop`` takes: an odd one at either end, as an even one belongs to a larger run."""
    size = 1 << level
    low = F.shiftright(F.col("_first") + (size - 1), level)
    stop = F.shiftright(F.col("_stop"), level)
    run = lambda node: F.struct(F.lit(level).alias("level"), node.cast("int").alias("node"))
    left = F.when((low < stop) & (low % 2 == 1), run(low))
    right = F.when((low < stop) & (stop % 2 == 1), run(stop - 1))
    return F.filter(F.array(left, right), lambda n: n.isNotNull())


def with_nodes(cells: DataFrame, ends: dict[str, list[float]]) -> DataFrame:
    """``cells`` once for each aligned run that holds the cell."""
    levels = F.sequence(F.lit(0), F.lit(_levels(ends) - 1))
    runs = F.transform(levels, lambda i: F.struct(i.alias("level"), F.call_function("shiftright", F.col("cell"), i).alias("node")))
    return cells.select("*", F.inline(runs))


def _levels(ends: dict[str, list[float]]) -> int:
    return (2 * max(map(len, ends.values()), default=0) + 1).bit_length()


def _bounded(side: DataFrame, ends: dict[str, list[float]]) -> DataFrame:
    """A side with a few rows for each end: few ends are sent around, so that the other side stays where it is."""
    return F.broadcast(side) if sum(map(len, ends.values())) <= SENT_ENDS else side


def with_cells(df: DataFrame, ends: dict[str, list[float]]) -> DataFrame:
    """A row of ``df`` for each metric, with the cell its value lies in; a null value lies in none."""
    places = [F.struct(F.lit("none").alias("metric"), F.lit(0).alias("cell"))]
    for metric, column in METRIC_COLUMNS.items():
        if column in df.columns:
            cell = F.when(F.col(column).isNotNull(), cell_of(F.col(column), ends.get(metric, [])))
            places.append(F.struct(F.lit(metric).alias("metric"), cell.alias("cell")))
    return df.select("*", F.inline(F.array(*places))).where("cell is not null")


def band_table_membership(df: DataFrame, bands: DataFrame) -> DataFrame:
    """``df`` once for each band of ``bands`` (``metric, low, high, name``; null ends are open) that holds it, with
    ``band``. Only cells that a value of ``df`` lies in are paired with their bands, so no pair is made that ``df`` does not have.

    The result has a row per pair; for their number and first and last names see ``band_table_counts``."""
    bands = checked_bands(bands)
    ends = _ends(bands)
    placed = with_cells(df, ends)
    held = with_nodes(placed.select("metric", "cell").distinct(), ends).join(band_nodes(bands, ends), ["metric", "level", "node"])
    return placed.join(held.drop("level", "node"), ["metric", "cell"]).drop("metric", "cell")


def band_table_counts(df: DataFrame, bands: DataFrame, key: str) -> DataFrame:
    """``key, bands, first, last``: how many bands of ``bands`` hold each row of ``df`` that any holds, and the first and last by name.

    Bands are counted by aligned runs of cells, the runs by cell, and a value meets the one row of its
    cell, so the work follows the bands and the rows and not their pairs."""
    bands = checked_bands(bands)
    ends = _ends(bands)
    figures = lambda n: (F.sum(n).alias("_n"), F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    runs = band_nodes(bands, ends).groupBy("metric", "level", "node").agg(
        F.count("*").alias("_n"), F.min("band").alias("_low"), F.max("band").alias("_high")
    )
    sizes = {m: 2 * len(ends.get(m, [])) for m in ("none", *METRIC_COLUMNS)}
    axes = df.sparkSession.createDataFrame(list(sizes.items()), "metric string, most int")
    cells = axes.select("metric", F.explode(F.sequence(F.lit(0), "most")).alias("cell"))
    held = with_nodes(cells, ends).join(_bounded(runs, ends), ["metric", "level", "node"]).groupBy("metric", "cell").agg(*figures("_n"))
    found = with_cells(df, ends).join(_bounded(held, ends), ["metric", "cell"]).groupBy(key).agg(*figures("_n"))
    return found.select(key, F.col("_n").alias("bands"), F.col("_low").alias("first"), F.col("_high").alias("last"))


def band_table_summary(df: DataFrame, bands: DataFrame, tokens: Column) -> DataFrame:
    """``band, documents, tokens, share``: cells are counted first and added up by aligned runs, so what meets
    the bands is a row per run and a band meets a few runs, however many cells it covers."""
    bands = checked_bands(bands)
    ends = _ends(bands)
    counts = with_cells(df.withColumn("_tokens", tokens), ends).groupBy("metric", "cell").agg(
        F.count("*").alias("n"), F.sum("_tokens").cast("long").alias("t")
    )
    # A row per cell; the corpus is read once.
    counts = durable(counts)
    runs = with_nodes(counts, ends).groupBy("metric", "level", "node").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    found = band_nodes(bands, ends).join(_bounded(runs, ends), ["metric", "level", "node"])
    held = bands.select("band").join(found.groupBy("band").agg(F.sum("n").alias("documents"), F.sum("t").alias("tokens")), "band", "left")
    # The whole corpus is the one cell of no metric: a scalar, not a join.
    total = counts.where("metric = 'none'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    documents = F.coalesce("documents", F.lit(0))
    return held.select(
        "band", documents.alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.round(F.try_divide(documents, F.lit(total)), 6).alias("share"),
    )
