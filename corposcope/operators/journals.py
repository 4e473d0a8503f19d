"""The journal dimension: metric per ISSN and year, and one h-index per ISSN."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rank_rows(ranks: DataFrame) -> DataFrame:
    """One row per ISSN from the yearly rank lists ``(year, rank, issn, sjr, h_index)``.

    Unranked journals score 0, the placeholder ``-`` is dropped, and a cell
    with several ISSNs separated by ``", "`` becomes several rows.
    """
    return (
        ranks.where("issn <> '-'")
        .withColumn("sjr", F.coalesce("sjr", F.lit(0.0)))
        .withColumn("issn", F.explode(F.split("issn", ", ")))
    )


def first_per_year(rows: DataFrame) -> DataFrame:
    """Keep the best-ranked row per ISSN and year, the first one in file order."""
    best = F.min_by(F.struct("sjr", "h_index", "rank"), "rank").alias("best")
    return rows.groupBy("issn", "year").agg(best).select("issn", "year", "best.*")


def sjr_by_year(rows: DataFrame) -> DataFrame:
    return first_per_year(rows).select("issn", "year", "sjr")


def h_index_by_issn(rows: DataFrame) -> DataFrame:
    """The h-index of the earliest year in which the ISSN is listed."""
    first = first_per_year(rows).where("h_index is not null")
    return first.groupBy("issn").agg(F.min_by("h_index", "year").alias("h_index"))


def journal_profiles(rows: DataFrame) -> DataFrame:
    """One row per ISSN: its first h-index and ``metrics``, an array of (year, sjr).

    Two aggregates over the rank rows. An ISSN has one entry per year, so an
    array is as long as the number of calendar years on file.
    """
    listed = first_per_year(rows)
    ranked_year = F.when(F.col("h_index").isNotNull(), F.col("year"))
    return listed.groupBy("issn").agg(
        F.min_by("h_index", ranked_year).alias("h_index"),
        F.sort_array(F.collect_list(F.struct("year", "sjr"))).alias("metrics"),
    )


def stack_years(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Add a later rank list to the table; it replaces equal ``(issn, year)`` keys."""
    tagged = earlier.withColumn("_age", F.lit(0)).unionByName(later.withColumn("_age", F.lit(1)))
    rest = [c for c in earlier.columns if c not in ("issn", "year")]
    newest = F.max_by(F.struct(*rest), "_age").alias("_newest")
    return tagged.groupBy("issn", "year").agg(newest).select("issn", "year", "_newest.*")


def as_maps(sjr: DataFrame, h_index: DataFrame) -> DataFrame:
    """The map view of both tables: ``issn, h_index, sjr_by_year`` (year to metric)."""
    maps = sjr.groupBy("issn").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("year"), F.col("sjr"))))).alias(
            "sjr_by_year"
        )
    )
    return maps.join(h_index, "issn", "left")


def from_maps(maps: DataFrame) -> DataFrame:
    """Back from the map view to one row per ISSN and year."""
    return maps.select("issn", "h_index", F.explode("sjr_by_year").alias("year", "sjr"))
