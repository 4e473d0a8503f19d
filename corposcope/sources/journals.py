"""Yearly journal rank lists and the journal tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.journals import as_maps, from_maps

# Years of the rank lists, both included.
FIRST_YEAR, LAST_YEAR = 1999, 2022

RANK_COLUMNS = "Rank string, Title string, Issn string, SJR string, `H index` string"


def scan_journal_ranks(spark: SparkSession, path: str | list[str], columns: str = RANK_COLUMNS) -> DataFrame:
    """``year, rank, issn, sjr, h_index`` from semicolon-separated files, one per year.

    Numbers use a decimal comma. The year comes from the file or folder name.
    """
    raw = (
        spark.read.option("sep", ";").option("header", True).option("recursiveFileLookup", True)
        .schema(columns).csv(path)
    )
    file = F.col("_metadata.file_path")
    year = F.coalesce(
        F.regexp_extract(file, r"year=(\d{4})/", 1).try_cast("int"),
        F.regexp_extract(file, r"(\d{4})[^/\d]*\.csv", 1).try_cast("int"),
    )
    return raw.select(
        year.alias("year"),
        F.col("Rank").try_cast("int").alias("rank"),
        F.col("Issn").alias("issn"),
        F.replace("SJR", F.lit(","), F.lit(".")).try_cast("double").alias("sjr"),
        F.col("`H index`").try_cast("int").alias("h_index"),
    )


def missing_years(ranks: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Years of the range that no rank list covers."""
    present = ranks.select("year").distinct()
    years = ranks.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return years.join(present, "year", "left_anti")


def write_journal_maps(sjr: DataFrame, h_index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Both journal tables as JSON, one object per ISSN with a map from year to metric."""
    as_maps(sjr, h_index).write.mode(mode).json(path)


def read_journal_maps(spark: SparkSession, path: str) -> DataFrame:
    """``issn, h_index, year, sjr`` back from the map form."""
    schema = "issn string, h_index int, sjr_by_year map<string,double>"
    return from_maps(spark.read.schema(schema).json(path)).withColumn("year", F.col("year").cast("int"))
