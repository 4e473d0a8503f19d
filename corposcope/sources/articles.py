"""Article files in, scored articles and split tables in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.lookup import lookup_join

# Ints are read as text so that a bad number costs one field, not the row;
# arrays where an element may repeat. Inline markup stays in the text leaves.
ARTICLE_SCHEMA = """
MedlineCitation struct<
  PMID: string,
  DateCompleted: struct<Year: string, Month: string, Day: string>,
  Article: struct<
    Journal: struct<ISSN: string>,
    Abstract: struct<AbstractText: array<string>>,
    ArticleTitle: string,
    Language: array<string>>>
"""
CORRUPT = "_corrupt_record"

SCORED_SCHEMA = "id long, text string, h_index int, sjr double, random double"


def _reader(spark_read):
    return (
        spark_read.format("xml")
        .option("rowTag", "PubmedArticle")
        .option("mode", "PERMISSIVE")
        .option("ignoreSurroundingSpaces", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(f"{ARTICLE_SCHEMA}, {CORRUPT} string")
    )


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("file"))


def scan_articles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per article element, undeclared fields ignored, plus the file it came from.

    Compressed files do not split, so a file is the unit of work. Broken
    records come back in the ``_corrupt_record`` column.
    """
    return _with_file(_reader(spark.read).load(path))


def stream_articles(spark: SparkSession, path: str) -> DataFrame:
    """The same as a streaming source over new files of a folder."""
    return _with_file(_reader(spark.readStream).load(path))


def quarantine(scanned: DataFrame, **join) -> tuple[DataFrame, DataFrame]:
    """Split a scan into good rows and broken files.

    A syntax error ends its file, so every row of such a file is set aside and
    only the file name is reported. ``scanned`` is read twice; pass a staged
    table unless parsing is cheap.
    """
    broken = scanned.where(F.col(CORRUPT).isNotNull()).groupBy("file").agg(
        F.count("*").alias("broken_records")
    )
    good = lookup_join(scanned.drop(CORRUPT), broken.select("file"), "file", "left_anti", **join)
    return good, broken


def shard_name(file: Column) -> Column:
    """File name without folders and extensions."""
    return F.regexp_extract(file, r"([^/]+?)(?:\.xml)?(?:\.gz)?$", 1)


def write_scored(df: DataFrame, path: str, *, shard: str = "shard", mode: str = "errorifexists") -> None:
    """Scored articles as JSON lines, one folder per shard."""
    df.write.mode(mode).partitionBy(shard).json(path)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Scored articles of all shards with the declared types."""
    return spark.read.schema(f"{SCORED_SCHEMA}, shard string").json(path)


def write_splits(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """A table with a ``split`` column as columnar files, one folder per split."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """All splits, or one of them, in which case only its folder is read."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def write_reader_shards(df: DataFrame, path: str, shards: int = 64, *, key: str) -> None:
    """Rewrite a table as ``shards`` files of about equal size for parallel readers."""
    reader_shards(df, shards, key=key).write.parquet(path)


def reader_shards(df: DataFrame, shards: int = 64, *, key: str) -> DataFrame:
    return df.repartition(shards, F.xxhash64(key))


def new_files(files: DataFrame, done: DataFrame, **join) -> DataFrame:
    """Input files that no finished output names."""
    return lookup_join(files, done.select("file").distinct(), "file", "left_anti", **join)
