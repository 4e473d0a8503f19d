"""Metric records, training logs, configuration files, prediction files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def parent_folder(path: Column) -> Column:
    """Name of the folder a file lies in, percent-decoded; a ``key=value`` folder gives its value."""
    folder = F.url_decode(F.replace(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1), F.lit("+"), F.lit("%2B")))
    value = F.regexp_extract(folder, r"^[A-Za-z_]+=(.*)$", 1)
    return F.when(value != "", F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))).otherwise(folder)


def scan_results(spark: SparkSession, path: str | list[str], *, pattern: str = "*.json") -> DataFrame:
    """Metric records of many runs as ``run, metric, value``; the run is the folder name.

    Records differ in their keys, so each file is read as a map.
    """
    raw = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
    )
    record = F.from_json("value", "map<string,double>")
    return raw.select(
        parent_folder(F.col("_metadata.file_path")).alias("run"), F.explode(record).alias("metric", "value")
    )


# A file costs about as much to open as so many bytes to read.
OPEN_BYTES = 64 << 10


def compact_results(spark: SparkSession, path: str | list[str], target: str, *, task_bytes: int = 128 << 20, pattern: str = "*.json") -> int:
    """Metric records of many small files as one parquet table ``run, metric, value`` under ``target``; the number of its tasks.

    The files are listed with their sizes first, not read; as many tasks as their bytes and openings ask for then read
    all of them, neighbours together, so a hundred thousand files are a few dozen tasks and as many files.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    sizes = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    tasks = max(-(-(sizes["bytes"] + sizes["n"] * OPEN_BYTES) // task_bytes), 1)
    # Merging the read tasks needs no exchange.
    scan_results(spark, path, pattern=pattern).coalesce(tasks).write.parquet(target)
    return tasks


def scan_result_columns(spark: SparkSession, path: str | list[str], metrics: list[str], **options) -> DataFrame:
    """The same with one column per metric; a metric a run lacks is null."""
    from ..functions.text import metric_name

    long = scan_results(spark, path, **options).withColumn("metric", metric_name(F.col("metric")))
    return long.groupBy("run").pivot("metric", metrics).agg(F.first("value"))


def scan_training_logs(spark: SparkSession, path: str | list[str], *, pattern: str = "*.json") -> DataFrame:
    """``run, step, loss, train_loss`` from files with a ``log_history`` array."""
    schema = "log_history array<struct<step: int, epoch: double, loss: double, train_loss: double>>"
    raw = (
        spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).json(path)
    )
    run = parent_folder(F.col("_metadata.file_path"))
    return raw.select(run.alias("run"), F.inline("log_history")).select("run", "step", "loss", "train_loss")


def parse_bands(text: Column) -> Column:
    """A band file (metric to list of ``[low, high, name]``) as an array of structs; ``null`` bounds are open."""
    table = F.from_json(text, "map<string,array<array<string>>>")
    return F.flatten(
        F.transform(
            F.map_entries(table),
            lambda e: F.transform(
                e["value"],
                lambda b: F.struct(
                    e["key"].alias("metric"),
                    b[0].try_cast("double").alias("low"),
                    b[1].try_cast("double").alias("high"),
                    b[2].alias("name"),
                ),
            ),
        )
    )


def scan_bands(spark: SparkSession, path: str) -> DataFrame:
    """``metric, low, high, name`` from a band configuration file."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.inline(parse_bands(F.col("value"))))


def parse_percentiles(text: Column) -> Column:
    """A statistics file (``<metric>_percentiles`` to a map of ``"12.5%"`` to value) as an array of structs."""
    table = F.from_json(text, "map<string,string>")
    entries = F.filter(F.map_entries(table), lambda e: F.endswith(e["key"], F.lit("_percentiles")))
    return F.flatten(
        F.transform(
            entries,
            lambda e: F.transform(
                F.map_entries(F.from_json(e["value"], "map<string,double>")),
                lambda p: F.struct(
                    F.replace(e["key"], F.lit("_percentiles"), F.lit("")).alias("metric"),
                    F.replace(p["key"], F.lit("%"), F.lit("")).try_cast("double").alias("pct"),
                    p["value"].alias("value"),
                ),
            ),
        )
    )


def scan_percentiles(spark: SparkSession, path: str) -> DataFrame:
    """``metric, pct, value`` from a corpus statistics file."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.inline(parse_percentiles(F.col("value"))))


def scan_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``piece, id`` from a file with one word piece per line; the id is the line number."""
    raw = spark.read.text(path, wholetext=True)
    lines = F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")
    return raw.select(F.posexplode(lines).alias("id", "piece")).select("piece", "id")


def write_predictions(df: DataFrame, path: str, *, index: str = "index", prediction: str = "prediction") -> None:
    """``index<TAB>prediction`` lines in index order; label lists are written as ``['a', 'b']``."""
    field = df.schema[prediction].dataType.typeName()
    text = F.col(prediction).cast("string")
    if field == "array":
        quoted = F.transform(prediction, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
        text = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    rows = df.select(F.col(index), text.alias(prediction)).orderBy(index)
    rows.write.option("sep", "\t").option("header", True).option("quote", "").csv(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("sep", "\t").option("header", True).option("quote", "")
        .schema("index long, prediction string").csv(path)
    )


def write_tag_lines(df: DataFrame, path: str, *, index: str = "index", tags: str = "pred_tags") -> None:
    """One line of space-separated tags per sequence, in index order."""
    df.orderBy(index).select(F.array_join(tags, " ").alias("value")).write.text(path)


def write_metrics(records: DataFrame, path: str) -> None:
    """One JSON object per run: ``run=<name>/part-*.json`` holding its metrics.

    ``records`` has ``run`` and one column per metric; missing ones are left out.
    """
    records.write.partitionBy("run").json(path)
