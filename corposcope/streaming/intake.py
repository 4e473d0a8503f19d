"""Incremental intake: new article files are scored once each, across restarts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import with_defaults
from ..operators.figures import shard_figures, store_figures
from ..operators.scoring import score_articles
from ..session import durable, staged
from ..sources.articles import SCORED_SCHEMA, quarantine, shard_name, stream_articles


def score_scanned(scanned: DataFrame, profiles: DataFrame, **join) -> tuple[DataFrame, DataFrame]:
    """Scored articles with their ``shard``, and the broken files, of one scan.

    Parsing XML is the dear part, so the scan is written once as columns and
    both results read that.
    """
    good, broken = quarantine(staged(scanned, "scan"))
    articles = with_defaults(good).withColumn("shard", shard_name(F.col("file"))).drop("file")
    return score_articles(articles, profiles, **join), broken


def start_intake(
    spark: SparkSession, source: str, profiles: DataFrame, target: str, checkpoint: str, *, tokens: Column | None = None
) -> StreamingQuery:
    """Process every file not seen before and stop; the checkpoint remembers them.

    A file is always inside one micro-batch, so quarantine per batch is exact.
    A batch owns its folder under ``target`` and overwrites it when it is run
    again after a failure, so each article lands once. With ``tokens``, the number of tokens of an
    article, the figures of the new shards are stored under ``target/figures`` too.
    """
    dimension = durable(profiles)

    def write_batch(batch: DataFrame, number: int) -> None:
        scored, broken = score_scanned(batch, dimension)
        scored.write.mode("overwrite").partitionBy("shard").json(f"{target}/scored/batch={number}")
        broken.write.mode("overwrite").json(f"{target}/quarantine/batch={number}")
        if tokens is not None:
            landed = spark.read.schema(f"{SCORED_SCHEMA}, shard string").json(f"{target}/scored/batch={number}")
            store_figures(shard_figures(landed, tokens), f"{target}/figures")

    return (
        stream_articles(spark, source)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
