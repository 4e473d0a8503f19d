"""Equi joins of rows with a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def lookup_join(
    df: DataFrame, side: DataFrame, on: str | list[str], how: str = "left", *, shuffled: bool = False
) -> DataFrame:
    """Join ``df`` with ``side``, whose keys are unique, keeping the rows of ``df``.

    Spark broadcasts a side that it knows to be small; otherwise both sides are shuffled, and
    adaptive execution splits the partition of a key that holds many rows. ``shuffled`` asks for that way.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(side.hint("merge") if shuffled else side, keys, how)


def slice_names(spark: SparkSession, parts: int) -> list[int]:
    """A number for each of ``parts`` partitions that falls there by its hash, so that partitions hold a slice each.

    Numbers up to 32 times as many leave next to no partition out; one left out stays empty.
    """
    numbers = spark.range(32 * parts, numPartitions=1).select(F.col("id").cast("int").alias("name"))
    return sorted(r["name"] for r in numbers.groupBy(F.pmod(F.hash("name"), F.lit(parts))).agg(F.min("name").alias("name")).collect())


def lookup_terms(df: DataFrame, key: str, terms: Column, side: DataFrame, on: str, value: str, *, how: str = "inner", **join) -> DataFrame:
    """``(key, values)``: what ``side`` has for each of a row's ``terms``, in order; terms it lacks are left out.

    Rows move once, into slices by ``key``. The distinct terms of a slice meet ``side`` and come back, and the places of
    all terms meet them where they lie, so no place moves and a frequent term is a row per slice. Rows without
    any value are left out, or have an empty array under ``how="left"``.
    """
    conf = df.sparkSession.conf
    # Both sides of the join on slice and term lie by slice; Spark would else move the places by both.
    conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    parts = int(conf.get("spark.sql.shuffle.partitions"))
    names = slice_names(df.sparkSession, parts)
    # Never null: a filter on it would come below the exchange, which would not serve both terms and places then.
    name = F.coalesce(F.get(F.array(*map(F.lit, names)), F.pmod(F.xxhash64(key), F.lit(len(names))).cast("int")), F.lit(names[0]))
    moved = df.repartition(parts, name).withColumn("slice", name)
    # The outer forms keep Spark from deriving a filter that splits the texts again.
    places = moved.select("slice", key, F.posexplode_outer(terms).alias("at", on))
    own = moved.select("slice", F.explode_outer(terms).alias(on)).distinct()
    found = lookup_join(own, side.select(on, F.col(value).alias("_value")), on, "inner", **join).repartition(parts, "slice")
    # The terms of a slice are held, its places pass by.
    met = places.join(found.hint("shuffle_hash"), ["slice", on], how)
    pairs = F.sort_array(F.collect_list(F.when(F.col("_value").isNotNull(), F.struct("at", "_value"))))
    return met.groupBy("slice", key).agg(pairs.getField("_value").alias("values")).drop("slice")
