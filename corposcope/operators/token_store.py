"""Token arrays kept in their seeded order, so that packing and splitting them again moves nothing.

The positions are found once. Rows are stored by slab, a run of consecutive positions, in a bucketed table: whatever
is grouped by slab reads it in place. A slab is a whole number of batches, so every batch lies in one.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.arrays import whole_of_slimmed
from ..session import new_path
from .ordering import SLAB_ROWS, check_fraction, with_slab
from .tokens import PACK_FILLS, pack, slim_rows


@dataclass(frozen=True)
class TokenStore:
    """A stored table of ``rows`` rows; ``slab_rows`` positions lie together."""

    table: str
    rows: int
    slab_rows: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


def store_tokens(
    tokens: DataFrame, key: str, *, slab_rows: int = SLAB_ROWS, buckets: int | None = None, seed: int = 42, digits: int | None = None
) -> TokenStore:
    """Store ``tokens`` with their positions after a seeded shuffle. The arrays move once now, to their slab, and never again.

    The table belongs to the session's catalog, its files lie in the shared folder; as many buckets as
    there are shuffle partitions, so that the joins and groups of later jobs line up with them.
    """
    spark = tokens.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tokens_{uuid.uuid4().hex}"
    names = [c for c in PACK_FILLS if c in tokens.columns]
    slim = slim_rows(tokens, names) if names else tokens
    moved = with_slab(slim, key, slab_rows, seed=seed, digits=digits).repartition(buckets, "slab")
    place = F.row_number().over(Window.partitionBy("slab").orderBy("_key", key))
    placed = moved.withColumn("ordinal", F.col("slab") * slab_rows + place - 1)
    arrays = {n: whole_of_slimmed(F.col(n), F.size(names[0])) for n in names[1:]}
    placed = placed.withColumns(arrays).select(*tokens.columns, "ordinal", "slab")
    writer = placed.write.format("parquet").bucketBy(buckets, "slab").sortBy("slab", "ordinal")
    writer.option("path", new_path(spark, "token_store")).saveAsTable(name)
    return TokenStore(name, spark.table(name).count(), slab_rows)


def pack_stored(
    spark: SparkSession, store: TokenStore, length: int, *, batch_size: int = 1024, fills: dict[str, int] = PACK_FILLS
) -> DataFrame:
    """``batch, chunk`` and token arrays of fixed length, as ``pack_shuffled`` makes them, without an exchange."""
    if store.slab_rows % batch_size:
        raise ValueError(f"a slab of {store.slab_rows} rows is not a whole number of batches of {batch_size}")
    return pack(store.read(spark), length, batch_size=batch_size, fills=fills, within=("slab",))


def split_stored(spark: SparkSession, store: TokenStore, fraction: float = 0.01) -> DataFrame:
    """The stored rows with ``split``: the last ``ceil(rows * fraction)`` positions are for validation, a comparison in the scan."""
    check_fraction(fraction)
    return store.read(spark).withColumn("split", F.when(F.col("ordinal") >= store.rows - tail_rows(store.rows, fraction), "validation").otherwise("train"))


def tail_rows(rows: int, fraction: float) -> int:
    """``ceil(rows * fraction)`` of the decimal fraction that was written, free of binary rounding."""
    return math.ceil(rows * Fraction(str(fraction)))


def drop_store(spark: SparkSession, store: TokenStore) -> None:
    """Forget the table; its files stay in the shared folder."""
    spark.sql(f"DROP TABLE IF EXISTS {store.table}")
