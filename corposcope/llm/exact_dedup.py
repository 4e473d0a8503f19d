"""Exact duplicates by deterministic block naming.

A text is cut into blocks of fixed size. Equal blocks get the same integer name: the blocks of
a bucket are sorted, and the name is the rank among the distinct ones. Adjacent names are then
paired and the pairs named in the same way, until a text has one name. Two texts of one length
are cut and paired alike, so they are equal exactly when their last names are: no hash decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import LOWER, UPPER, partitions, slices, stored

BLOCK_BYTES = 2048
_PLACE = pa.struct([("row", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string())])
_CUT = pa.schema([("block", pa.binary()), ("piece", pa.int64()), ("places", pa.list_(_PLACE))])


def _cutter(block_bytes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = piece = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                places: dict[bytes, list] = {}
                texts = pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist()
                for key, text in zip(part.column("doc_id").to_pylist(), texts):
                    text = text.lower()  # of bytes: A-Z only
                    head = {"doc_id": key, "n_bytes": len(text), "sha": hashlib.sha256(text).hexdigest()}
                    for pos, at in enumerate(range(0, max(len(text), 1), block_bytes)):
                        place = {"row": row, "pos": pos} | ({} if pos else head)
                        places.setdefault(text[at : at + block_bytes], []).append(place)
                    row += 1
                pieces = pa.array(range(piece, piece + len(places)), pa.int64())
                yield pa.record_batch([pa.array(places, pa.binary()), pieces, pa.array(places.values(), _CUT.field(2).type)], schema=_CUT)
                piece += len(places)

    return cut


def _name(bucket_count: int, *by: str) -> Column:
    """An integer that distinct values of ``by`` do not share: the rank in a sorted bucket, and the bucket."""
    bucket = F.pmod(F.xxhash64(*by), F.lit(bucket_count))
    rank = F.dense_rank().over(Window.partitionBy(bucket).orderBy(*by))
    return (rank.cast("long") - 1) * bucket_count + bucket


def block_identities(docs: DataFrame, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(row, doc_id, n_bytes, sha, name)``, one per row of ``docs``: texts (``doc_id``, ``text``) are
    equal after lower-casing A-Z exactly when ``n_bytes`` and ``name`` are. Null counts as empty.

    A slice of a map task has each distinct block once, as a numbered piece with all its places. The pieces are stored; their
    contents move once to be named, without the places, so a block that many copies share is a row for each
    slice. The places meet the names by the numbers of the pieces, and later rounds move integers.
    """
    buckets = 8 * partitions(docs.sparkSession)
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = cut.mapInArrow(_cutter(block_bytes), "block binary, piece long, places array<struct<row: bigint, pos: int, doc_id: bigint, n_bytes: bigint, sha: string>>")
    blocks = stored(blocks, "pieces")
    names = blocks.select("piece", _name(buckets, "block").alias("name"))
    named = stored(blocks.select("piece", "places").join(names, "piece").select("name", F.inline("places")), "blocks")
    heads = named.where("pos = 0").select("row", "doc_id", "n_bytes", "sha")
    longest = heads.agg(F.max("n_bytes")).first()[0] or 0
    rounds = max(-(-longest // block_bytes) - 1, 0).bit_length()

    done = named.where(F.col("n_bytes") <= block_bytes).select("row", "name")
    # Blocks of the longer texts; the first of each tells that there are more.
    level = named.where((F.col("pos") > 0) | (F.col("n_bytes") > block_bytes)).select("row", "pos", "name")
    for k in range(rounds):
        halves = level.groupBy("row", F.expr("pos div 2").alias("pos")).agg(
            F.min_by("name", "pos").alias("a"), F.max_by("name", "pos").alias("b"), F.count("*").alias("n"), F.max("pos").alias("last")
        )
        halves = stored(halves, f"pairs{k}")
        pairs = halves.where("n = 2").select("a", "b").distinct()
        pairs = pairs.select("a", "b", _name(buckets, "a", "b").alias("name"))
        # An odd last name is carried: texts of one length carry it at the same place.
        paired = halves.where("n = 2").join(pairs, ["a", "b"]).select("row", "pos", "name")
        level = paired.unionByName(halves.where("n = 1").select("row", "pos", F.col("a").alias("name")))
        level = stored(level, f"names{k}")
        width = block_bytes << (k + 1)
        ready = heads.where((F.col("n_bytes") <= width) & (F.col("n_bytes") > width // 2)).select("row")
        done = done.unionByName(level.join(ready, "row", "left_semi").select("row", "name"))
        if k < rounds - 1:
            level = level.join(heads.where(F.col("n_bytes") > width).select("row"), "row", "left_semi")
    return heads.join(done, "row")


def exact_duplicates(docs: DataFrame, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one per row of ``docs``.

    Of equal texts the largest ``doc_id`` stays (any value before null). Rows that repeat both text
    and ``doc_id`` count each; one of them stays. An empty table gives no rows; other columns
    are not read.
    """
    named = stored(block_identities(docs, block_bytes=block_bytes), "identities")
    groups = named.groupBy("n_bytes", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("_keep")
    )
    # Stored, so that the join can split the rows of a large group over tasks.
    return named.join(stored(groups, "groups"), ["n_bytes", "name"]).select(
        "doc_id",
        F.col("_keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("_keep.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, one for each distinct text, with all their columns, whatever their names.

    Null counts as the empty text. Of equal texts the largest ``doc_id`` stays, a null id only if all are null; of rows that
    repeat text and ``doc_id`` any one. An empty table stays empty.
    """
    kept = exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_kept"))
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col("doc_id").cast("long").alias("_own"), F.sha2(text, 256).alias("_sha"), F.struct("*").alias("_row"))
    chosen = rows.join(kept, F.col("_id").eqNullSafe(F.col("_own")) & (F.col("_kept") == F.col("_sha")), "left_semi")
    return chosen.dropDuplicates(["_own", "_sha"]).select("_row.*")
