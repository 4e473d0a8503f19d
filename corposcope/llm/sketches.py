"""Fingerprints of documents: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range. So it grows with its
document, the union of two sketches is the sketch of both documents, and the share of one
sketch that another has estimates containment however unequal the documents are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Words, mix64, partitions, runs_of, slices, split_words

SHINGLE = 5
FRACTION = 1 / 4
# A text with fewer hashes below the fraction keeps its smallest ones up to this number.
LEAST = 32
# Hexadecimal digits of a hash in a fingerprint's text: the leading 48 bits.
DIGITS = 12


def _scaled(hashes: np.ndarray, fraction: float) -> np.ndarray:
    """Of sorted distinct hashes those below the fraction, and the smallest ``LEAST`` in any case."""
    return hashes[: max(int(np.searchsorted(hashes, np.uint64(int(fraction * 2**48)))), LEAST)]


def sketches(texts: pa.Array, *, width: int = SHINGLE, fraction: float = FRACTION) -> list[np.ndarray]:
    """The sorted hashes of each text that its sketch keeps. Fewer words than a shingle are one
    shingle; without words there are none."""
    words: Words = split_words(texts)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words.distinct.to_pylist()], np.uint64)[words.codes]
    first, counts = runs_of(words.ends, width)
    run = np.zeros(len(first), np.uint64)
    for k in range(width):
        run = run * np.uint64(0x9E3779B97F4A7C15) + hashes[first + k]
    run = mix64(run) >> np.uint64(16)
    ends = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for i, n in enumerate(np.diff(words.ends)):
        own = run[ends[i] : ends[i + 1]]
        if n and not counts[i]:
            own = np.zeros(1, np.uint64)
            for h in hashes[words.ends[i] : words.ends[i + 1]]:
                own = own * np.uint64(0x9E3779B97F4A7C15) + h
            own = mix64(own) >> np.uint64(16)
        out.append(_scaled(np.unique(own), fraction))
    return out


def threshold(sketch: np.ndarray, fraction: float = FRACTION) -> int:
    """All hashes of the text below this number are in its sketch, as the sketch itself tells."""
    limit = int(fraction * 2**48)
    if len(sketch) < LEAST:
        return 1 << 48
    return max(limit, int(sketch[-1]) + 1)


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of two documents together."""
    both = np.union1d(a, b)
    return _scaled(both[both < np.uint64(min(threshold(a, fraction), threshold(b, fraction)))], fraction)


def likeness(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float:
    """Estimated containment of the smaller document's shingles in the larger's, from the hashes below the
    lower of both thresholds. Equal sketches give 1, a document without words and one with words 0."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = np.uint64(min(threshold(a, fraction), threshold(b, fraction)))
    a, b = a[a < common], b[b < common]
    return len(np.intersect1d(a, b, assume_unique=True)) / max(min(len(a), len(b)), 1)


def spelled(sketch: np.ndarray) -> str:
    """The hashes as hexadecimal digits of fixed width, in order and without separators."""
    return b"".join(int(h).to_bytes(DIGITS // 2, "big") for h in sketch).hex()


def with_fingerprint(docs: DataFrame, *, text: str = "text", width: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """``docs`` with ``fingerprint``, the sketch of the whole text as digits; null counts as empty and is ``''``."""

    @F.arrow_udf("string")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [p.column(0) for p in slices(pa.record_batch([texts], ["t"]), "t")]
            yield pa.array([spelled(s) for p in parts for s in sketches(p, width=width, fraction=fraction)], pa.string())

    return docs.withColumn("fingerprint", sketch(F.col(text).cast("string")))


# --- each document next to its neighbour -----------------------------------------


def _dealer(cuts: np.ndarray, ahead: dict[int | None, int]):
    """Rows to their bucket by falling id; the first rows of a bucket also to the end of the one before."""
    schema = pa.schema([("bucket", pa.int64()), ("ahead", pa.bool_()), ("doc_id", pa.int64()), ("text", pa.string())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            bucket = bucket_of(ids, cuts)
            extra = [i for i, key in enumerate(ids.to_pylist()) if key in ahead]
            for at, number, flag in (
                (np.arange(len(ids)), bucket, False),
                (np.array(extra, np.int64), np.array([ahead[ids[i].as_py()] for i in extra], np.int64), True),
            ):
                rows = batch.take(pa.array(at))
                columns = [pa.array(number), pa.array([flag] * len(at), pa.bool_()), rows.column("doc_id"), rows.column("text")]
                yield pa.record_batch(columns, schema=schema)

    return deal


def bucket_of(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """0 for the ids above all cuts, one more for each cut that is not below the id; null ids come last."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    bucket = len(cuts) - np.searchsorted(cuts, values, side="left")
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(cuts) + 1, bucket)


def by_falling_id(docs: DataFrame) -> DataFrame:
    """``(bucket, ahead, doc_id, text)``, sorted by falling ``doc_id`` inside a bucket; after its own rows a
    bucket has the first row of the next one (the last bucket that of the first), marked ``ahead``.

    The ends of the buckets come from the ids alone, of which the driver sees a quantile per bucket;
    the texts move once. Null ids come last, rows of one id in the order of a hash of their text.
    """
    spark = docs.sparkSession
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = 4 * partitions(spark)
    cuts = light.agg(F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)], 20 * wanted)).first()[0]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.arrow_udf("long")
    def bucket(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            yield pa.array(bucket_of(ids, cuts))

    firsts = light.select("doc_id", bucket("doc_id").alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("first"))
    order = sorted((r["bucket"], r["first"]) for r in firsts.collect()) if len(cuts) or not light.isEmpty() else []
    ahead = {first: order[i - 1][0] for i, (_, first) in enumerate(order)}
    dealt = light.mapInArrow(_dealer(cuts, ahead), "bucket long, ahead boolean, doc_id long, text string")
    turn = ["bucket", "ahead", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"]
    return dealt.repartition("bucket").sortWithinPartitions(*turn)


_EDITS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _editor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple[int, int | None, str, np.ndarray] | None = None  # a row that waits for its next one

    def pairs(part: pa.RecordBatch):
        nonlocal last
        columns = [part.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "text")]
        for bucket, ahead, key, text, sketch in zip(*columns, sketches(part.column("text"))):
            if last is not None and last[0] == bucket:
                yield last[1:], (text or "", sketch)
                last = None
            if not ahead:
                last = (bucket, key, text or "", sketch)

    for batch in batches:
        for part in slices(batch, "text"):
            found = list(pairs(part))
            edited = []
            for (_, text, _), (after, _) in found:
                n = len(text) // 3
                edited.append(text[: len(text) - n] + after[:n])
            rows = [
                (key, len(text), hashlib.sha256(new.encode()).hexdigest(), spelled(own), spelled(changed), likeness(own, changed), likeness(own, other))
                for ((key, text, own), (_, other)), new, changed in zip(found, edited, sketches(pa.array(edited, pa.string())))
            ]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_EDITS), _EDITS)], schema=_EDITS)


def compare_edits(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its fingerprint, that of its edited text, and likenesses.

    The edited text has its last third, ``floor(n_chars / 3)`` code points, replaced by the first as
    many (or all) of the next row by falling ``doc_id``, after the last row the first. Null text is
    empty, repeated rows are rows of their own, a single row is its own next, an empty table gives none.
    """
    ddl = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return by_falling_id(docs).mapInArrow(_editor, ddl)
