"""Small helpers shared by the operators: stored tables, Arrow slices and words."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import new_path

# Text that is held as words at a time inside a task, whatever the size of an Arrow batch.
SLICE_BYTES = 4 << 20
# The words of the contracts: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the folder that all executors share and read it back: it cuts the
    lineage, and a lost executor costs a read instead of a recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which its owner sizes by the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def crc_share(key: str | Column, by: int) -> Column:
    """crc32 of a key as text, modulo ``by``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string")) % by


def slices(batch: pa.RecordBatch, column: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``budget`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // budget
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)


class Words(NamedTuple):
    """The words of several texts: ``distinct[codes]``, text i has codes ``ends[i]:ends[i + 1]``."""

    distinct: pa.Array
    codes: np.ndarray
    ends: np.ndarray


def split_words(texts: pa.Array) -> Words:
    """Words between ASCII white space, each distinct word once; null has none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    ends = parts.offsets.to_numpy()
    ends = ends - ends[0]
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:
        real = codes != blank
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        codes = codes[real]
    return Words(coded.dictionary, codes, ends.astype(np.int64))


def owners(ends: np.ndarray) -> np.ndarray:
    """For flat items of several rows: the row of each."""
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_of(ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of ``width`` consecutive items inside one row, and the runs per row."""
    counts = np.maximum(np.diff(ends) - width + 1, 0)
    first = np.repeat(ends[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return first + np.arange(counts.sum()), counts
