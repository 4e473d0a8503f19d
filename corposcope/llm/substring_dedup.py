"""Repeated passages: a count-min prefilter, then an exact grouping of what may be repeated.

A passage is a window of consecutive words. Every task sketches its windows; the sketches are merged
by ranges of cells, and a merged cell never counts less than a window occurs. A second pass sends on only
windows all of whose cells say twice or more, so none that is repeated is lost. Those are
grouped exactly, and the documents learn which of their windows a smaller document has too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, Words, mix64, partitions, runs_of, slices, split_words

WINDOW = 13
# Rows of the sketch, and the largest number of its cells: the merged sketch is one bit a cell,
# so what is broadcast has at most 256 MB, and half a bit for each byte of text below that.
DEPTH = 2
MOST_CELLS = 1 << 31
# Cells whose counts are merged in one group, at most.
RANGE = 1 << 20
# Text whose windows are one shard, which is held while it is grouped, even if all of them pass the sketch.
SHARD_BYTES = 32 << 20
# Windows that a task sketches or sends on at a time.
HELD = 2_000_000


def window_keys(words: Words, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit keys of each run of ``width`` words inside a text, and the runs per text.

    A key is a polynomial in the hashes of the words, built from runs of doubled length.
    """
    first, counts = runs_of(words.ends, width)
    digests = b"".join(map(xxhash.xxh3_128_digest, words.distinct.to_pylist()))
    lanes = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    out = []
    for lane, base in ((0, 0x9E3779B97F4A7C15), (1, 0xC2B2AE3D27D4EB4F)):
        run, size = lanes[:, lane][words.codes], 1
        whole, covered = None, 0
        while size <= width:
            if width & size:  # the runs already joined stand before this one
                if whole is None:
                    whole, covered = run, size
                else:
                    whole = _joined(whole, covered, run, size, base)
                    covered += size
            run = _joined(run, size, run, size, base)
            size *= 2
        out.append(mix64(whole[first]) if len(first) else np.zeros(0, np.uint64))
    return out[0], out[1], counts


def _joined(a: np.ndarray, a_size: int, b: np.ndarray, b_size: int, base: int) -> np.ndarray:
    """Keys of runs of ``a`` followed by runs of ``b``, wherever both lie inside the array."""
    n = max(min(len(a), len(b) - a_size), 0)
    return a[:n] * np.uint64(pow(base, b_size, 1 << 64)) + b[a_size : a_size + n]


def _cells(k1: np.ndarray, k2: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cell of each window in every row of the sketch; ``cells`` is a power of two."""
    for row in range(DEPTH):
        yield mix64(k1 + np.uint64(row + 1) * k2) & np.uint64(cells // DEPTH - 1)


def pack_gaps(ordered: np.ndarray) -> bytes:
    """Ordered numbers as bytes: the gaps, 255 standing for 255 more to come."""
    gaps = np.diff(ordered, prepend=ordered[:1] * 0).astype(np.int64)
    more = gaps // 255
    out = np.full(len(gaps) + int(more.sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack_gaps(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def _once_a_text(k1: np.ndarray, k2: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of windows without those that repeat one of their own text."""
    order = np.lexsort((k2, k1, text))
    same = (k1[order][1:] == k1[order][:-1]) & (k2[order][1:] == k2[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.sort(order[np.concatenate([[True], ~same])]) if len(order) else order


def _texts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(k1, k2, doc_id)`` of the windows of slices of texts with an id."""
    for batch in batches:
        for part in slices(batch, "text"):
            k1, k2, counts = window_keys(split_words(part.column("text")), width)
            keys = part.column("doc_id").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(counts)), counts)
            keep = _once_a_text(k1, k2, row)
            yield k1[keep], k2[keep], keys[row[keep]].astype(np.int64)


def _span(cells: int) -> int:
    return min(RANGE, cells // DEPTH)


def _sketcher(cells: int, width: int, most: int):
    span = _span(cells)
    ranges = cells // DEPTH // span
    schema = pa.schema([("line", pa.int32()), ("range", pa.int32()), ("gaps", pa.binary())])

    def flush(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        lines, at, gaps = [], [], []
        for line, parts in enumerate(held):
            found = np.sort(np.concatenate(parts))
            cuts = np.searchsorted(found, np.arange(ranges + 1) * span)
            for r in np.flatnonzero(np.diff(cuts)):
                lines.append(line)
                at.append(r)
                gaps.append(pack_gaps(found[cuts[r] : cuts[r + 1]] - r * span))
        return pa.record_batch([pa.array(lines, pa.int32()), pa.array(at, pa.int32()), pa.array(gaps, pa.binary())], schema=schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [[] for _ in range(DEPTH)], 0
        for k1, k2, _ in _texts(batches, width):
            for parts, found in zip(held, _cells(k1, k2, cells)):
                parts.append(found.astype(np.uint32))
            n += len(k1)
            if n > most:
                yield flush(held)
                held, n = [[] for _ in range(DEPTH)], 0
        if n:
            yield flush(held)

    return sketch


def _merger(span: int):
    """For each range of cells one bit a cell: counted twice or more."""
    schema = pa.schema([("line", pa.int32()), ("range", pa.int32()), ("twice", pa.binary())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(0, np.uint8)

        def done() -> pa.RecordBatch:
            bits = np.packbits(counts > 1, bitorder="little").tobytes()
            return pa.record_batch([pa.array([x], f.type) for x, f in zip((*now, bits), schema)], schema=schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("line", "range", "gaps")]
            for line, at, gaps in zip(*columns):
                if (line, at) != now:
                    if now is not None:
                        yield done()
                    now, counts = (line, at), np.zeros(span, np.uint8)
                found, n = np.unique(unpack_gaps(gaps), return_counts=True)
                counts[found] = np.minimum(counts[found] + n, 2)
        if now is not None:
            yield done()

    return merge


def repeated_cells(docs: DataFrame, cells: int, width: int = WINDOW, held: int = HELD) -> Broadcast:
    """The merged sketch of all windows: an array of ``DEPTH`` lines with a bit for each cell."""
    spark = docs.sparkSession
    parts = docs.mapInArrow(_sketcher(cells, width, held), "line int, range int, gaps binary")
    parts = parts.repartition("line", "range").sortWithinPartitions("line", "range")
    merged = parts.mapInArrow(_merger(_span(cells)), "line int, range int, twice binary")
    sketch = np.zeros((DEPTH, cells // DEPTH // 8), np.uint8)
    size = _span(cells) // 8
    for r in merged.toLocalIterator():
        at = r["range"] * size
        sketch[r["line"], at : at + size] = np.frombuffer(r["twice"], np.uint8)
    return spark.sparkContext.broadcast(sketch)


def _selector(sketch: Broadcast, cells: int, width: int, shards: int, most: int):
    """Windows that may be repeated, by shard: keys of 96 bits and runs of the documents they are from."""
    schema = pa.schema([("shard", pa.int32()), ("k1", pa.binary()), ("k2", pa.binary()), ("docs", pa.binary()), ("runs", pa.binary())])

    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        k1, k2, doc = (np.concatenate(x) for x in zip(*held))
        shard = (k1 % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        k1, k2, doc, shard = k1[order], k2[order], doc[order], shard[order]
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        rows = []
        for a, b in zip(cuts, [*cuts[1:], len(shard)]):
            new = np.flatnonzero(np.concatenate([[True], doc[a + 1 : b] != doc[a : b - 1]]))
            runs = np.diff(np.append(new, b - a)).astype(np.uint32)
            rows.append((int(shard[a]), k1[a:b].tobytes(), k2[a:b].astype(np.uint32).tobytes(), doc[a:b][new].tobytes(), runs.tobytes()))
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        held, n = [], 0
        for k1, k2, doc in _texts(batches, width):
            keep = np.ones(len(k1), bool)
            for line, cell in zip(bits, _cells(k1, k2, cells)):
                keep &= (line[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
            held.append((k1[keep], k2[keep], doc[keep]))
            n += int(keep.sum())
            if n > most:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return select


def _unit(doc: np.ndarray, units: int) -> np.ndarray:
    return (mix64(doc.view(np.uint64) + np.uint64(1)) % np.uint64(units)).astype(np.int64)


def _grouper(units: int):
    """Of each shard's windows those whose smallest document is another one, by unit of documents."""
    schema = pa.schema([("unit", pa.int64()), ("docs", pa.binary()), ("keys", pa.binary())])

    def judge(held: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
        k1 = np.concatenate([np.frombuffer(h[0], np.uint64) for h in held])
        k2 = np.concatenate([np.frombuffer(h[1], np.uint32) for h in held])
        doc = np.concatenate([np.repeat(np.frombuffer(h[2], np.int64), np.frombuffer(h[3], np.uint32)) for h in held])
        order = np.lexsort((doc, k2, k1))
        k1, k2, doc = k1[order], k2[order], doc[order]
        new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        k1, doc = k1[doc > least], doc[doc > least]
        unit = _unit(doc, units)
        order = np.lexsort((doc, unit))
        k1, doc, unit = k1[order], doc[order], unit[order]
        cuts = np.flatnonzero(np.diff(unit, prepend=-1))
        ends = [*cuts[1:], len(unit)]
        for part in range(0, len(cuts), 4096):
            spans = list(zip(cuts[part : part + 4096], ends[part : part + 4096]))
            columns = [[int(unit[a]) for a, _ in spans], [doc[a:b].tobytes() for a, b in spans], [k1[a:b].tobytes() for a, b in spans]]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "k1", "k2", "docs", "runs")]
            for shard, *row in zip(*columns):
                if shard != now and held:
                    yield from judge(held)
                    held = []
                now = shard
                held.append(tuple(row))
        if held:
            yield from judge(held)

    return group


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def _remover(width: int):
    def cut(part: pa.RecordBatch, keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        """Texts without the words under windows whose key is listed for their document (both sorted by document)."""
        words = split_words(part.column("text"))
        spelled = words.distinct.to_pylist()
        k1, _, counts = window_keys(words, width)
        starts = np.concatenate([[0], np.cumsum(counts)])
        ids = part.column("doc_id").to_pylist()
        sizes, removed, texts = np.diff(words.ends), [], []
        for i, key in enumerate(ids):
            a, b = words.ends[i], words.ends[i + 1]
            own = words.codes[a:b]
            lo, hi = np.searchsorted(docs, [key, key + 1]) if key is not None else (0, 0)
            if hi > lo and counts[i]:
                hit = np.flatnonzero(np.isin(k1[starts[i] : starts[i + 1]], keys[lo:hi]))
                steps = np.zeros(b - a + 1, np.int64)
                np.add.at(steps, hit, 1)
                np.add.at(steps, hit + width, -1)
                own = own[np.cumsum(steps)[:-1] == 0]
            removed.append(int(b - a - len(own)))
            texts.append(" ".join([spelled[c] for c in own.tolist()]))
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts)], schema=_KEPT)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each unit the lists come first, then the documents.
        now, held = None, []
        docs = keys = np.zeros(0, np.int64)
        for batch in batches:
            units = batch.column("unit").to_numpy()
            listed = batch.column("docs").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], (units[1:] != units[:-1]) | (listed[1:] != listed[:-1])]))
            for a, b in zip(cuts, [*cuts[1:], len(units)]):
                part = batch.slice(a, b - a)
                if units[a] != now:
                    now, held = units[a], []
                    docs = keys = np.zeros(0, np.int64)
                if listed[a]:
                    held += zip(part.column("docs").to_pylist(), part.column("keys").to_pylist())
                    continue
                if held:
                    docs = np.frombuffer(b"".join(h[0] for h in held), np.int64)
                    keys = np.frombuffer(b"".join(h[1] for h in held), np.uint64)
                    order = np.argsort(docs, kind="stable")
                    docs, keys, held = docs[order], keys[order], []
                for some in slices(part, "text"):
                    yield cut(some, keys, docs)

    return remove


def remove_repeats(docs: DataFrame, *, width: int = WINDOW, cells: int | None = None, held: int = HELD) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)``, one per row of ``docs``.

    A word goes if a window of ``width`` words that covers it also starts in a document with a smaller
    ``doc_id``; windows are judged on the input. Words are joined by one space. Null text has no
    words, texts shorter than a window are kept, and a row without id neither loses nor takes
    words. Rows that repeat a ``doc_id`` don't count against each other. An empty table gives no rows.

    ``cells`` is a power of two, at least 16. The texts move once, at the end; before that only bytes per window move. A task groups
    one shard after another, and shards do not grow with the table. A window that very many
    documents share costs its shard 16 bytes for each slice and document.
    """
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = light.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if cells is None:
        cells = min(max(1 << max(total // 2 - 1, 0).bit_length(), DEPTH * RANGE), MOST_CELLS)
    units = max(total // SLICE_BYTES, 1) * 2
    shards = max(partitions(docs.sparkSession), total // SHARD_BYTES)
    known = light.where("doc_id is not null")
    sketch = repeated_cells(known, cells, width, held)
    chosen = known.mapInArrow(_selector(sketch, cells, width, shards, held), "shard int, k1 binary, k2 binary, docs binary, runs binary")
    chosen = chosen.repartition("shard").sortWithinPartitions("shard")
    lists = chosen.mapInArrow(_grouper(units), "unit long, docs binary, keys binary")

    @F.arrow_udf("long")
    def unit_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            yield pa.array(_unit(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), units))

    texts = light.select(unit_of("doc_id").alias("unit"), "doc_id", "text")
    both = lists.unionByName(texts, allowMissingColumns=True).repartition("unit")
    both = both.sortWithinPartitions("unit", F.col("docs").isNull(), "doc_id").select("unit", "doc_id", "text", "docs", "keys")
    return both.mapInArrow(_remover(width), "doc_id long, n_words long, n_removed long, kept_text string")
