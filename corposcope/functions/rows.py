"""Cutting sorted token arrays into rows of one length: the helper behind ``operators.tokens.pack_sorted``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Tokens that are laid out at a time; a longer array is laid out alone.
SLICE_TOKENS = 1 << 18


def row_sizes(lists: pa.ListArray) -> np.ndarray:
    return np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)


def whole(column: pa.Array, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The tokens of a column that ``arrays.slimmed`` made, in a row: those between the ends of an array are one value, or all are written out."""
    field = lambda name: column.field(column.type.get_field_index(name))
    full = field("full")
    if full.null_count < len(full):
        parts = []
        for i in range(len(full)):
            one = full.slice(i, 1)
            parts.append(one.flatten() if one.is_valid()[0].as_py() else _even(field, i, 1, sizes, kind))
        return pa.concat_arrays(parts)
    return _even(field, 0, len(full), sizes, kind)


def _even(field, at: int, n: int, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    sizes = sizes[at : at + n]
    stops = np.cumsum(sizes)
    some = sizes > 0
    take = lambda name, valid: field(name).slice(at, n).filter(pa.array(valid)).to_numpy(zero_copy_only=False)
    long = sizes > 2
    values = np.zeros(int(sizes.sum()), kind.to_pandas_dtype())
    inner = np.zeros(n, values.dtype)
    inner[long] = take("mid", long)
    values[:] = np.repeat(inner, sizes)
    values[(stops - sizes)[some]] = take("first", some)
    values[(stops - 1)[some]] = take("last", some)
    return pa.array(values, kind)


class Cutter:
    """Rows of ``length`` from arrays in order. A batch is ``batch_size`` arrays of a slab; its last row is filled up.

    Only the tokens of an unfinished row are kept from one call to the next.
    """

    def __init__(self, names: list[str], fills: list, kinds: list[pa.DataType], length: int, batch_size: int, slab_rows: int):
        self.names, self.kinds, self.length = names, kinds, length
        self.batch_size, self.slab_rows = batch_size, slab_rows
        self.fill = [pa.array([f] * length, k) for f, k in zip(fills, kinds)]
        self.slab, self.place, self.batch = None, 0, None
        self.begin(None)

    def begin(self, batch: int | None) -> None:
        self.batch, self.chunk, self.rest = batch, 0, [f.slice(0, 0) for f in self.fill]

    def layout(self, rows: list[tuple[int, int, list[pa.Array]]]) -> Iterator[pa.RecordBatch]:
        """``rows`` are runs of whole rows: batch, first chunk and the tokens of each column."""
        rows = [r for r in rows if len(r[2][0])]
        if not rows:
            return
        counts = np.array([len(r[2][0]) // self.length for r in rows])
        batch = np.repeat(np.array([r[0] for r in rows], np.int64), counts)
        first = np.repeat(np.array([r[1] for r in rows], np.int64) - (np.cumsum(counts) - counts), counts)
        ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * self.length)
        lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays([r[2][i] for r in rows])) for i in range(len(self.names))]
        yield pa.RecordBatch.from_arrays([pa.array(batch), pa.array(first + np.arange(len(batch))), *lists], ["batch", "chunk", *self.names])

    def closed(self) -> tuple[int, int, list[pa.Array]]:
        """The last row of the batch, filled up; without tokens there is none."""
        missing = -len(self.rest[0]) % self.length
        return self.batch, self.chunk, [pa.concat_arrays([r, f.slice(0, missing)]) for r, f in zip(self.rest, self.fill)]

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = row_sizes(rows.column(self.names[0]))
        part = np.cumsum(sizes) // SLICE_TOKENS
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), rows.num_rows]
        for a, b in zip(starts, starts[1:]):
            if a < b:
                yield from self.add_slice(rows.slice(a, b - a), sizes[a:b])

    def add_slice(self, rows: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        slabs = rows.column("slab").to_numpy()
        changes = np.flatnonzero(np.diff(slabs)) + 1
        begins = np.concatenate([[0], changes]).astype(np.int64)
        places = np.arange(len(slabs)) - np.repeat(begins, np.diff([*begins, len(slabs)]))
        if slabs[0] == self.slab:
            places[: changes[0] if len(changes) else None] += self.place
        self.slab, self.place = slabs[-1], int(places[-1]) + 1
        batches = (slabs * self.slab_rows + places) // self.batch_size
        columns = [rows.column(self.names[0]).flatten()]
        columns += [whole(rows.column(n), sizes, k) for n, k in zip(self.names[1:], self.kinds[1:])]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        runs = np.concatenate([[0], np.flatnonzero(np.diff(batches)) + 1, [len(batches)]])
        out = []
        for a, b in zip(runs.tolist(), runs[1:].tolist()):
            if batches[a] != self.batch:
                out.append(self.closed())
                self.begin(int(batches[a]))
            tokens = [pa.concat_arrays([r, c.slice(stops[a], stops[b] - stops[a])]) for r, c in zip(self.rest, columns)]
            n = len(tokens[0]) // self.length
            out.append((self.batch, self.chunk, [t.slice(0, n * self.length) for t in tokens]))
            self.chunk += n
            # Copied, so that the slice goes.
            self.rest = [pa.concat_arrays([t.slice(n * self.length), t.slice(0, 0)]) for t in tokens]
        yield from self.layout(out)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                yield from self.add(rows)
        yield from self.layout([self.closed()])
