"""Word pieces of large Arrow batches."""

import pyarrow as pa

from corposcope.functions import pieces
from corposcope.operators import tokens as T


def test_pieces_of_a_large_batch_are_found_slice_by_slice(monkeypatch):
    vocab = {p: i for i, p in enumerate([*T.SPECIAL_PIECES, "a", "##a", "b"])}
    texts = pa.array([None, "", "a b aa", "b" * 9, *["a", "b b"] * 40])
    want = pieces.PieceIds(vocab)(texts)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 5)
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 400)
    small = pieces.PieceIds(vocab)
    seen = []
    monkeypatch.setattr(small, "of_slice", lambda t, f=small.of_slice: seen.append(len(t)) or f(t))
    assert small(texts).equals(want) and max(seen) < 10 and small.bytes < 1000
    assert pieces.PieceIds(vocab)(pa.array([], pa.string())).to_pylist() == []
