"""Word-piece matching of whole Arrow batches: the helper behind ``operators.tokens.tokenise``.

The work follows the distinct chunks of a batch: texts are split and counted by Arrow, only chunks that
were not seen before are matched, and their ids are laid out by position.
"""

from __future__ import annotations

import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distinct chunks, and bytes of them and their ids, remembered per task before the memory is started afresh.
REMEMBERED = 500_000
REMEMBERED_BYTES = 32 << 20
# Text whose chunks are laid out at a time, whatever the size of an Arrow batch; a longer text is laid out alone.
SLICE_BYTES = 2 << 20

# Pieces that stand for themselves in a text, and characters that are dropped.
_SPECIAL = re.compile(r"\[(?:PAD|UNK|CLS|SEP|MASK)\]")
_CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\x{fffd}]+"


def _is_cjk(ch: str) -> bool:
    return "CJK" in unicodedata.name(ch, "") and unicodedata.category(ch) == "Lo"


def _is_mark(ch: str) -> bool:
    if ch.isascii():
        return not ch.isalnum() and ch.isprintable() and ch != " "
    return unicodedata.category(ch)[0] == "P"


def words_of(chunk: str) -> list[str]:
    """A whitespace-free chunk as lower-case words without accents; punctuation
    and ideographs stand alone, control, unassigned and private characters go."""
    text = chunk.lower()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    if text.isalnum() and text.isascii():
        return [text]
    spaced = []
    for ch in text:
        if unicodedata.category(ch)[0] == "C" or ch == "�":
            continue
        alone = _is_mark(ch) or (not ch.isascii() and _is_cjk(ch))
        spaced.append(f" {ch} " if alone else ch)
    return "".join(spaced).split()


def pieces_of(word: str, vocab: dict[str, int], unknown: int, longest: int) -> list[int]:
    """Greedy longest match from the left; later pieces carry the ``##`` prefix.

    No piece is longer than ``longest``.
    """
    ids, start = [], 0
    while start < len(word):
        mark = "##" if start else ""
        for end in range(min(len(word), start + longest), start, -1):
            found = vocab.get(mark + word[start:end])
            if found is not None:
                ids.append(found)
                start = end
                break
        else:
            return [unknown]
    return ids


class PieceIds:
    """A function from an array of texts to an array of their piece ids."""

    def __init__(self, vocab: dict[str, int], unknown: str = "[UNK]"):
        self.vocab, self.unknown = vocab, vocab[unknown]
        self.longest = max(map(len, vocab))
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.begins, self.sizes, self.ids = array("q"), array("q"), array("i")
        self.bytes = 0

    def chunk(self, chunk: str) -> list[int]:
        if chunk in self.vocab and _SPECIAL.fullmatch(chunk):
            return [self.vocab[chunk]]
        return [i for word in words_of(chunk) for i in pieces_of(word, self.vocab, self.unknown, self.longest)]

    def row(self, chunk: str) -> int:
        found = self.rows.get(chunk)
        if found is None:
            found = self.rows[chunk] = len(self.sizes)
            ids = self.chunk(chunk)
            self.begins.append(len(self.ids))
            self.sizes.append(len(ids))
            self.ids.extend(ids)
            # A string, its entry and its place, four bytes an id.
            self.bytes += 4 * len(chunk) + 4 * len(ids) + 150
        return found

    def __call__(self, texts: pa.Array) -> pa.ListArray:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        return pa.concat_arrays([self.of_slice(texts.slice(a, b - a)) for a, b in zip(starts, starts[1:])])

    def of_slice(self, texts: pa.Array) -> pa.ListArray:
        if len(self.rows) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.forget()
        texts = pc.replace_substring_regex(pc.fill_null(texts, ""), _CONTROLS, "")
        texts = pc.replace_substring_regex(texts, f"({_SPECIAL.pattern})", r" \1 ")
        parts = pc.utf8_split_whitespace(texts)
        coded = parts.flatten().dictionary_encode()
        rows = np.array([self.row(c) for c in coded.dictionary.to_pylist()], np.int64)
        row = rows[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = np.array(self.sizes, np.int64)[row]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        picks = np.repeat(np.array(self.begins, np.int64)[row] - stops[:-1], sizes) + np.arange(stops[-1])
        ends = parts.offsets.to_numpy()
        offsets = stops[ends - ends[0]].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.array(self.ids, np.int32)[picks]))
