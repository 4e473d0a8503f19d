"""Packing documents into sequences: first-fit decreasing in randomised groups.

Documents are dealt into random groups of about equal bytes. Inside a group every document is
tokenised and cut into full sequences and a rest; the rests, longest first, go to the first
sequence with room, which a tournament tree over the free lengths finds in logarithmic time.
Only the texts move, once; groups are packed independently and in a stream.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import slices, split_words

# Fixed values of the contract.
SEQUENCE = 2048
END_ID = 1
# Bytes of text in a group, on average.
GROUP_BYTES = 2 << 20
# Distinct parts of words whose ids a worker remembers before it starts afresh.
REMEMBERED = 300_000

_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
# A word that the tokeniser cuts in front of its punctuation and nowhere else; the letters are composed ones.
_PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
# How a tokeniser has to prepare a text so that its ids are those of its words, as taken apart here.
_PREPARED = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split", "behavior": "Removed", "invert": True,
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class Symbols(dict):
    """For ``str.translate``: what the byte-level pre-tokeniser makes of a character, asked once."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        self.bytes_of = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __missing__(self, character: int) -> str:
        found = self[character] = self.bytes_of(chr(character))[0][0]
        return found


def spans(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all items of several runs, one run after the other, and where each run ends there."""
    stops = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(begins - stops[:-1], sizes) + np.arange(stops[-1]), stops


class TokenIds:
    """Ids of whole texts. Where white space always separates tokens, the ids of a text are those of
    its words, and those of a plain word are its letters' and its punctuation's; words are taken apart
    natively, and the tokeniser sees each distinct part once while it is remembered. A file that says otherwise
    gets whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        self.by_words = all(told[k] == v for k, v in _PREPARED.items()) and all("<|" in t["content"] for t in told["added_tokens"])
        self.symbols = Symbols()
        self.forget()

    def forget(self) -> None:
        # The first row is that of a part that is not there.
        self.rows: dict[str, int] = {"": 0}
        self.sizes, self.ids = array("q", [0]), array("I")

    def part(self, letters: str) -> list[int]:
        """Ids of lower-case letters or of punctuation, which the pre-tokeniser leaves whole."""
        symbols = letters if letters.isascii() else letters.translate(self.symbols)
        return [t.id for t in self.tokenizer.model.tokenize(symbols)]

    def whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def rows_of(self, texts: pa.Array, ids_of: Callable[[str], list[int]]) -> np.ndarray:
        """The row of each text. A text is always a part or always a whole word, as words that are not plain
        or hold ``<|`` are no parts of others."""
        coded = texts.dictionary_encode()
        names = coded.dictionary.to_pylist()
        new = [n for n in names if n not in self.rows]
        found = [ids_of(n) for n in new]
        self.rows.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
        self.sizes.extend(map(len, found))
        self.ids.extend(chain.from_iterable(found))
        rows = np.fromiter(map(self.rows.__getitem__, names), np.int64, len(names))
        return rows[coded.indices.to_numpy(zero_copy_only=False)]

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids + [END_ID] for e in self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.cumsum([0, *map(len, found)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, each followed by the end id, and where each text ends."""
        if not self.by_words:
            return self.of_texts(texts.to_pylist())
        if len(self.rows) > REMEMBERED:
            self.forget()
        distinct, codes, ends = split_words(texts)
        taken = pc.extract_regex(distinct, _PLAIN)
        apart = pc.and_not(pc.is_valid(taken), pc.match_substring(distinct, "<|"))
        plain = apart.to_numpy(zero_copy_only=False)
        rows = np.zeros((len(distinct), 2), np.int64)
        rows[plain, 0] = self.rows_of(pc.utf8_lower(taken.field("letters").filter(apart)), self.part)
        rows[plain, 1] = self.rows_of(taken.field("marks").filter(apart), self.part)
        rows[~plain, 0] = self.rows_of(distinct.filter(pc.invert(apart)), self.whole)
        # The ids of all distinct words, and the end id as one more word after each text.
        sizes = np.array(self.sizes)
        picks, stops = spans((np.cumsum(sizes) - sizes)[rows.ravel()], sizes[rows.ravel()])
        ids = np.append(np.array(self.ids, np.uint32)[picks], np.uint32(END_ID))
        begins = stops[::2]
        codes = np.insert(codes, ends[1:], len(distinct))
        picks, stops = spans(begins[codes], np.append(np.diff(begins), 1)[codes])
        return ids[picks], stops[ends + np.arange(len(ends))]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenisers keep a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def token_ids(path: str) -> TokenIds:
    return TokenIds(path)


def first_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, put in the given order into the first bin with room.

    The tree's leaves are the free lengths of the bins, unopened ones too, and an inner node
    the larger of its two.
    """
    width = 1 << max(len(sizes) - 1, 0).bit_length()
    tree = [capacity] * (2 * width)
    bins, offsets = [], []
    for size in sizes:
        node = 1
        while node < width:
            node *= 2
            if tree[node] < size:
                node += 1
        bins.append(node - width)
        offsets.append(capacity - tree[node])
        tree[node] -= size
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
    return bins, offsets


def _packed(group: int, doc_ids: list, docs: list[np.ndarray], length: int) -> pa.RecordBatch:
    """The pieces of one group. Full sequences are numbered after the shared ones."""
    rests = sorted((i for i, d in enumerate(docs) if len(d) % length), key=lambda i: -(len(docs[i]) % length))
    bins, offsets = first_fit([len(docs[i]) % length for i in rests], length)
    used = max(bins, default=-1) + 1
    rows = [(i, len(docs[i]) - len(docs[i]) % length, b, o) for i, b, o in zip(rests, bins, offsets)]
    for i, d in enumerate(docs):
        for start in range(0, len(d) - length + 1, length):
            rows.append((i, start, used, 0))
            used += 1
    owner = [r[0] for r in rows]
    pieces = [docs[i][s : s + length] for i, s, _, _ in rows]
    columns = [
        [doc_ids[i] for i in owner], [r[1] for r in rows], [len(p) for p in pieces], [p.astype("<u4").tobytes() for p in pieces],
        [len(docs[i]) for i in owner], [(group << 32) + r[2] for r in rows], [r[3] for r in rows],
    ]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)


def _packer(path: str, length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = token_ids(path)
        group, keys, docs = None, [], []
        for batch in batches:
            for part in slices(batch, "text"):
                flat, ends = ids_of(part.column("text"))
                rows = zip(part.column("group").to_pylist(), part.column("doc_id").to_pylist(), ends, ends[1:])
                for g, key, a, b in rows:
                    if g != group:
                        if docs:
                            yield _packed(group, keys, docs, length)
                        group, keys, docs = g, [], []
                    keys.append(key)
                    docs.append(flat[a:b])
        if docs:
            yield _packed(group, keys, docs, length)

    return pack


def pack_documents(
    docs: DataFrame, tokenizer: str, *, length: int = SEQUENCE, group_bytes: int = GROUP_BYTES, seed: int = 42
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)`` of all rows of ``docs``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers; ``start`` counts the
    document's ids before it, and ``offset`` the sequence's. ``tokenizer`` is the path of a
    tokeniser file, the same on every machine. A document is cut only where it is longer than a
    sequence. Null text is empty: the end id alone. Repeated rows are packed each, an empty table gives no
    rows, and other columns are not read. Groups depend on ids and texts only, so a rerun packs alike.
    """
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = light.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    groups = max(1, -(-(total["b"] or 0) // group_bytes), total["n"] * 64 // group_bytes)
    draw = F.xxhash64("doc_id", "text", F.lit(seed))
    dealt = light.withColumn("draw", draw).withColumn("group", F.pmod("draw", F.lit(groups)))
    sorted_ = dealt.repartition("group").sortWithinPartitions("group", "draw", "doc_id")
    return sorted_.select("group", "doc_id", "text").mapInArrow(_packer(tokenizer, length), _DDL)
