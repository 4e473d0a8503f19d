import numpy as np
import pytest
from hypothesis import given, strategies as st
from llm_helpers import words_of

from corposcope.llm import substring_dedup


def expected(rows, width=13):
    """Keeps the smallest id of every window and removes what a smaller document has."""
    least = {}
    for key, text, *_ in rows:
        words = words_of(text)
        for p in range(len(words) - width + 1):
            if key is not None:
                window = tuple(words[p : p + width])
                least[window] = min(least.get(window, key), key)
    out = []
    for key, text, *_ in rows:
        words = words_of(text)
        gone = set()
        for p in range(len(words) - width + 1):
            if key is not None and least[tuple(words[p : p + width])] < key:
                gone |= set(range(p, p + width))
        out.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def got(docs, **kw):
    return sorted(map(tuple, substring_dedup.remove_repeats(docs, **kw).collect()), key=str)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = expected(rows)
    assert got(documents) == want and sum(r[2] for r in want) > 0


def test_odd_rows(odd, odd_rows, none):
    assert got(odd) == expected(odd_rows)
    assert got(odd, width=2) == expected(odd_rows, 2)
    assert got(none) == []


def test_a_full_sketch_loses_nothing(documents):
    """With a handful of cells every window counts as repeated, and the exact pass decides alone."""
    assert got(documents, cells=128) == expected([(r.doc_id, r.text) for r in documents.collect()])


def test_small_flushes_change_nothing(odd, odd_rows):
    assert got(odd, held=50, cells=1 << 22) == expected(odd_rows)


@given(st.lists(st.integers(0, 2000), min_size=1).map(sorted))
def test_gaps_round_trip(numbers):
    assert substring_dedup.unpack_gaps(substring_dedup.pack_gaps(np.array(numbers))).tolist() == numbers


@pytest.mark.parametrize("width", [1, 2, 3, 5, 13])
def test_keys_tell_windows_apart(width):
    import pyarrow as pa

    rng = np.random.default_rng(width)
    texts = [" ".join(rng.choice(list("abc"), 40)) for _ in range(5)] + ["", None, "a b"]
    words = substring_dedup.split_words(pa.array(texts))
    k1, k2, counts = substring_dedup.window_keys(words, width)
    windows = [tuple(t[i : i + width]) for t in map(words_of, texts) for i in range(len(t) - width + 1)]
    assert len(windows) == len(k1) == counts.sum()
    assert len(set(windows)) == len(set(zip(k1, k2))) == len(set(k1))
    assert len(set(zip(windows, k1))) == len(set(windows))


def test_many_small_shards(documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 2000)
    assert got(documents) == expected([(r.doc_id, r.text) for r in documents.collect()])
