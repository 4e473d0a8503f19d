from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from corposcope.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def check(rows, docs, tokenizer, length):
    """Exact round trip: the pieces of a document give its ids, the pieces of a sequence fill it without a gap."""
    want = sorted(str((key, tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for key, t in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    if len(by_doc) == len(docs):  # no repeated ids
        got = sorted(str((key, [i for _, _, ids in sorted(ps) for i in ids])) for key, ps in by_doc.items())
        assert got == want
    assert sum(len(i) for ps in by_doc.values() for _, _, i in ps) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    return by_sequence


def test_documents(documents, tokenizer):
    rows = packing.pack_documents(documents, packing.tokenizer_path()).collect()
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    filled = [sum(n for _, n in s) for s in check(rows, docs, tokenizer, 2048).values()]
    padding = sum(2048 - n for n in filled if n & (n - 1))
    assert padding < 0.03 * sum(filled)


def test_small_sequences_and_groups(documents, tokenizer):
    rows = packing.pack_documents(documents, packing.tokenizer_path(), length=16, group_bytes=10_000).collect()
    check(rows, [(r.doc_id, r.text) for r in documents.collect()], tokenizer, 16)


def test_odd_rows(odd, odd_rows, none, tokenizer):
    rows = packing.pack_documents(odd, packing.tokenizer_path()).collect()
    check(rows, [r[:2] for r in odd_rows], tokenizer, 2048)
    assert packing.pack_documents(none, packing.tokenizer_path()).collect() == []


def test_reruns_agree(documents):
    a, b = (set(map(tuple, packing.pack_documents(d, packing.tokenizer_path()).collect())) for d in (documents, documents.repartition(7)))
    assert a == b


ALPHABET = st.sampled_from(list("aAbB'sStTlLdD. ,!_|<>-09éÉßİΣ\xa0\t\ń中") + ["<|endoftext|>", "'ll", " the "])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=4))
def test_ids_of_words_are_ids_of_texts(texts):

    ids = packing.token_ids(packing.tokenizer_path())
    flat, ends = ids(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert flat[ends[i] : ends[i + 1]].tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids + [1]


@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit(sizes):
    bins, offsets, free = *packing.first_fit(sizes, 50), []
    for size, b, o in zip(sizes, bins, offsets):
        want = next((i for i, room in enumerate(free) if room >= size), len(free))
        if want == len(free):
            free.append(50)
        assert (b, o) == (want, 50 - free[want])
        free[want] -= size


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_any_tokeniser_file(name, odd_rows):
    """A file whose tokens go over white space gets whole texts; either way the ids are those of the tokeniser."""
    from tokenizers import Tokenizer

    path = packing.tokenizer_path(name)
    texts = [r[1] for r in odd_rows] + ["  Two  spaces and\ttabs ", "it's <|endoftext|> don't"]
    ids, ends = packing.TokenIds(path)(pa.array(texts))
    whole = Tokenizer.from_file(path)
    for text, a, b in zip(texts, ends, ends[1:]):
        assert ids[a:b].tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
    assert packing.TokenIds(path).by_words == name.startswith("word")


def test_parts_are_tokenised_once(monkeypatch):
    """Words that differ in case and punctuation only share their letters, however many words there are."""
    asked = []
    of_part = packing.TokenIds.part
    monkeypatch.setattr(packing.TokenIds, "part", lambda self, letters: asked.append(letters) or of_part(self, letters))
    ids_of = packing.TokenIds(packing.tokenizer_path())
    for text in ("sun, Sun. SUN! (sun été", "Été! sun? ÉTÉ, a<|b 1st"):
        ids, _ = ids_of(pa.array([text]))
        assert ids.tolist() == [*ids_of.tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert sorted(asked) == sorted(["sun", "été", ",", ".", "!", "?"])
