import hashlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import words_of

from corposcope.llm import sketches


def shingles(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def containment(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / min(len(a), len(b)) if a and b else float(len(a) == len(b))


def edits(rows):
    """Rows by falling id; rows of one id in any order, so only distinct ids are passed in."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for i, (key, text, *_) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 3
        yield key, text, text[: len(text) - n] + after[:n], after


@pytest.mark.parametrize("parts", [1, 9])
def test_documents(documents, parts, monkeypatch):
    monkeypatch.setattr(sketches, "partitions", lambda spark: parts)
    got = {r.doc_id: r for r in sketches.compare_edits(documents).collect()}
    want = list(edits([(r.doc_id, r.text) for r in documents.collect()]))
    assert len(got) == len(want)
    errors = []
    for key, text, edited, after in want:
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append((r.near_edited - containment(text, edited), r.near_next - containment(text, after)))
    assert np.abs(errors).mean(axis=0).max() < 0.05 and np.abs(errors).max() < 0.35


def test_odd_rows(spark, odd, odd_rows, none):
    rows = sketches.compare_edits(odd).collect()
    assert len(rows) == len(odd_rows) and all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    unique = [r for r in odd_rows if [o[0] for o in odd_rows].count(r[0]) == 1]
    got = {r.doc_id: r for r in sketches.compare_edits(spark.createDataFrame(unique, odd.schema)).collect()}
    for key, text, edited, _ in edits(unique):
        assert got[key].n_chars == len(text) and got[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert sketches.compare_edits(none).collect() == []
    alone = sketches.compare_edits(spark.createDataFrame([(5, "one row only here")], "doc_id long, text string")).collect()
    assert alone[0].near_next == 1 and alone[0].n_chars == 17


def test_equal_texts_have_equal_fingerprints(odd):
    rows = sketches.with_fingerprint(odd).collect()
    assert len({(r.text or "", r.fingerprint) for r in rows}) == len({r.text or "" for r in rows})
    assert {r.fingerprint for r in rows if not words_of(r.text)} == {""}


def test_merged_sketches_are_the_sketch_of_both():
    rng = np.random.default_rng(3)
    for n, m in ((10, 15), (30, 900), (900, 1200), (3, 3), (0, 50)):
        a, b = (" ".join(rng.choice(list("abcdefghijklmnop"), k)) for k in (n, m))
        one, two = sketches.sketches(pa.array([a, b]))
        merged = sketches.merge(one, two)
        low = min(sketches.threshold(one), sketches.threshold(two))
        assert set(merged) <= set(one) | set(two)
        assert {h for h in (*one, *two) if h < low * sketches.FRACTION} <= set(merged)
        if max(n, m) < 30:  # small sketches have all shingles
            assert set(merged) == set(one) | set(two)


def test_containment_of_very_unequal_texts():
    words = [f"w{i}" for i in range(20_000)]
    large, small, other = " ".join(words), " ".join(words[500:900]), " ".join(f"v{i}" for i in range(400))
    a, b, c = sketches.sketches(pa.array([large, small, other]))
    assert sketches.likeness(a, b) == sketches.likeness(b, a) == 1 and sketches.likeness(a, c) == 0
    assert 0.2 < len(a) / 20_000 < 0.3
