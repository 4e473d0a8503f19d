import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_helpers import ascii_lower, words_of
from hypothesis import given, strategies as st

from corposcope.llm import simhash


def fingerprint(text):
    words = words_of(ascii_lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(rows):
    """Smallest id over the graph of all links, by brute force."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(fps, 2):
        if bin(a ^ b).count("1") <= 3:
            root[find(a)] = find(b)
    least = {}
    for key, f in rows:
        if key is not None:
            least[find(f)] = min(least.get(find(f), key), key)
    return sorted(((key, f, least.get(find(f))) for key, f in rows), key=str)


def got(docs):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)


def test_documents(documents):
    assert got(documents) == component_ids([(r.doc_id, fingerprint(r.text)) for r in documents.collect()])


def test_odd_rows(odd, odd_rows, none):
    assert got(odd) == component_ids([(r[0], fingerprint(r[1])) for r in odd_rows])
    assert got(none) == [] and simhash.drop_near_duplicates(none).collect() == []


def test_one_row_of_each_group_stays(odd):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    roots = {r.root for r in simhash.near_duplicates(odd).collect()}
    root_of = {r.fp % (1 << 64): r.root for r in simhash.near_duplicates(odd).collect()}
    assert sorted(root_of[fingerprint(r.text)] for r in kept.collect()) == sorted(roots)


def test_groups_without_an_id_or_with_one_id_stay_apart(spark):
    rows = [(None, "one two three four"), (None, "red green blue"), (None, "red green blue"), (None, "sun moon star sky")]
    rows += [(1, "north south east west"), (1, "spring summer autumn"), (2, "spring summer autumn"), (None, "north south east west")]
    assert len({fingerprint(t) for _, t in rows}) == len(component_ids([(i, fingerprint(t)) for i, (_, t) in enumerate(dict.fromkeys(rows))])) - 2 == 5
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, "one two three four"), (None, "red green blue"), (None, "sun moon star sky"), (1, "north south east west"), (1, "spring summer autumn")]
    assert sorted(map(tuple, kept), key=str) == sorted(want, key=str)


def clustered(n, seed):
    """Random fingerprints, chains of near ones and a dense group around one value."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        out.append(out[rng.randrange(len(out))] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    centre = rng.getrandbits(64)
    return sorted({*out, *(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(n))})


@pytest.mark.parametrize("bucket_rows", [4096, 16])
@pytest.mark.parametrize("layout", [None, [(range(32), 1), (range(32, 64), 1)], [(range(22), 1), (range(22, 43), 0), (range(43, 64), 0)], [(range(0, 64, 2), 0), (range(1, 64, 2), 2)]])
def test_every_plan_finds_every_component(spark, monkeypatch, layout, bucket_rows):
    fps = clustered(150, 3)
    if layout:
        monkeypatch.setattr(simhash, "probe_plan", lambda *_: [(list(bits), t) for bits, t in layout])
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.hamming_links(table, bucket_rows=bucket_rows)
    found = {tuple(sorted((r.u % (1 << 64), r.v % (1 << 64)))) for r in links.collect()}
    assert all(0 < bin(a ^ b).count("1") <= 3 for a, b in found)
    want = component_ids([(f, f) for f in fps])
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in found:
        root[find(a)] = find(b)
    least = {}
    for f in fps:
        least[find(f)] = min(least.get(find(f), f), f)
    assert sorted(((f, f, least[find(f)]) for f in fps), key=str) == want


@given(st.lists(st.lists(st.floats(0, 100), min_size=5, max_size=5), min_size=2, max_size=4))
def test_thresholds_are_the_cheapest(costs):
    budget = 3 - len(costs) + 1

    def every(i):
        return [[]] if i == len(costs) else [[t, *rest] for t in range(-1, 4) for rest in every(i + 1)]

    best = min(sum(c[t + 1] for c, t in zip(costs, ts)) for ts in every(0) if sum(ts) == budget)
    total, chosen = simhash.thresholds(costs, budget)
    assert sum(chosen) == budget and total == pytest.approx(best) and total == pytest.approx(sum(c[t + 1] for c, t in zip(costs, chosen)))


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (2000, 64))
    bits[:, 40:48] = bits[:, :1]
    together = (bits.T @ bits).astype(float)
    groups = simhash.correlated_groups(together, 2000, 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and [len(g) for g in groups] == [16] * 4
    assert {0, *range(40, 48)} <= set(groups[0])
