from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import words_of

from corposcope.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Reshares the excess of full sources until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def result(docs):
    return mixing.mix_sources(mixing.with_sizes(docs)).collect()


def test_targets_and_sizes(documents):
    rows = result(documents)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len(words_of(r.text)) and 0 <= r.copies <= 2
        sizes[r.source] += r["size"]
        taken[r.source] += r.copies * r["size"]
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.05)


def test_rates_solve_the_dual(documents):
    """Rates meet the targets and have one multiplier per source, as the bounded entropy asks."""
    by = defaultdict(list)
    for r in result(documents):
        by[r.source].append((r["size"], r.rate, r.target))
    for rows in by.values():
        size, rate, target = map(np.array, zip(*rows))
        assert (size * rate).sum() == pytest.approx(target[0], rel=1e-5)
        inner = (rate > 1e-9) & (rate < 2 - 1e-9)
        tilt = np.log(rate[inner] / (2 - rate[inner])) / size[inner]
        assert len(tilt) == 0 or np.ptp(tilt) < 1e-5


def test_reruns_agree(documents):
    a, b = ({(r.doc_id, r.copies) for r in result(d)} for d in (documents, documents.repartition(5)))
    assert a == b


def test_odd_rows(odd, odd_rows):
    rows = result(odd)
    assert len(rows) == len(odd_rows)
    assert all(r.copies == 0 for r in rows if not words_of(r.text))
    assert {r.source for r in rows} == {r[3] for r in odd_rows}
    assert mixing.repeat_documents(odd).columns == odd.columns
    repeated = mixing.repeat_documents(odd).groupBy("doc_id", "text").count().collect()
    assert sum(r["count"] for r in repeated) == sum(r.copies for r in rows)


def test_empty(none):
    assert result(none) == [] and mixing.repeat_documents(none).collect() == []


def test_a_hot_source_and_size_is_salted(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 50)
    docs = spark.range(900).selectExpr("id as doc_id", "if(id % 3 > 0, 'hot', 'b') as source", "'a b c' as text")
    rows = result(docs)
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += r.copies * 3
    assert len(rows) == 900 and taken == {"b": 1800, "hot": 2250}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 1}, {"a": 1, "b": 100, "c": 1, None: 5}, {"a": 0, "b": 0}, {"x": 7}])
def test_resharing(spark, sizes):
    table = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    want = targets(sizes)
    assert all(got[s] == pytest.approx(want[s]) for s in sizes)
