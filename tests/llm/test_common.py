import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, strategies as st
from llm_helpers import words_of

from corposcope.llm import common
from corposcope.llm.components import components

TEXT = st.text(alphabet="ab \t\n\x0b\x0c\r\x1cÄ\xa0", max_size=20)


@given(st.lists(st.none() | TEXT, max_size=6))
def test_words(texts):
    distinct, codes, ends = common.split_words(pa.array(texts, pa.string()))
    spelled = distinct.to_pylist()
    assert [[spelled[c] for c in codes[a:b]] for a, b in zip(ends, ends[1:])] == [words_of(t) for t in texts]


@given(st.lists(st.none() | TEXT, max_size=9), st.integers(1, 30))
def test_slices_keep_rows_in_order(texts, budget):
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    parts = list(common.slices(batch, "text", budget))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows for p in parts)


@given(st.lists(st.integers(0, 9), max_size=6), st.integers(1, 4))
def test_runs(sizes, width):
    ends = np.cumsum([0, *sizes])
    first, counts = common.runs_of(ends, width)
    assert first.tolist() == [i for a, b in zip(ends, ends[1:]) for i in range(a, b - width + 1)]
    assert counts.tolist() == [max(n - width + 1, 0) for n in sizes]


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 2), (9, 5), (7, 8), (7, 8), (-3, 8)]])
def test_components(spark, links):
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {(r.node, r.root) for r in got} == {(n, r) for n, r in root.items() if n != r}
    assert len(got) == len({r.node for r in got})
