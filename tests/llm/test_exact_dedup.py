import hashlib
from collections import defaultdict

import pytest
from llm_helpers import ascii_lower

from corposcope.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[ascii_lower(r[1])].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = first and i != keep
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1, 7, 64, 2048])
def test_odd_rows(odd, odd_rows, block):
    rows = [r for r in odd_rows if block > 1 or len(r[1] or "") < 200]
    got = exact_dedup.exact_duplicates(odd.sparkSession.createDataFrame(rows, odd.schema), block_bytes=block)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_texts_of_equal_blocks_in_other_order(spark):
    rows = [(i, t) for i, t in enumerate(["aabbab", "aabbba", "abaabb", "aabbab", "aabb", "ab", "aab", "abab"])]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=2)
    assert {r.doc_id: r.keep_id for r in got.collect()} == {0: 3, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7}


def test_empty(none):
    assert exact_dedup.exact_duplicates(none).collect() == []
    assert exact_dedup.drop_duplicates(none).collect() == []


def test_dropping_keeps_one_row_of_each_text_and_all_columns(odd, odd_rows):
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [ascii_lower(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({ascii_lower(r[1]) for r in odd_rows})


def test_a_hot_text_is_counted_whole(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('hot ', 900), cast(id as string)) as text").repartition(8)
    rows = exact_dedup.exact_duplicates(docs).collect()
    hot = [r for r in rows if r.group_size > 1]
    assert len(rows) == 3000 and len(hot) == 1000 and {r.keep_id for r in hot} == {2997}


def test_columns_with_names_of_the_operators_own(spark):
    from corposcope.llm import simhash

    names = ["_id", "_own", "_sha", "_text", "_key", "_kept", "_row", "none", "c"]
    docs = spark.createDataFrame([(1, "one two", *names), (2, "ONE two", *names), (2, "ONE two", *names)], ["doc_id", "text", *names])
    for kept, key in ((exact_dedup.drop_duplicates(docs), 2), (simhash.drop_near_duplicates(docs), 1)):
        assert kept.columns == docs.columns
        assert [tuple(r)[2:] for r in kept.collect()] == [tuple(names)] and kept.first().doc_id == key
