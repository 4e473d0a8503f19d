import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import words_of

from corposcope.llm import prefix_trie


def rebuilt(rows):
    """conv_id -> list of (role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        more = (len(members) - 1) * (len(words_of(path[-1][1])) if path else 0)
        for d in range(len(path) + 1):
            saved[path[:d]] += more
            leaves[path[:d]] += path not in children
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(path)))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **sizes):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = prefix_trie.prefix_trie(table, **sizes)
    assert found.columns == prefix_trie.RESULT
    return sorted(map(tuple, found.collect()), key=str)


ODD = [
    (0, 0, "user", "one two"), (0, None, None, None), (0, 1, "assistant", "three"), (0, 1, "assistant", "three"), (0, 1, "assistant", "four five"),
    (1, 0, "user", "x"), (3, 0, "user", None), (3, 5, None, "a b c"), (20, None, "", ""), (21, 2, "user", "one two"), (22, 2, "user", "one two"),
    (-5, 1, "user", "y"), (-20, 1, "user", "z z"), (-21, 1, "user", "q"), (None, 1, "user", "lost"), (None, None, None, None),
    (45, 0, "user", "a"), (47, 0, "user", "a"), (47, 0, "user", "a"), (58, 0, "user", "long " * 5000),
]


@pytest.mark.parametrize("columns,slice_rows", [(256, 8192), (2, 1), (1, 3)])
def test_odd_rows(spark, columns, slice_rows):
    assert got(spark, ODD, columns=columns, slice_rows=slice_rows) == brute(ODD)


def shared_conversations(seed, n, depth):
    """Few texts, so that many conversations share turns, are prefixes of others or equal."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(4 * n), n):
        for t in range(rng.randint(1, depth)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", " ".join(["w"] * rng.choice([1, 1, 2]))))
    return rows


@pytest.mark.parametrize("columns,slice_rows", [(256, 8192), (256, 7), (3, 5), (2, 64)])
def test_shared_prefixes(spark, columns, slice_rows):
    rows = shared_conversations(columns + slice_rows, 120, 9)
    assert got(spark, rows, columns=columns, slice_rows=slice_rows) == brute(rows)


def test_a_third_of_all_are_one_conversation_over_and_over(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 400, 20) for t in range(4)]
    rows += [(c, t, "user", f"same {t}") for c in range(1, 60) for t in range(4)] + [(c, 0, "user", str(c)) for c in range(500, 560)]
    assert got(spark, rows, slice_rows=16) == brute(rows)


def test_one_long_conversation_and_its_copy(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (40, 60, 61) for t in range(37 if c < 61 else 30)] + [(7, 0, "user", "hello")]
    assert got(spark, rows, columns=8) == brute(rows)


def test_empty_and_other_columns(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).collect() == []
    wide = spark.createDataFrame([(*r, 1, "k", 2) for r in ODD], schema + ", depth int, key string, n_convs int")
    assert sorted(map(tuple, prefix_trie.prefix_trie(wide).collect()), key=str) == brute(ODD)


def test_table(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, prefix_trie.prefix_trie(table).collect()), key=str) == brute(rows)
