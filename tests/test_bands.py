"""Bands from a table, packing of all bands at once, and native word pieces, against small restatements."""

import random

import pytest
from pyspark.sql import functions as F

from corposcope.operators import bands as B, scoring as S, tokens as T
from corposcope.operators.word_pieces import tokenise_native

BANDS = "metric string, low double, high double, name string"


def held(spark, values, bands):
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, sjr double")
    rows = B.band_table_membership(docs, spark.createDataFrame(bands, BANDS)).collect()
    return sorted((r["id"], r["band"]) for r in rows)


def brute(values, bands):
    inside = lambda v, low, high: (low is None or low <= v) and (high is None or v <= high)
    return sorted(
        (i, f"{metric}_{name}") for i, v in enumerate(values) for metric, low, high, name in bands
        if metric == "none" or (v is not None and metric == "sjr" and inside(v, low, high))
    )


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_bands(spark, seed):
    rng = random.Random(seed)
    points = [rng.randrange(12) / 4 for _ in range(40)]
    bands = [("sjr", *sorted(rng.sample([i / 4 for i in range(14)], 2)), f"b{i}") for i in range(30)]
    bands += [("sjr", None, 1.0, "low"), ("sjr", 1.25, None, "high"), ("sjr", None, None, "any"), ("none", None, None, "all"), ("h-index", 1.0, 2.0, "other")]
    assert held(spark, points + [None, -5.0, 99.0], bands) == brute(points + [None, -5.0, 99.0], bands)


@pytest.mark.parametrize("seed", range(3))
def test_counts_per_row_need_no_pairs(spark, seed):
    rng = random.Random(seed)
    values = [rng.randrange(12) / 4 for _ in range(40)] + [None, -5.0, 99.0]
    bands = [("sjr", *sorted(rng.sample([i / 4 for i in range(14)], 2)), f"b{i}") for i in range(30)]
    bands += [("sjr", None, 1.0, "low"), ("sjr", 1.25, None, "high"), ("sjr", None, None, "any"), ("h-index", 1.0, 2.0, "other")]
    docs = spark.createDataFrame(list(enumerate(values)), "id long, sjr double")
    for table in (bands, [*bands, ("none", None, None, "all")], [("sjr", None, None, "any")], []):
        got = B.band_table_counts(docs, spark.createDataFrame(table, BANDS), "id").collect()
        pairs = brute(values, table)
        names = {i: [band for j, band in pairs if j == i] for i, _ in pairs}
        assert {r["id"]: (r["bands"], r["first"], r["last"]) for r in got} == {i: (len(n), min(n), max(n)) for i, n in names.items()}


def test_bands_meet_few_runs_of_cells(spark):
    """Nested bands cover half of all cells each; they are a few rows each all the same."""
    n = 200
    table = B.checked_bands(spark.createDataFrame([("sjr", float(i), float(2 * n - i), f"b{i}") for i in range(n)], BANDS))
    ends = B._ends(table)
    cells = 2 * len(ends["sjr"]) + 1
    rows = B.band_nodes(table, ends).collect()
    assert len(rows) <= n * 2 * cells.bit_length()
    covered = {}
    for r in rows:
        covered.setdefault(r["band"], []).extend(range(r["node"] << r["level"], (r["node"] + 1) << r["level"]))
    at = {v: 2 * i + 1 for i, v in enumerate(ends["sjr"])}
    assert {b: sorted(c) for b, c in covered.items()} == {f"sjr_b{i}": list(range(at[float(i)], at[float(2 * n - i)] + 1)) for i in range(n)}


def test_few_or_no_bands(spark):
    assert held(spark, [1.0], []) == []
    assert held(spark, [1.0, None], [("sjr", None, None, "any")]) == [(0, "sjr_any")]


@pytest.mark.parametrize("band", [("sjr", 2.0, 1.0, "down"), ("sjr", 1.0, 1.0, "point"), ("citations", 1.0, 2.0, "x")])
def test_wrong_bands_fail(spark, band):
    with pytest.raises(Exception, match="not a band"):
        held(spark, [1.0], [band])


def test_summary_counts_a_hot_value_and_empty_bands(spark):
    docs = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id") / 100).alias("sjr"))
    table = spark.createDataFrame([("sjr", 0.0, 0.5, "low"), ("sjr", 50.0, 60.0, "none"), ("none", None, None, "all")], BANDS)
    rows = {r["band"]: (r["documents"], r["tokens"], r["share"]) for r in B.band_table_summary(docs, table, F.lit(2)).collect()}
    low = 100 + sum(1 for i in range(300) if i % 3 and i <= 50)
    assert rows == {"sjr_low": (low, 2 * low, round(low / 300, 6)), "sjr_none": (0, 0, 0.0), "none_all": (300, 600, 1.0)}


@pytest.mark.parametrize("partitions", [1, 5])
def test_bands_are_packed_as_if_alone(spark, partitions):
    rng = random.Random(7)
    rows = [(i, rng.random(), [i * 100 + j for j in range(rng.randrange(6))]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, random double, input_ids array<int>").repartition(partitions)
    bands = [S.Band("none", None, None, "all"), S.Band("random", 0.0, 0.5, "50%"), S.Band("random", 0.3, 0.6, "mid"), S.Band("random", 2.0, 3.0, "none")]
    packed = T.pack_bands(df, "id", bands, 8, batch_size=16, digits=1).collect()
    for band in bands:
        alone = df if band.metric == "none" else S.select_band(df, band.metric, band.low, band.high)
        want = T.pack_shuffled(alone, "id", 8, batch_size=16, digits=1).collect()
        got = [(r["batch"], r["chunk"], r["input_ids"]) for r in packed if r["band"] == band.label]
        assert sorted(got) == sorted((r["batch"], r["chunk"], r["input_ids"]) for r in want)


PIECES = [*T.SPECIAL_PIECES, *"abcdefghijklmnopqrstuvwxyz.,!?é世界", *[f"##{c}" for c in "abcdefghijklmnopqrstuvwxyz"], "the", "cat", "##er", "##ing", "inter", "internet", "##net"]
TEXTS = [
    None, "", " \t\n", "the cat", "The CAT, interneting!", "internets interne", "[MASK] the[SEP]cat [unk]", "É école ÀÉÎ", "世界cat世 ẞ ﬁ", "no§such x¿y", "a\x00b c\x85d\u00a0e\u3000f",
    "ΑΣ ΟΔΟΣ İstanbul", "한국어 가", "🎉 a🎉b \u200b \ue000", "cat" * 300, "1 a1b ²", "a-b_c~d|e`f^g", "the " * 50,
]


def test_native_pieces_equal_those_of_the_helper(spark, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("\n".join(PIECES) + "\n")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)
    vocab = spark.createDataFrame([(p, i) for i, p in enumerate(PIECES)], "piece string, id int")
    for options in ({}, {"max_length": 6, "pad": True}):
        want = {r["id"]: tuple(map(tuple, (r[c] for c in T.PACK_FILLS))) for r in T.tokenise(df, str(path), **options).collect()}
        got = {r["id"]: tuple(map(tuple, (r[c] for c in T.PACK_FILLS))) for r in tokenise_native(df, vocab, "id", **options).collect()}
        assert got == want


def test_two_piece_files_of_one_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "the cat")], "id long, text string")
    found = []
    for folder, pieces in (("one", ["the", "cat"]), ("two", ["cat", "the"])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "vocab.txt").write_text("\n".join([*T.SPECIAL_PIECES, *pieces]))
        found.append(T.tokenise(df, str(tmp_path / folder / "vocab.txt")))
    assert [f.first()["input_ids"] for f in found] == [[2, 5, 6, 3], [2, 6, 5, 3]]


def test_piece_files_have_a_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "VOCABULARY_BYTES", 10)
    (tmp_path / "vocab.txt").write_text("\n".join(PIECES))
    with pytest.raises(ValueError, match="bytes"):
        T.tokenise(spark.createDataFrame([(1, "a")], "id long, text string"), str(tmp_path / "vocab.txt"))


@pytest.mark.parametrize("requested,model,length", [(None, 4096, 1024), (None, 512, 512), (64, 512, 64), (900, 512, 512)])
def test_sequence_length(requested, model, length):
    assert T.sequence_length(requested, model) == length
