"""Positions, splits, packing and joins: exact, complete and independent of partitioning."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corposcope.operators import ordering as O, tokens as T
from corposcope.operators.lookup import lookup_join


def expected_order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(3000).withColumnRenamed("id", "k").repartition(7)


@pytest.mark.parametrize("digits", [1, 2, None])
@pytest.mark.parametrize("partitions", ["3", "17"])
def test_ordinal(spark, ids, digits, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["ordinal"]: r["k"] for r in O.with_ordinal(ids, "k", digits=digits).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [got[i] for i in range(3000)] == expected_order(range(3000))


def test_shuffle_order(ids):
    assert [r["k"] for r in O.seeded_shuffle(ids, "k").collect()] == expected_order(range(3000))


@pytest.mark.parametrize("fraction, held", [(0.01, 30), (0.5, 1500), (0.9999, 3000), (0.0001, 1)])
def test_split_is_the_tail(ids, fraction, held):
    got = {r["k"]: r["split"] for r in O.train_validation_split(ids, "k", fraction).collect()}
    order = expected_order(range(3000))
    assert len(got) == 3000
    assert {k for k, s in got.items() if s == "validation"} == set(order[3000 - held:])


@pytest.mark.parametrize("fraction", [0, 1, -0.1, 1.5])
def test_split_fraction_is_checked(ids, fraction):
    with pytest.raises(ValueError):
        O.train_validation_split(ids, "k", fraction)


@pytest.mark.parametrize("n", [0, 1, 777, 3000, 5000])
def test_first_rows_are_in_order(ids, n):
    assert [r["k"] for r in O.first_rows(ids, n, "k").collect()] == expected_order(range(3000))[:n]


@pytest.mark.parametrize("digits", [1, 2, 3, 5])
def test_positions_do_not_depend_on_the_number_of_buckets(ids, digits):
    got = {r["ordinal"]: r["k"] for r in O.with_ordinal(ids, "k", digits=digits).collect()}
    assert [got[i] for i in range(3000)] == expected_order(range(3000))


def test_files_are_ordered_by_number_beyond_five_digits(spark, tmp_path, monkeypatch):
    """Names of one more digit come after, though they sort before as text."""
    monkeypatch.setattr(O, "new_path", lambda *_: str(tmp_path / "sorted"))
    df = spark.range(60).repartition(3)
    O.sorted_table(df, F.asc("id"))
    for path in sorted((tmp_path / "sorted").glob("part-*")):
        number = int(path.name.split("-")[1])
        path.rename(path.with_name(path.name.replace(f"part-{number:05d}", f"part-{99_999 + number}", 1)))
    for path in (tmp_path / "sorted").glob(".part-*"):
        path.unlink()
    table = spark.read.parquet(str(tmp_path / "sorted")).select(
        "id", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long").alias("part"), F.col("_metadata.row_index").alias("i")
    )
    assert [r["id"] for r in table.orderBy("part", "i").collect()] == list(range(60))


def test_sorted_ordinal_with_one_heavy_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), "id")
    got = [(r["v"], r["id"]) for r in O.with_sorted_ordinal(df, F.asc("v"), F.asc("id")).orderBy("ordinal").collect()]
    assert got == sorted(got) and len(got) == 5000


def test_both_ways_to_join_agree_with_a_hot_key(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    side = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = sorted(map(str, lookup_join(df, side, "k", how).collect()))
        shuffled = lookup_join(df, side, "k", how, shuffled=True)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        assert plain == sorted(map(str, shuffled.collect())), how


def packed_by_hand(arrays, length, batch, pad=0):
    rows = []
    for b in range(0, len(arrays), batch):
        flat = [x for a in arrays[b:b + batch] for x in a]
        for chunk, at in enumerate(range(0, len(flat), length)):
            part = flat[at:at + length]
            rows.append((b // batch, chunk, part + [pad] * (length - len(part))))
    return rows


@pytest.mark.parametrize("length, batch, digits", [(8, 16, 1), (5, 7, 2), (64, 1024, 1), (3, 1, 1), (16, 100, 1)])
def test_pack(spark, length, batch, digits):
    """Empty arrays, arrays longer than a row, short last batches, batches inside and across buckets."""
    data = {k: list(range(k, k + (k * 7) % 23)) for k in range(900)}
    df = spark.createDataFrame(list(data.items()), "k long, input_ids array<int>").repartition(5)
    got = T.pack_shuffled(df, "k", length, batch_size=batch, digits=digits).collect()
    rows = sorted((r["batch"], r["chunk"], r["input_ids"]) for r in got)
    assert rows == packed_by_hand([data[k] for k in expected_order(data)], length, batch)


def test_pack_masks(spark):
    df = spark.createDataFrame([(0, [5, 6, 7])], "ordinal long, p array<int>")
    wrapped = T.with_masks(df, "p", cls=2, sep=3)
    row = T.pack(wrapped, 8).first()
    assert row["input_ids"] == [2, 5, 6, 7, 3, 0, 0, 0]
    assert row["attention_mask"] == [1] * 5 + [0] * 3
    assert row["special_tokens_mask"] == [1, 0, 0, 0, 1, 1, 1, 1]
    assert row["token_type_ids"] == [0] * 8


def test_exact_multiple_needs_no_padding(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, []), (2, [3, 4])], "ordinal long, input_ids array<int>")
    assert [r["input_ids"] for r in T.pack(df, 2).orderBy("chunk").collect()] == [[1, 2], [3, 4]]
