"""Cutting arrays into rows batch by batch, and masks that are moved by their ends."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corposcope.functions import rows as R
from corposcope.functions.arrays import part_of_slimmed, slimmed, whole_of_slimmed
from corposcope.operators import ordering as O, tokens as T

MASKS = [[], [1], [1, 1], [1, 0, 1], [1, 0, 0, 0, 1], [0] * 7, [1, 2, 3, 4, 5], [1, None, None, 1], [None, 0, 0], None]


@pytest.mark.parametrize("begin,take", [(0, 2), (1, 2), (2, 1), (0, 1)])
def test_slim_masks_come_back(spark, begin, take):
    df = spark.createDataFrame(list(enumerate(MASKS)), "i int, m array<int>")
    size = F.size("m")
    part = part_of_slimmed(F.col("s"), size, F.lit(begin), F.lit(take))
    slim = df.withColumn("s", slimmed(F.col("m"), size)).withColumn("size", size)
    got = {r["i"]: r for r in slim.select("i", "s", whole_of_slimmed(F.col("s"), size).alias("w"), F.when(size >= begin + take, part).alias("p")).collect()}
    for i, mask in enumerate(MASKS):
        assert got[i]["w"] == mask
        if mask is not None and len(mask) >= begin + take:
            assert got[i]["p"] == mask[begin : begin + take]
    assert [i for i in got if got[i]["s"]["full"] is not None] == [6, 7, 8]


@pytest.mark.parametrize("slice_tokens", [1, 40, 1 << 18])
def test_cutter_keeps_its_place_between_slices(monkeypatch, slice_tokens):
    monkeypatch.setattr(R, "SLICE_TOKENS", slice_tokens)
    rng = random.Random(3)
    kind = pa.list_(pa.int32())
    slim = pa.struct([("first", pa.int32()), ("mid", pa.int32()), ("last", pa.int32()), ("full", kind)])
    data, want = [], []
    for slab, size in ((2, 10), (5, 12), (6, 3)):
        arrays = [None if rng.random() < 0.1 else [rng.randrange(99) for _ in range(rng.choice([0, 1, 2, 9, 30]))] for _ in range(size)]
        masks = [[rng.randrange(9) for _ in a or []] if rng.random() < 0.2 else [1, *[0] * (len(a or []) - 2), 3][: len(a or [])] for a in arrays]
        even = lambda m: len(m) < 3 or len(set(m[1:-1])) == 1
        ends = [dict(first=m[0] if m else None, mid=m[1] if len(m) > 1 else None, last=m[-1] if m else None, full=None if even(m) else m) for m in masks]
        data += [dict(slab=slab, a=a, m=e) for a, e in zip(arrays, ends)]
        for b in range(0, size, 4):
            flat, flags = ([x for v in side[b : b + 4] for x in v or []] for side in (arrays, masks))
            for chunk, at in enumerate(range(0, len(flat), 8)):
                missing = max(at + 8 - len(flat), 0)
                want.append((slab * 3 + b // 4, chunk, flat[at : at + 8] + [7] * missing, flags[at : at + 8] + [9] * missing))
    schema = pa.schema([("slab", pa.int64()), ("a", kind), ("m", slim)])
    batches = [pa.RecordBatch.from_pylist(data[i : i + 7], schema) for i in range(0, len(data), 7)]
    cut = R.Cutter(["a", "m"], [7, 9], [pa.int32(), pa.int32()], 8, 4, 12)
    assert [tuple(r.values()) for b in cut(iter(batches)) for r in b.to_pylist()] == want


def test_slabs_are_runs_of_positions(spark):
    df = spark.range(500).withColumnRenamed("id", "k").repartition(7)
    places = {r["k"]: r["ordinal"] for r in O.with_ordinal(df, "k", digits=1).collect()}
    for digits in (1, 2):
        for slab in (1, 16, 64, 1000):
            assert {r["k"]: r["slab"] for r in O.with_slab(df, "k", slab, digits=digits).collect()} == {k: p // slab for k, p in places.items()}


def test_lengths_share_the_shuffle(spark):
    df = spark.createDataFrame([(k, list(range(k % 9))) for k in range(300)], "k long, input_ids array<int>")
    a, b = T.pack_lengths(df, "k", [4, 6], batch_size=8)
    assert sorted(a.collect()) == sorted(T.pack_shuffled(df, "k", 4, batch_size=8).collect())
    assert sorted(b.collect()) == sorted(T.pack_shuffled(df, "k", 6, batch_size=8).collect())
