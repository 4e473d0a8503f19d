"""Stored token order and compacted record files."""

import json
import random

import pytest

from corposcope.operators import ordering as O, token_store as TS, tokens as T
from corposcope.sources import records as R


@pytest.fixture(scope="module")
def tokens(spark):
    rng = random.Random(5)
    rows = [(i, [i * 10 + j for j in range(rng.randrange(7))]) for i in range(500)]
    return spark.createDataFrame(rows, "id long, input_ids array<int>").repartition(5)


@pytest.mark.parametrize("length,batch", [(8, 16), (5, 32)])
def test_packs_are_those_of_the_shuffled_rows(spark, tokens, length, batch):
    store = TS.store_tokens(tokens, "id", slab_rows=64, buckets=3, digits=1)
    got = TS.pack_stored(spark, store, length, batch_size=batch)
    want = T.pack_shuffled(tokens, "id", length, batch_size=batch, digits=1)
    rows = lambda df: sorted((r["batch"], r["chunk"], tuple(r["input_ids"])) for r in df.collect())
    assert rows(got) == rows(want)
    TS.drop_store(spark, store)


def test_split_and_bounds(spark, tokens):
    store = TS.store_tokens(tokens, "id", slab_rows=64, digits=1)
    want = {r["id"]: r["split"] for r in O.train_validation_split(tokens, "id", 0.07).collect()}
    assert {r["id"]: r["split"] for r in TS.split_stored(spark, store, 0.07).collect()} == want
    with pytest.raises(ValueError, match="whole number"):
        TS.pack_stored(spark, store, 8, batch_size=48)
    with pytest.raises(ValueError, match="fraction"):
        TS.split_stored(spark, store, 1.0)
    empty = TS.store_tokens(tokens.limit(0), "id")
    assert empty.rows == 0 and TS.pack_stored(spark, empty, 8).count() == 0


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(1500):
        folder = tmp_path / "in" / f"run-{i}"
        folder.mkdir(parents=True)
        (folder / "scores.json").write_text(json.dumps({"predict_f1": i / 7, f"m{i % 3}": i}))
    tasks = R.compact_results(spark, str(tmp_path / "in"), str(tmp_path / "out"), task_bytes=32 << 20)
    assert tasks == 3 and len([p for p in (tmp_path / "out").iterdir() if p.suffix == ".parquet"]) <= tasks
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("run", "metric", "value")) == rows(R.scan_results(spark, str(tmp_path / "in")))
