import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import crc

from corposcope.llm import toxicity


def area(scores, labels):
    """Share of pairs of a toxic and a clean document in which the toxic one scores higher."""
    toxic, clean = ([s for s, y in zip(scores, labels) if y == k] for k in (1, 0))
    return np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean])


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = toxicity.held_out()
    model = toxicity.fit(docs.where(~held), labels.where(~held))
    rows = toxicity.with_toxicity(docs.where(held).join(labels, "doc_id"), model).select("doc_id", "score", "predicted", "toxic").collect()
    assert len(rows) > 500 and all(crc(r.doc_id, 5) == 0 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert area([r.score for r in rows], [r.toxic for r in rows]) > 0.85
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(2)
    words = ["stone", "river", "cloud", "garden", "winter", "letter", "window", "bread"]
    texts, labels = [], []
    for i in range(300):
        text = list(rng.choice(words, 60))
        if i % 3 == 0:
            text[rng.integers(60)] = str(rng.choice(["horrible", "disgusting"]))
        texts.append(" ".join(text))
        labels.append(int(i % 3 == 0))
    return toxicity.train(texts, labels)


def test_unseen_misspellings_share_ngrams(small):
    bad, misspelt, clean = small.word_scores([toxicity.plain(w) for w in ("horrible", "horribble", "meadow")])
    assert bad > misspelt > clean + 1
    scores = small.score(pa.array(["bread " * 40 + "disgustinng " + "river " * 40, "bread river " * 40]))
    assert scores[0] > 0.5 > scores[1]


def test_odd_rows(odd, odd_rows, none, small):
    rows = toxicity.with_toxicity(odd, small).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.with_toxicity(none, small).collect() == []


def test_odd_labels(spark, odd, none):
    labels = spark.createDataFrame([(3, 1), (4, 1), (None, 0), (5, None), (99, 0), (3, 1)], "doc_id long, toxic int")
    for docs, known in ((odd, labels), (none, labels), (odd, labels.where("false"))):
        model = toxicity.fit(docs, known)
        assert 0 <= model.score(pa.array(["some text"]))[0] <= 1


def test_slices_do_not_change_scores(small):
    texts = pa.array(["a horrible day", None, "", "bread " * 100, "x"])
    alone = [small.score(texts.slice(i, 1))[0] for i in range(len(texts))]
    assert small.score(texts) == pytest.approx(alone)
