import itertools

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import crc

from corposcope.llm import language


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents.where(~language.held_out()))


def test_held_out_accuracy(documents, model):
    rows = [r for r in language.with_language(documents, model).collect() if crc(r.doc_id, 4) == 2]
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_words_of_a_switching_text_are_labelled(documents, model):
    texts = {r.lang: r.text.split()[:15] for r in documents.orderBy("doc_id").collect() if r.lang in ("de", "es") and len(r.text.split()) > 40}
    words = [language.bare(w) for w in texts["de"] + texts["es"]]
    truth = [lang for lang in ("de", "es") for w in texts[lang] if language.bare(w)]
    words = [w for w in words if w]
    distinct = sorted(set(words))
    codes = np.array([distinct.index(w) for w in words])
    chances = model.marginals(distinct, codes, np.array([0, len(codes)]))
    found = [model.languages[k] for k in chances.argmax(axis=1)]
    assert np.mean([a == b for a, b in zip(found, truth)]) > 0.9


def test_marginals_are_those_of_all_paths(model):
    """Forward-backward against the sum over every labelling, texts of several lengths at once."""
    words = ["der", "the", "und", "los", "xyz"]
    texts = [[0, 1, 2], [4], [3, 3], [1, 0, 2, 4]]
    ends = np.cumsum([0] + [len(t) for t in texts])
    got = model.marginals(words, np.array(sum(texts, [])), ends)
    scores, step, width = model.emissions(words), model.transitions, len(model.languages)
    for i, text in enumerate(texts):
        sums = np.zeros((len(text), width))
        for path in itertools.product(range(width), repeat=len(text)):
            total = sum(scores[w, k] for w, k in zip(text, path)) + sum(step[a, b] for a, b in zip(path, path[1:]))
            for t, k in enumerate(path):
                sums[t, k] += np.exp(total)
        assert got[ends[i] : ends[i + 1]] == pytest.approx(sums / sums.sum(axis=1, keepdims=True), abs=1e-4)


def test_chain_marginals_count_transitions():
    rng = np.random.default_rng(0)
    scores, step = rng.normal(size=(2, 3, 2)), rng.normal(size=(2, 2))
    want_pairs, want = np.zeros((2, 2)), np.zeros((2, 3, 2))
    for b in range(2):
        paths = list(itertools.product(range(2), repeat=3))
        weights = np.array([np.exp(sum(scores[b, t, k] for t, k in enumerate(p)) + step[p[0], p[1]] + step[p[1], p[2]]) for p in paths])
        for p, w in zip(paths, weights / weights.sum()):
            for t, k in enumerate(p):
                want[b, t, k] += w
            want_pairs[p[0], p[1]] += w
            want_pairs[p[1], p[2]] += w
    got, pairs = language._chain_marginals(scores, step)
    assert got == pytest.approx(want) and pairs == pytest.approx(want_pairs)


def test_odd_rows(odd, odd_rows, none, model):
    got = language.with_language(odd, model)
    rows = got.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (r.score > 0) == letters
    assert language.with_language(none, model).collect() == []
    assert language.keep_identified(odd).columns == odd.columns
    assert language.keep_identified(none).collect() == []


def test_one_language_and_none():
    alone = language.train([("en", "only one language here")])
    assert language._labels(pa.array(["words", None]), alone)[0] == ["en", "und"]
    assert language._labels(pa.array(["words"]), language.train([]))[0] == ["und"]


def test_slices_do_not_change_scores(documents, model):
    texts = pa.array([r.text for r in documents.limit(60).collect()])
    together = language._labels(texts, model)[1]
    alone = np.concatenate([language._labels(texts.slice(i, 1), model)[1] for i in range(len(texts))])
    assert together == pytest.approx(alone, abs=1e-5)


FOREIGN = [
    "Это обычный русский текст о том как люди живут и работают в большом городе каждый день вместе с друзьями",
    "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava",
    "xqjz vkw pqx zzgk wvjq kxzz qqpv jkwx zvq xkj gqzx wwvk pzqj xvk qzjw kkvx zpqg jxwv qvzk wxjz",
    "これは 日本語 の 文章 です 東京 で 働く 人々 に ついて 書かれて います",
]


def test_texts_in_no_known_language_go(spark, documents):
    """Languages that were not learned and gibberish; the chances alone, which add up to 1, keep them all."""
    ids = range(10**6, 10**6 + len(FOREIGN))
    foreign = spark.createDataFrame([(i, t, None, "a", 0) for i, t in zip(ids, FOREIGN)], documents.schema)
    kept = {r.doc_id for r in language.keep_identified(documents.unionByName(foreign)).collect()}
    assert not kept & set(ids)
    assert kept == {r.doc_id for r in documents.collect() if any(c.isalpha() for c in r.text or "")}


def test_strange_words_restated(documents, model):
    """A word is strange if no lexicon has it and its runs of three characters are rare in every language."""
    words = ["und", "xqjz", "thereing", "ночь"]
    runs = {w: [f"^{w}$"[i : i + 3] for i in range(len(w))] for w in words}
    for w, odd in zip(words, model.strange(words)):
        scores = [language.spelling_scores([w], model.spelling)[0, k] for k in range(len(model.languages))]
        alone = [np.mean([language.spelled_grams([w])[0].size and model.spelling[c, k] for c in language.spelled_grams([w])[0]]) for k in range(len(model.languages))]
        assert scores == pytest.approx(alone, rel=1e-5) and len(language.spelled_grams([w])[0]) == len(runs[w])
        z = max((s - m) / d for s, m, d in zip(scores, *model.usual))
        assert odd == (z < language.STRANGE_WORD and model.membership([w])[0, -1] == 1)
    assert model.strange(words).tolist() == [False, True, False, True]


@pytest.mark.parametrize("text", ["½", "² ²", "Ⅷ", "①②", "12½ ¾", "٣", "_ -", "5₂"])
def test_numerals_are_no_letters(text, model):
    assert language._labels(pa.array([text]), model)[0] == ["und"]
