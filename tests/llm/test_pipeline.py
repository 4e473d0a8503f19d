from collections import Counter

import corpus_pipeline
import pytest
from llm_helpers import ascii_lower
from test_simhash import component_ids, fingerprint

from corposcope.llm import language, mixing, packing


@pytest.fixture(scope="module")
def results(spark, documents, folder):
    """What each stage returns, from the stage before."""
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        out[name] = docs
    return out


def test_stages(results, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_copies", "near_copies", "mix", "pack"]
    assert all(d.columns == documents.columns for n, d in results.items() if n != "pack")


def test_language_stage_keeps_documents_of_known_languages(results, documents):
    assert results["language_id"].count() == documents.count()


def test_copies(results):
    kept = {}
    for r in results["language_id"].collect():
        text = ascii_lower(r.text)
        kept[text] = max(kept.get(text, -1), r.doc_id)
    exact = results["exact_copies"].collect()
    assert sorted(r.doc_id for r in exact) == sorted(kept.values())
    near = component_ids([(r.doc_id, fingerprint(r.text)) for r in exact])
    assert sorted(r.doc_id for r in results["near_copies"].collect()) == sorted({c for _, _, c in near})


def test_mix_and_pack(results):
    mixed = mixing.mix_sources(mixing.with_sizes(results["near_copies"])).collect()
    want = Counter({r.doc_id: r.copies for r in mixed if r.copies})
    assert Counter(r.doc_id for r in results["mix"].collect()) == want
    packed = results["pack"].collect()
    assert Counter({r.doc_id: r.doc_tokens * want[r.doc_id] for r in packed}) == sum((Counter({r.doc_id: r.length}) for r in packed), Counter())


def test_run_and_odd_tables(spark, odd, none, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == [f.split()[0] for f in packing._DDL.split(", ")]
    assert language.UNKNOWN == "und"
