"""The physical plans: no cross products, no unpartitioned work on rows, pruned and pushed scans."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
# Row-sized work: each of these reads the documents.
CORPUS = [
    "band_membership", "band_summary", "scored_articles", "nearest_year_metric", "journal_lookup_salted",
    "global_ordinal", "train_validation_split", "first_half", "word_token_ids", "tokenised", "packed_rows",
    "masked_tokens", "masked_sentences", "aligned_all_pieces", "entity_scores", "chunk_matches",
    "percentiles_random", "run_grid", "band_table_membership", "band_table_summary", "packed_rows_by_band", "tokenised_native",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORPUS)
def test_no_cross_products(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_scan_reads_only_what_it_needs(spark, folder):
    text = plan(QUERIES["global_ordinal"](spark, folder))
    assert "text" not in "".join(line for line in text.splitlines() if "ReadSchema" in line)


def test_valid_articles_are_filtered_at_the_scan(spark, folder):
    """The part of the filter that is about a stored column is pushed down, the rest needs no exchange."""
    text = plan(QUERIES["valid_articles"](spark, folder))
    assert "PushedFilters: [IsNotNull(source)]" in text and "Exchange" not in text


def test_scored_articles_do_not_shuffle_for_the_join(spark, folder):
    """Only the journal side is exchanged; the articles stay where they are read."""
    text = plan(QUERIES["scored_articles"](spark, folder))
    assert "SortMergeJoin" not in text and "REPARTITION" not in text
    articles = text.split("BroadcastExchange")[0]
    assert "Exchange" not in articles.replace("BroadcastHashJoin", "")


def test_summary_sends_one_row_per_task(spark, folder):
    text = plan(QUERIES["band_summary"](spark, folder))
    articles = text.split("BroadcastExchange")[0]
    assert "partial_count" in articles and "Generate" not in articles.split("partial_count", 1)[1]


def test_token_counts_combine_before_the_shuffle(spark, folder):
    assert "partial_sum" in plan(QUERIES["entity_scores"](spark, folder))


def test_all_bands_share_one_exchange_of_the_arrays(spark, folder):
    """Before bands multiply the rows the arrays move once, by bucket; after it only batches across buckets do."""
    text = plan(QUERIES["packed_rows_by_band"](spark, folder))
    inside, across = text.split("Union")[1].split("Generate explode(sequence")[1:3]
    assert "hashpartitioning(_bucket" in inside and not any("band" in line for line in inside.splitlines() if "Exchange hash" in line)
    assert sum("band" in line for line in across.splitlines() if "Exchange hash" in line) == 1


def test_native_pieces_need_no_python(spark, folder):
    text = plan(QUERIES["tokenised_native"](spark, folder))
    assert "Arrow" not in text and "Python" not in text and "Arrow" in plan(QUERIES["tokenised"](spark, folder))


@pytest.mark.parametrize("name", ["word_token_ids_salted", "tokenised_native"])
def test_places_of_words_do_not_move(spark, folder, name):
    """They meet the words of their slice where they are split, and are gathered there."""
    text = plan(QUERIES[name](spark, folder))
    assert "posexplode" in text and "Exchange" not in text.split("Generate posexplode")[0]


def test_packs_from_a_store_move_nothing(spark, folder):
    text = plan(QUERIES["packed_from_store"](spark, folder))
    assert text.count("Bucketed: true") == 2 and "Exchange" not in text
    assert "Exchange" not in plan(QUERIES["split_from_store"](spark, folder))
