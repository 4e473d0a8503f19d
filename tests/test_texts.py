"""Masked sentences, word pieces, labels and names against plain restatements."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corposcope.functions import arrays as AR, text as TX
from corposcope.functions.pieces import PieceIds, words_of
from corposcope.operators import labels as L, relations as R, results as RS, tokens as T
from corposcope.sources import records, tasks


def sentence_by_rule(text, spans, types, keep_last=False):
    """The masking rule character by character; ``spans`` are the two entities in argument order."""
    marks = [i for i, c in enumerate(text) if c in ".!?"]
    first = min(s for s, _ in spans)
    last = max(e for _, e in spans)
    begin = max((i + 1 for i in marks if 1 <= i <= first), default=0)
    end = min((i for i in marks if i >= last), default=len(text) - (0 if keep_last else 1))
    left, right = (0, 1) if spans[0][0] < spans[1][0] else (1, 0)
    pieces = [
        text[begin:spans[left][0]], f"@{types[left]}$", text[spans[left][1]:spans[right][0]],
        f"@{types[right]}$", text[spans[right][1]:end],
    ]
    return "".join(pieces)


def document(i, text, spans):
    entities = [(f"T{k}", f"TYPE{k}", [list(s)]) for k, s in enumerate(spans)]
    return (f"d{i}", [([text],)], entities, [("R", "rel", "T0", "T1")])


@pytest.mark.parametrize("keep_last", [False, True])
def test_masked_sentences(spark, keep_last):
    draw = random.Random(3)
    docs, expected = [], {}
    for i in range(400):
        text = "".join(draw.choice("ab .!?é𝒳 ") for _ in range(draw.randrange(4, 40)))
        spans = []
        for _ in range(2):
            start = draw.randrange(0, len(text) - 1)
            spans.append((start, draw.randrange(start + 1, len(text) + 1)))
        docs.append(document(i, text, spans))
        expected[f"d{i}_R"] = sentence_by_rule(text, spans, ["TYPE0", "TYPE1"], keep_last)
    df = spark.createDataFrame(docs, tasks.DOCUMENT_SCHEMA)
    got = {r["id"]: r["text"] for r in R.masked_sentences(df, keep_last=keep_last).collect()}
    assert got == expected


VOCAB = {p: i for i, p in enumerate(
    ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "un", "##aff", "##able", "aff", "cafe", ",", "a", "##b", "漢", "!", "[", "]"]
)}


def names(text):
    back = {i: p for p, i in VOCAB.items()}
    return [back[i] for i in PieceIds(VOCAB)(pa.array([text]))[0].as_py()]


@pytest.mark.parametrize("text, expected", [
    ("unaffable", ["un", "##aff", "##able"]),
    ("UNAFF, Café", ["un", "##aff", ",", "cafe"]),
    ("xyz a", ["[UNK]", "a"]),
    ("a[SEP]a", ["a", "[SEP]", "a"]),
    ("a漢a!", ["a", "漢", "a", "!"]),
    ("a" + "b" * 500, ["a"] + ["##b"] * 500),
    ("a\x1cb a\x0bb", ["a", "##b", "a", "##b"]),
    ("a\ue000b\u2028a", ["a", "##b", "a"]),
    ("a" + "b" * 99, ["a"] + ["##b"] * 99),
    ("  \n\t ", []),
    ("a\u0000b", ["a", "##b"]),
])
def test_pieces(text, expected):
    assert names(text) == expected


def test_words_of_marks():
    assert words_of("a$b^c") == ["a", "$", "b", "^", "c"]


def test_tokenise(spark, tmp_path):
    (tmp_path / "pieces.txt").write_text("\n".join(VOCAB) + "\n")
    vocab = str(tmp_path / "pieces.txt")
    df = spark.createDataFrame([(1, "unaffable a"), (2, ""), (3, None)], "id int, text string")
    rows = {r["id"]: r for r in T.tokenise(df, vocab, max_length=5, pad=True, drop=["text"]).collect()}
    assert rows[1]["input_ids"] == [2, 5, 6, 7, 3]
    assert rows[2]["input_ids"] == [2, 3, 0, 0, 0]
    assert rows[2]["attention_mask"] == [1, 1, 0, 0, 0] and rows[2]["special_tokens_mask"] == [1] * 5
    assert rows[3]["input_ids"] == [2, 3, 0, 0, 0]
    assert "text" not in rows[1].asDict()


def test_vocabulary_file(spark, tmp_path):
    (tmp_path / "vocab.txt").write_text("[PAD]\n[UNK]\nab\n##c\n")
    got = records.scan_vocabulary(spark, str(tmp_path / "vocab.txt")).orderBy("id").collect()
    assert [(r["piece"], r["id"]) for r in got] == [("[PAD]", 0), ("[UNK]", 1), ("ab", 2), ("##c", 3)]


@pytest.mark.parametrize("requested, model, expected", [(None, 512, 512), (None, 10**30, 1024), (128, 512, 128), (900, 512, 512)])
def test_sequence_length(requested, model, expected):
    assert T.sequence_length(requested, model) == expected


def test_masking_shares(spark):
    ids = [2] + [100] * 400 + [3]
    special = [1] + [0] * 400 + [1]
    df = spark.createDataFrame([(i, ids, special) for i in range(100)], "k int, input_ids array<int>, special_tokens_mask array<int>")
    rows = T.mask_tokens(df, F.col("k"), mask_id=4, vocab_size=1000).collect()
    picked = masked = kept = other = 0
    for r in rows:
        assert len(r["input_ids"]) == len(r["labels"]) == 402
        assert r["labels"][0] == r["labels"][-1] == -100 and r["input_ids"][0] == 2
        for token, label in zip(r["input_ids"], r["labels"]):
            if label == -100:
                assert token in (2, 3, 100)
                continue
            assert label == 100
            picked += 1
            masked += token == 4
            kept += token == 100
            other += token not in (4, 100)
    assert picked / 40_000 == pytest.approx(0.15, abs=0.01)
    assert masked / picked == pytest.approx(0.8, abs=0.02)
    assert other / picked == pytest.approx(0.1, abs=0.02)
    assert kept / picked == pytest.approx(0.1, abs=0.02)


def test_aligned_labels(spark):
    df = spark.createDataFrame(
        [([None, 0, 0, 1, 2, 2, None], [3, 0, 1]), ([0, 1, 1], [2, 2]), ([], [])], "w array<int>, l array<int>"
    )
    inside = F.array(F.lit(1), F.lit(1), F.lit(2), F.lit(4), F.lit(4))
    first = [r[0] for r in df.select(AR.aligned_labels(F.col("w"), F.col("l"))).collect()]
    every = [r[0] for r in df.select(AR.aligned_labels(F.col("w"), F.col("l"), inside)).collect()]
    assert first == [[-100, 3, -100, 0, 1, -100, -100], [2, 2, -100], []]
    assert every == [[-100, 3, 4, 0, 1, 1, -100], [2, 2, 2], []]


def test_logits(spark):
    df = spark.createDataFrame([([0.5, 2.0, 2.0, 0.0],), ([-1.0, -1.0, -3.0, -2.0],)], "x array<double>")
    got = df.select(AR.argmax(F.col("x")), AR.active_labels(AR.positive_flags(F.col("x")), list("abcd"))).collect()
    assert [tuple(r) for r in got] == [(1, ["a", "b", "c"]), (0, [])]


def test_labels(spark):
    df = spark.createDataFrame(
        [("train", "yes"), ("train", "-1"), ("test", "maybe"), ("validation", "no")], "split string, label string"
    )
    vocabulary = L.labels_of_splits(df, "label", check=True)
    assert [tuple(r) for r in vocabulary.orderBy("label_id").collect()] == [("maybe", 0), ("no", 1), ("yes", 2)]
    encoded = {r["label"]: r["label_id"] for r in L.encode_label(df, "label", vocabulary).collect()}
    assert encoded == {"yes": 2, "-1": -1, "maybe": 0, "no": 1}
    assert [r[0] for r in L.labels_missing_from(df, "label", "test").collect()] == ["maybe"]
    with pytest.raises(ValueError):
        L.labels_of_splits(df.where("label = 'yes'"), "label", check=True)


def test_inside_ids(spark):
    labels = spark.createDataFrame([("B-X",), ("I-X",), ("B-Y",), ("O",)], "label string")
    got = {r["label"]: (r["label_id"], r["inside_id"]) for r in L.inside_ids(L.label_vocabulary(labels)).collect()}
    assert got == {"B-X": (0, 2), "B-Y": (1, 1), "I-X": (2, 2), "O": (3, 3)}


def test_sequence_columns(spark):
    first = spark.sql("select array('a') words, array(1) tags")
    named = spark.sql("select 1 id, array('a') tokens, array(1) ner_tags")
    assert L.sequence_columns(first, "ner") == ("words", "tags")
    assert L.sequence_columns(named, "ner") == ("tokens", "ner_tags")
    assert L.sequence_columns(named, "ner", label="id") == ("tokens", "id")


def test_join_text_keeps_nulls_visible(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "q string, c string")
    got = [r[0] for r in df.select(TX.join_text(F.col("q"), F.col("c"), delimiter="[SEP]")).collect()]
    assert got == ["a[SEP]b", None]


@pytest.mark.parametrize("run, expected", [
    ("h-index_top25%_bc5chem_seed3", ("h-index-top25%", "bc5chem", 3)),
    ("bert-base-uncased_blurb-ncbi_disease_seed0", ("bert-base-uncased", "ncbi-disease", 0)),
    ("sjr_mid25%_ckpt-1200_hoc_seed4", ("sjr-mid25%", "hoc", 4)),
    ("none_all_ddi-corpus_seed9", ("none-all", "ddi-corpus", 9)),
])
def test_run_names(spark, run, expected):
    df = spark.createDataFrame([(run,)], "run string")
    row = RS.parse_run_names(df).first()
    assert (row["model"], row["corpus"], row["seed"]) == expected


def test_result_files(spark, tmp_path):
    for run, body in {
        "random_25%_hoc_seed1": '{\n  "predict_f1": 0.5,\n  "predict_overall_accuracy": 1\n}',
        "a+b_gad_seed0": '{"pearsonr": -0.25}',
    }.items():
        (tmp_path / run).mkdir()
        (tmp_path / run / "predict_results.json").write_text(body)
    wide = {r["run"]: r for r in records.scan_result_columns(spark, str(tmp_path), ["f1", "accuracy", "pearsonr"]).collect()}
    assert wide["random_25%_hoc_seed1"].asDict() == {
        "run": "random_25%_hoc_seed1", "f1": 0.5, "accuracy": 1.0, "pearsonr": None}
    assert wide["a+b_gad_seed0"]["pearsonr"] == -0.25


def test_averages_count_missing_corpora(spark):
    df = spark.createDataFrame([("m", "hoc", 40.0), ("m", "gad", 60.0), ("m", "biosses", 99.0)],
                               "model string, corpus string, performance double")
    assert RS.dataset_average(df).first()["dataset_average"] == pytest.approx(100 / 11)
    assert RS.task_average(df).first()["task_average"] == pytest.approx(40 / 4 + 60 / 12)


def test_best_two_ties_go_by_name(spark):
    df = spark.createDataFrame([("b", "hoc", 1.0), ("a", "hoc", 1.0), ("c", "hoc", 0.5)],
                               "model string, corpus string, performance double")
    assert [(r["model"], r["place"]) for r in RS.best_two(df).orderBy("place").collect()] == [("a", 1), ("b", 2)]


def test_band_file(spark, tmp_path):
    (tmp_path / "bands.json").write_text('{"none":[["null","null","all"]],"sjr":[[1.312,100.0,"top25%"]]}')
    got = sorted(map(tuple, records.scan_bands(spark, str(tmp_path / "bands.json")).collect()))
    assert got == [("none", None, None, "all"), ("sjr", 1.312, 100.0, "top25%")]


def test_percentile_file(spark, tmp_path):
    (tmp_path / "stats.json").write_text('{"sjr_percentiles":{"12.5%":0.5,"25%":1.0},"token_nb":3}')
    got = sorted(map(tuple, records.scan_percentiles(spark, str(tmp_path / "stats.json")).collect()))
    assert got == [("sjr", 12.5, 0.5), ("sjr", 25.0, 1.0)]


def test_unknown_task(spark, tmp_path):
    with pytest.raises(ValueError):
        tasks.scan_tasks(spark, str(tmp_path), "poetry")


@pytest.mark.parametrize("shuffled", [False, True])
def test_word_ids_of_slices(spark, shuffled):
    """A frequent word, one that the vocabulary lacks, empty words, no text; more slices than rows."""
    texts = ["a b a  A", "z", None, "", "b " * 500, *[f"a w{i % 7} {i}" for i in range(40)]]
    ids = {"a": 7, "b": 8, "": 9, **{f"w{i}": 20 + i for i in range(7)}}
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    vocab = spark.createDataFrame(list(ids.items()), "word string, word_id long")
    want = {i: [ids[w] for w in t.lower().split(" ") if w in ids] for i, t in enumerate(texts) if t is not None}
    got = {r["id"]: r["ids"] for r in T.word_ids(df, vocab, "id", shuffled=shuffled).collect()}
    assert got == {i: found for i, found in want.items() if found}
