"""Entity chunks against a plain restatement of the rules, on random tag sequences."""

import random

import pytest

from corposcope.operators import chunks as C


def lenient(tags):
    """Chunks of an IOB or IOBES sequence, by walking over it."""
    found, begin = [], None
    padded = list(tags) + ["O"]
    before = "O"
    for i, tag in enumerate(padded):
        same = before[1:] == tag[1:]
        goes_on = before[0] not in "OES" and tag[0] not in "OBS" and same
        if not goes_on and begin is not None:
            found.append((begin, i - 1, padded[begin][2:]))
            begin = None
        if not goes_on and tag != "O":
            begin = i
        before = tag
    return found


def strict_iob2(tags):
    found, i = [], 0
    while i < len(tags):
        if tags[i][0] == "B":
            j = i + 1
            while j < len(tags) and tags[j] == "I" + tags[i][1:]:
                j += 1
            found.append((i, j - 1, tags[i][2:]))
            i = j
        else:
            i += 1
    return found


def strict_iobes(tags):
    found, i = [], 0
    while i < len(tags):
        kind = tags[i][2:]
        if tags[i][0] == "S":
            found.append((i, i, kind))
        elif tags[i][0] == "B":
            j = i + 1
            while j < len(tags) and tags[j] == "I-" + kind:
                j += 1
            if j < len(tags) and tags[j] == "E-" + kind:
                found.append((i, j, kind))
                i = j
        i += 1
    return found


def sequences(prefixes, n=300, seed=1):
    draw = random.Random(seed)
    tags = ["O"] + [f"{p}-{t}" for p in prefixes for t in ("X", "Y-Z")]
    return [[draw.choice(tags) for _ in range(draw.randrange(0, 12))] for _ in range(n)]


def chunks_of(spark, seqs, **options):
    df = spark.createDataFrame(list(enumerate(seqs)), "id int, tags array<string>")
    got = {r["id"]: r["c"] for r in C.with_chunks(df, "tags", "c", **options).collect()}
    return [[(int(a), int(b), t) for a, b, t in (c.split("|") for c in got[i])] for i in range(len(seqs))]


@pytest.mark.parametrize("prefixes", ["BI", "BIES"])
def test_lenient(spark, prefixes):
    seqs = sequences(prefixes)
    assert chunks_of(spark, seqs) == [lenient(s) for s in seqs]


def test_strict_iob2(spark):
    seqs = sequences("BI")
    assert chunks_of(spark, seqs, scheme="IOB2", strict=True) == [strict_iob2(s) for s in seqs]


def test_strict_iobes_and_bilou(spark):
    seqs = sequences("BIES")
    expected = [strict_iobes(s) for s in seqs]
    assert chunks_of(spark, seqs, scheme="IOBES", strict=True) == expected
    renamed = [[t.replace("E-", "L-").replace("S-", "U-") for t in s] for s in seqs]
    assert chunks_of(spark, renamed, scheme="BILOU", strict=True) == expected


@pytest.mark.parametrize(
    "scheme, tags, expected",
    [
        ("IOB1", "I-X I-X B-X O I-Y", [(0, 1, "X"), (2, 2, "X"), (4, 4, "Y")]),
        ("IOB1", "O B-X I-X", []),
        ("IOE1", "I-X E-X I-X O", [(0, 1, "X"), (2, 2, "X")]),
        ("IOE2", "I-X E-X E-X I-Y O", [(0, 1, "X"), (2, 2, "X")]),
        ("IOB2", "I-X B-X I-Y I-X", [(1, 1, "X")]),
    ],
)
def test_strict_schemes(spark, scheme, tags, expected):
    assert chunks_of(spark, [tags.split()], scheme=scheme, strict=True) == [expected]


def test_suffix(spark):
    assert chunks_of(spark, [["PER-B", "PER-I", "O", "A-B-I"]], suffix=True) == [[(0, 1, "PER"), (3, 3, "A-B")]]


def test_tags_without_type(spark):
    assert chunks_of(spark, [["B", "I", "O", "I"]]) == [[(0, 1, "_"), (3, 3, "_")]]


def scores(spark, pred, ref, **options):
    df = spark.createDataFrame([(p.split(), r.split()) for p, r in zip(pred, ref)], "p array<string>, r array<string>")
    return {r["type"]: r for r in C.entity_scores(df, "p", "r", **options).collect()}


def test_published_example(spark):
    got = scores(
        spark,
        ["O O B-MISC I-MISC I-MISC I-MISC O", "B-PER I-PER O"],
        ["O O O B-MISC I-MISC I-MISC O", "B-PER I-PER O"],
    )
    assert got["overall"]["f1"] == 0.5 and got["PER"]["f1"] == 1.0 and got["MISC"]["number"] == 1


def test_type_only_predicted(spark):
    pred, ref = ["B-X O", "B-Y"], ["O O", "B-Y"]
    assert scores(spark, pred, ref)["X"]["recall"] == 0.0
    assert scores(spark, pred, ref, zero_division=1)["X"]["recall"] == 1.0


def test_arguments(spark):
    for bad in ({"scheme": "IOB9"}, {"mode": "exact"}, {"zero_division": 2}):
        with pytest.raises(ValueError):
            scores(spark, ["O"], ["O"], **bad)


def test_chunks_are_found_once_for_the_overall_scores(spark, folder):
    """After the counts only the tag accuracy reads the documents."""
    from corposcope.plans import metric_queries

    text = metric_queries.entity_report_overall(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_tags_look_once_into_their_cycle(spark, folder):
    """The position in the cycle is worked out once a tag and side; the tags are those of the rule, below zero too."""
    from pyspark.sql import functions as F
    from corposcope.plans import tables

    text = tables.tagged(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("% 11") == 2
    rule = {0: "B-A", 6: "B-A", 1: "I-A", 2: "I-A", 4: "B-B", 5: "I-B", 9: "I-B"}
    rows = spark.range(-30, 30).select("id", tables.tag_at(F.col("id"), F.lit(0)).alias("tag")).collect()
    assert all(r["tag"] == (rule.get(r["id"] % 11, "O") if r["id"] >= 0 or r["id"] % 11 == 0 else "O") for r in rows)
