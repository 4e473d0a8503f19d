"""Article files with odd records, journal lists, scoring and the intake."""

import gzip

import pytest
from pyspark.sql import functions as F

from corposcope.operators import cleaning, journals as J, scoring as S
from corposcope.plans import jobs
from corposcope.sources import articles as A, journals as JS
from corposcope.streaming.intake import start_intake

ODD = """<?xml version="1.0" encoding="utf-8"?>
<PubmedArticleSet>
<PubmedArticle><MedlineCitation Status="MEDLINE"><PMID Version="1"> 17 </PMID>
  <DateCompleted><Year>2001</Year><Month>02</Month><Day>30</Day></DateCompleted>
  <Article PubModel="Print"><Journal><ISSN IssnType="Print"> 1234-567X </ISSN><Title>J</Title></Journal>
  <ArticleTitle>A <i>big</i> title &amp; more</ArticleTitle>
  <Abstract><AbstractText Label="ONE">First <sup>2</sup> part.</AbstractText><AbstractText>Second.</AbstractText></Abstract>
  <Language>eng</Language><Language>fre</Language></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>x9</PMID><Article><Journal/><ArticleTitle/></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>18</PMID><DateCompleted><Year>soon</Year></DateCompleted>
  <Article><Journal><ISSN>1111-1111</ISSN></Journal><ArticleTitle>T</ArticleTitle>
  <Abstract><AbstractText>Plain.</AbstractText></Abstract><Language>eng</Language></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>
"""


def write(path, text):
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write(text)


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "odd0001.xml.gz", ODD)
    return folder


def test_odd_records(spark, source):
    scanned = A.scan_articles(spark, str(source)).drop(A.CORRUPT, "file")
    rows = {r["id"]: r for r in cleaning.with_defaults(scanned, markup="strip").collect()}
    assert set(rows) == {17, 0, 18}
    first = rows[17]
    assert (first["year"], first["month"], first["day"], first["issn"]) == (2001, 2, 30, "1234-567X")
    assert first["title"] == "A big title & more"
    assert first["abstract"] == "First 2 part." and first["language"] == "eng"
    assert (rows[0]["abstract"], rows[0]["issn"], rows[0]["title"], rows[0]["year"]) == ("", "", "", 0)
    assert rows[18]["year"] == 0
    joined = {r["id"]: r["abstract"] for r in cleaning.with_defaults(scanned, repeats="join", markup="strip").collect()}
    assert joined[17] == "First 2 part. Second."
    kept = {r["id"]: r["title"] for r in cleaning.with_defaults(scanned).collect()}
    assert kept[17].startswith("A <i>big</i> title")


def test_valid_articles(spark, source):
    rows = cleaning.with_defaults(A.scan_articles(spark, str(source)))
    assert sorted(r["id"] for r in cleaning.valid_articles(rows).collect()) == [17, 18]


def test_broken_file_is_set_aside(spark, source):
    write(source / "bad0002.xml.gz", ODD.replace("</PubmedArticleSet>", "<PubmedArticle><MedlineCitation><PMID>5"))
    good, broken = A.quarantine(A.scan_articles(spark, str(source)).cache())
    assert good.count() == 3
    assert [r["file"].split("/")[-1] for r in broken.collect()] == ["bad0002.xml.gz"]


def ranks(spark, *rows):
    return spark.createDataFrame(list(rows), "year int, rank int, issn string, sjr double, h_index int")


def test_journal_rules(spark):
    table = ranks(
        spark,
        (2000, 1, "a, b", 2.0, 10), (2000, 2, "b", 9.0, 99), (2000, 3, "-", 5.0, 5), (2000, 4, "c", None, 7),
        (2001, 1, "a", 3.0, 50), (2001, 2, "d", 1.0, None),
    )
    rows = J.rank_rows(table)
    sjr = {(r["issn"], r["year"]): r["sjr"] for r in J.sjr_by_year(rows).collect()}
    assert sjr == {("a", 2000): 2.0, ("b", 2000): 2.0, ("c", 2000): 0.0, ("a", 2001): 3.0, ("d", 2001): 1.0}
    h = {r["issn"]: r["h_index"] for r in J.h_index_by_issn(rows).collect()}
    assert h == {"a": 10, "b": 10, "c": 7}


def test_rank_files(spark, tmp_path):
    (tmp_path / "ranks1999.csv").write_text('Rank;Title;Issn;SJR;H index\n1;"J; one";"12, 34";1,25;40\n2;K;-;;3\n')
    got = JS.scan_journal_ranks(spark, str(tmp_path)).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(1999, 1, "12, 34", 1.25, 40), (1999, 2, "-", None, 3)]


@pytest.mark.parametrize(
    "year, expected", [(2000, 0.5), (2001, 0.5), (2002, 0.7), (1980, 0.5), (2030, 0.9), (0, 0.5), (2003, 0.7), (2005, 0.9)]
)
def test_nearest_year(spark, year, expected):
    """Exact hits, ties to the earlier year, clamping on both sides, the missing year."""
    df = spark.sql(
        f"select array(struct(2000 as year, 0.5D as sjr), struct(2002 as year, 0.7D as sjr), struct(2005 as year, 0.9D as sjr)) m, {year} y"
    )
    assert df.select(S.nearest_year_metric(F.col("m"), F.col("y"))).first()[0] == expected


def scored(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, sjr double, h_index int, random double")


def test_bands_include_both_ends(spark):
    df = scored(spark, (1, 0.462, 103, 0.5), (2, 0.984, 190, 0.25), (3, 1.312, 1400, 0.0), (4, 0.1, 5, 0.9))
    held = {}
    for r in S.band_membership(df).collect():
        held.setdefault(r["id"], set()).add(r["band"])
    assert held[1] == {"none_all", "random_50%", "h-index_top50%", "h-index_mid50%", "h-index_mid25%", "sjr_mid25%"}
    assert {"h-index_mid50%", "h-index_top25%", "h-index_top50%", "random_25%"} <= held[2]
    assert held[4] == {"none_all"}
    summary = {r["band"]: r for r in S.band_summary(df, F.lit(3)).collect()}
    assert summary["none_all"]["documents"] == 4 and summary["none_all"]["share"] == 1.0
    assert summary["sjr_top25%"]["tokens"] == 3 and summary["sjr_top50%"]["documents"] == 2


@pytest.mark.parametrize("metric, low, high", [("size", 0, 1), ("sjr", 1, 1), ("sjr", 2, 1), ("sjr", None, 1)])
def test_band_arguments(spark, metric, low, high):
    with pytest.raises(ValueError):
        S.select_band(scored(spark, (1, 0.0, 1, 0.0)), metric, low, high)


def test_empty_corpus_summary(spark):
    rows = S.band_summary(scored(spark, (1, 0.0, 1, 0.0)).limit(0), F.lit(1)).collect()
    assert len(rows) == 10 and all(r["documents"] == 0 for r in rows)


def test_published_budget(spark):
    figures = spark.createDataFrame([(15888466068,)], "tokens long")
    assert tuple(S.training_budget(figures).first()) == (128, 4194304, 3598)


def test_exact_percentiles_with_a_heavy_value(spark):
    values = sorted([0.0] * 400 + [i / 7 for i in range(600)])
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    got = {r["pct"]: r["value"] for r in S.exact_percentiles(df, "v").collect()}
    for pct in S.PERCENT_STEPS:
        at = pct / 100 * (len(values) - 1)
        low = values[int(at)]
        high = values[min(int(at) + 1, len(values) - 1)]
        assert got[pct] == pytest.approx(low + (at - int(at)) * (high - low))


def test_files_to_shards(spark, source, tmp_path):
    ranks_dir = tmp_path / "ranks"
    ranks_dir.mkdir()
    (ranks_dir / "r2000.csv").write_text('Rank;Title;Issn;SJR;H index\n1;J;1234567X;1,25;40\n')
    broken = jobs.score_files(spark, str(source), str(ranks_dir), str(tmp_path / "out"))
    assert broken.count() == 0
    rows = {r["id"]: r for r in A.read_scored(spark, str(tmp_path / "out")).collect()}
    assert rows[17]["h_index"] == 40 and rows[17]["sjr"] == 1.25 and rows[17]["shard"] == "odd0001"
    assert rows[18]["h_index"] == 0 and rows[18]["sjr"] == 0.0
    assert rows[18]["text"] == "T\nPlain."


def test_reader_shards_layout(spark, tmp_path):
    A.write_reader_shards(spark.range(20_000), str(tmp_path / "out"), 64, key="id")
    table = spark.read.parquet(str(tmp_path / "out"))
    per_file = [r["count"] for r in table.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert len(per_file) == 64 and sum(per_file) == 20_000
    assert max(per_file) < 2 * min(per_file)


def test_intake_takes_each_file_once(spark, source, tmp_path):
    profiles = spark.sql("select '1234567X' issn, 40 h_index, array(struct(2000 as year, 1.25D as sjr)) metrics")
    target, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        start_intake(spark, str(source), profiles, target, state).awaitTermination()
        rows = spark.read.schema(f"{A.SCORED_SCHEMA}, shard string").json(f"{target}/scored")
        return sorted(r["id"] for r in rows.collect())

    assert run() == [17, 18]
    assert run() == [17, 18]
    write(source / "more0002.xml.gz", ODD.replace(">18<", ">19<").replace(" 17 ", "20"))
    write(source / "bad0003.xml.gz", "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>5")
    assert run() == [17, 18, 19, 20]
    assert spark.read.schema("file string").json(f"{target}/quarantine").count() == 1


def test_scored_shards_to_training_rows(spark, tmp_path):
    rows = [(i, f"word{i % 7} other text {i}", i % 300, (i % 20) / 10, i / 200, "s1") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, h_index int, sjr double, random double, shard string")
    A.write_scored(df, str(tmp_path / "scored"))
    pieces = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "word", "other", "text", *"0123456789", *[f"##{d}" for d in range(10)]]
    vocab = tmp_path / "vocab.txt"
    vocab.write_text("\n".join(pieces) + "\n")
    jobs.prepare_training(
        spark, str(tmp_path / "scored"), str(vocab), str(tmp_path / "rows"), length=16,
        band=S.Band("sjr", 0.759, 100.0, "top50%"), fraction=0.1, mask_id=4, vocab_size=len(pieces),
    )
    validation = A.read_splits(spark, str(tmp_path / "rows"), "validation")
    both = A.read_splits(spark, str(tmp_path / "rows"))
    assert {len(r["input_ids"]) for r in both.collect()} == {16}
    starts = both.groupBy("split").agg(F.sum(F.size(F.filter("input_ids", lambda t: t == 2))).alias("n"))
    counts = {r["split"]: r["n"] for r in starts.collect()}
    # Twenty documents are held out; of the others those inside the band remain.
    assert validation.count() > 0 and 15 <= counts["validation"] <= 25 and 80 <= counts["train"] <= 140
