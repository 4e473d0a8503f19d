"""How the standard tables play the parts of articles, journals, tags and runs.

Each DataFrame here has a SQL twin used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.journals import journal_profiles, rank_rows
from ..operators.scoring import score_articles
from ..session import durable


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- articles ---------------------------------------------------------------


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as cleaned articles: the first line is the title, the rest the abstract."""
    text = F.col("text")
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(F.contains(text, F.lit("\n")), F.expr("substring(text, instr(text, '\n') + 1)"))
        .otherwise("").alias("abstract"),
        F.replace("source", F.lit("src"), F.lit("src-")).alias("issn"),
        F.when(F.col("lang") == "en", "eng").otherwise(F.col("lang")).alias("language"),
        F.when(F.col("doc_id") % 50 == 0, 0).otherwise(1993 + F.col("doc_id") % 10).cast("int").alias("year"),
    )


ARTICLES = """
articles AS (
  SELECT doc_id AS id,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract,
    replace(source, 'src', 'src-') AS issn,
    CASE WHEN lang = 'en' THEN 'eng' ELSE lang END AS language,
    CASE WHEN doc_id % 50 = 0 THEN 0 ELSE 1993 + doc_id % 10 END AS year
  FROM documents)
"""

VALID = """
valid AS (
  SELECT id, title, abstract, replace(issn, '-', '') AS issn, language, year FROM articles
  WHERE abstract <> '' AND issn <> '' AND language = 'eng')
"""


# --- journals ---------------------------------------------------------------


def journal_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as yearly rank lists ``(year, rank, issn, sjr, h_index)``.

    Two calendar years make one list, filed under the odd one, so that an
    article's year can lie halfway between two lists. A journal is listed once per order status, so an ISSN
    repeats within a year; journals 6 to 11 share a cell with a second ISSN,
    journal 12 has none, and journal 5 has no score.
    """
    orders = table(spark, folder, "orders").select(
        (F.year("o_orderdate") - 1 + F.year("o_orderdate") % 2).alias("year"),
        (F.col("o_custkey") % 13).alias("j"),
        F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )
    lists = orders.groupBy("year", "j", "status").agg(
        F.sum("cents").alias("cents"), F.count("*").alias("n")
    )
    second = F.concat(F.lit(", src"), (F.col("j") + 6).cast("string"))
    cell = F.when(F.col("j") == 12, "-").when(
        F.col("j") >= 6, F.concat(F.lit("src"), F.col("j").cast("string"), second)
    ).otherwise(F.concat(F.lit("src"), F.col("j").cast("string")))
    score = F.round(F.col("cents") * (1 + F.col("j") % 6) / (F.col("n") * 100_000_000.0), 4)
    return lists.select(
        F.col("year"),
        (F.col("j") * 3 + F.expr("locate(status, 'FOP')")).cast("int").alias("rank"),
        cell.alias("issn"),
        F.when(F.col("j") != 5, score).alias("sjr"),
        (F.col("cents") % 400).cast("int").alias("h_index"),
    )


RANKS = """
lists AS (
  SELECT year(o_orderdate) - 1 + year(o_orderdate) % 2 AS year, o_custkey % 13 AS j, o_orderstatus AS status,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n
  FROM orders GROUP BY ALL),
ranks AS (
  SELECT year, CAST(j * 3 + strpos('FOP', status) AS INTEGER) AS rank,
    CASE WHEN j = 12 THEN '-' WHEN j >= 6 THEN 'src' || j || ', src' || (j + 6) ELSE 'src' || j END AS issn,
    CASE WHEN j <> 5 THEN round(CAST(cents * (1 + j % 6) AS DOUBLE) / (CAST(n AS DOUBLE) * 100000000), 4) END AS sjr,
    CAST(cents % 400 AS INTEGER) AS h_index
  FROM lists)
"""

JOURNALS = """
rank_rows AS (
  SELECT year, rank, unnest(string_split(issn, ', ')) AS issn, coalesce(sjr, 0) AS sjr, h_index
  FROM ranks WHERE issn <> '-'),
listed AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY issn, year ORDER BY rank) AS rn FROM rank_rows) WHERE rn = 1),
journals AS (SELECT issn, arg_min(h_index, year) AS h_index FROM listed GROUP BY issn)
"""


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    return journal_profiles(rank_rows(journal_ranks(spark, folder)))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return score_articles(articles(spark, folder), profiles(spark, folder))


# The nearest year by an inequality-free window over (article, year) pairs.
NEAREST = """
nearest AS (
  SELECT id, sjr FROM (
    SELECT v.id, l.sjr,
      row_number() OVER (PARTITION BY v.id ORDER BY abs(l.year - v.year), l.year) AS rn
    FROM valid v JOIN listed l ON l.issn = v.issn) WHERE rn = 1)
"""

SCORED = """
scored AS (
  SELECT v.id, v.title || chr(10) || v.abstract AS text,
    coalesce(j.h_index, 0) AS h_index, coalesce(n.sjr, 0) AS sjr,
    CAST(('0x' || substr(md5(v.id || '|0'), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS random
  FROM valid v LEFT JOIN journals j ON j.issn = v.issn LEFT JOIN nearest n ON n.id = v.id)
"""

SCORED_ALL = (ARTICLES, VALID, RANKS, JOURNALS, NEAREST, SCORED)


# --- order and words --------------------------------------------------------

# Position of every document after a seeded shuffle.
ORDERED = """
ordered AS (
  SELECT doc_id, md5(doc_id || '|42') AS key,
    row_number() OVER (ORDER BY md5(doc_id || '|42'), doc_id) - 1 AS ordinal, count(*) OVER () AS total
  FROM documents)
"""

WORDS = """
placed AS (
  SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word,
    generate_subscripts(string_split(lower(text), ' '), 1) - 1 AS pos
  FROM documents)
"""

VOCABULARY = """
vocabulary AS (
  SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) + 4 AS INTEGER) AS word_id
  FROM (SELECT word, count(*) AS n FROM placed GROUP BY word))
"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


# --- tags -------------------------------------------------------------------

TAGS = ["B-A", "B-B", "I-A", "I-B", "O"]


def tag_at(i: Column, shift: Column) -> Column:
    """A tag from the position of a word: runs of A and B entities between outside words."""
    cycle = ["B-A", "I-A", "I-A", "O", "B-B", "I-B", "B-A", "O", "O", "I-B", "O"]
    # One look into the cycle: a chain of cases works out the position for each of them.
    tag = F.get(F.array(*map(F.lit, cycle)), ((i + shift) % len(cycle)).cast("int"))
    return F.coalesce(tag, F.lit("O"))


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, ref, pred``: a tag per word of each document, the prediction
    moved by one word at every fifth position."""
    size = F.size(F.split("text", " "))
    places = F.sequence(F.lit(0), size - 1)
    doc = F.col("doc_id")
    late = lambda i: F.when((i + doc) % 5 == 0, 1).otherwise(0)
    return documents(spark, folder).select(
        "doc_id",
        F.transform(places, lambda i: tag_at(i, doc)).alias("ref"),
        F.transform(places, lambda i: tag_at(i + late(i), doc)).alias("pred"),
    )


def _sql_tag(position: str) -> str:
    return (
        f"CASE WHEN ({position}) % 11 IN (0, 6) THEN 'B-A' WHEN ({position}) % 11 IN (1, 2) THEN 'I-A' "
        f"WHEN ({position}) % 11 = 4 THEN 'B-B' WHEN ({position}) % 11 IN (5, 9) THEN 'I-B' ELSE 'O' END"
    )


TAGGED = f"""
tagged AS (
  SELECT doc_id, i, {_sql_tag("i + doc_id")} AS ref,
    {_sql_tag("i + doc_id + CASE WHEN (i + doc_id) % 5 = 0 THEN 1 ELSE 0 END")} AS pred
  FROM (SELECT doc_id, unnest(range(len(string_split(text, ' ')))) AS i FROM documents))
"""


# --- runs -------------------------------------------------------------------

# Names of corpora and models that run folders carry.
CORPORA = [
    "blurb-bc5chem", "blurb-bc5disease", "blurb-bc2gm", "blurb-jnlpba", "blurb-ncbi_disease",
    "hoc", "chemprot", "ddi-corpus", "gad", "bioasq-task-b", "pubmed-qa", "biosses",
]
MODELS = {
    "view": "bert-base-uncased", "click": "random_50%", "signup": "h-index_top25%",
    "purchase": "sjr_mid25%", "error": "none_all",
}
REPORTED_MODELS = ["bert-base-uncased", "h-index-top25%", "random-50%", "sjr-mid25%"]


def run_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw metric records ``run, predict_accuracy, predict_f1,
    predict_overall_recall, predict_pearsonr``, one per run; a corpus only has its own metrics."""
    model = F.col("event_type")
    named = F.coalesce(*[F.when(model == k, v) for k, v in MODELS.items()])
    corpus = F.get(F.array(*[F.lit(c) for c in CORPORA]), (F.col("user_id") % 12).cast("int"))
    debug = F.when(F.col("user_id") % 37 == 0, "_debug").otherwise("")
    events = table(spark, folder, "events").select(
        F.concat(named, F.lit("_"), corpus, F.lit("_seed"), (F.col("event_id") % 5).cast("string"), debug).alias("run"),
        (F.col("user_id") % 12).alias("c"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )
    sums = events.groupBy("run", "c").agg(F.sum("cents").alias("s"), F.count("*").alias("n"))
    c, s = F.col("c"), F.col("s")
    return sums.select(
        "run",
        F.when(c < 11, (s * 7 % 10000) / 10000).alias("predict_accuracy"),
        F.when(c < 9, (s * 3 % 10000) / 10000).alias("predict_f1"),
        F.when(c < 5, (s % 10000) / 10000).alias("predict_overall_recall"),
        F.when(c == 11, (s % 20001 - 10000) / 10000).alias("predict_pearsonr"),
    )


def _sql_case(column: str, names: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


RECORDS = f"""
run_sums AS (
  SELECT {_sql_case("event_type", MODELS)} || '_' ||
      list_extract({CORPORA!r}, CAST(user_id % 12 AS INTEGER) + 1) || '_seed' || (event_id % 5) ||
      CASE WHEN user_id % 37 = 0 THEN '_debug' ELSE '' END AS run,
    user_id % 12 AS c, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS s
  FROM events GROUP BY ALL),
records AS (
  SELECT run,
    CASE WHEN c < 11 THEN CAST(s * 7 % 10000 AS DOUBLE) / 10000 END AS accuracy,
    CASE WHEN c < 9 THEN CAST(s * 3 % 10000 AS DOUBLE) / 10000 END AS f1,
    CASE WHEN c < 5 THEN CAST(s % 10000 AS DOUBLE) / 10000 END AS recall,
    CASE WHEN c = 11 THEN CAST(s % 20001 - 10000 AS DOUBLE) / 10000 END AS pearsonr
  FROM run_sums)
"""

# Run names taken apart with string functions only.
RUNS = """
renamed AS (
  SELECT *, CASE WHEN contains(short, 'bert-base') THEN short
    ELSE substr(short, 1, strpos(short, '_') - 1) || '-' || substr(short, strpos(short, '_') + 1) END AS name
  FROM (SELECT *, replace(replace(run, 'ncbi_disease', 'ncbi-disease'), 'blurb-', '') AS short FROM records)),
parsed AS (
  SELECT run, split_part(name, '_', 1) AS model, split_part(name, '_', 2) AS corpus,
    CAST(replace(split_part(name, '_', 3), 'seed', '') AS INTEGER) AS seed, accuracy, f1, recall, pearsonr
  FROM renamed),
runs AS (SELECT * FROM parsed WHERE NOT contains(run, 'debug') AND model <> 'none-all')
"""


def run_results(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed and reported runs with one column per metric."""
    from ..operators.results import parse_run_names, reported_runs

    # Written once: otherwise the name filters would run on the events below the aggregate.
    records = durable(run_records(spark, folder))
    plain = records.withColumnsRenamed(
        {c: c.replace("predict_", "").replace("overall_", "") for c in records.columns}
    )
    return reported_runs(parse_run_names(plain))
