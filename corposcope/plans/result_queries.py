"""Queries over run results: files, names, averages, tables, training logs, configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import metric_name
from ..operators import results as R, scoring as S
from ..session import new_path
from ..sources import records as RS
from . import jobs
from .registry import ctes, query
from .tables import (
    RECORDS, REPORTED_MODELS, RUNS, SCORED_ALL, run_records, run_results, scored, table,
)

# The tables show two digits; here more are kept, so that no value lies halfway between two roundings.
DIGITS = 8

# --- files ------------------------------------------------------------------

_LONG = """
long AS (
  SELECT run, 'predict_accuracy' AS metric, accuracy AS value FROM records WHERE accuracy IS NOT NULL
  UNION ALL SELECT run, 'predict_f1', f1 FROM records WHERE f1 IS NOT NULL
  UNION ALL SELECT run, 'predict_overall_recall', recall FROM records WHERE recall IS NOT NULL
  UNION ALL SELECT run, 'predict_pearsonr', pearsonr FROM records WHERE pearsonr IS NOT NULL)
"""


def _write_results(spark: SparkSession, folder: str) -> str:
    path = new_path(spark, "results")
    RS.write_metrics(run_records(spark, folder).repartition("run"), path)
    return path


@query("result_files", ctes(RECORDS, _LONG) + "SELECT run, metric, value FROM long")
def result_files(spark, folder):
    """One JSON record per run, the run named by its folder."""
    return RS.scan_results(spark, _write_results(spark, folder))


@query("result_files_compacted", ctes(RECORDS, _LONG) + "SELECT run, metric, value FROM long")
def result_files_compacted(spark, folder):
    """The same from one table that the many small files were packed into."""
    path = new_path(spark, "compacted")
    RS.compact_results(spark, _write_results(spark, folder), path)
    return spark.read.schema("run string, metric string, value double").parquet(path)


@query("result_columns", ctes(RECORDS) + "SELECT run, accuracy, f1, recall, pearsonr FROM records")
def result_columns(spark, folder):
    """Ragged records as one table, missing metrics null."""
    return RS.scan_result_columns(
        spark, _write_results(spark, folder), ["accuracy", "f1", "recall", "pearsonr"]
    )


@query("ragged_union", ctes(RECORDS) + """
    SELECT run, accuracy, NULL::DOUBLE AS pearsonr FROM records WHERE pearsonr IS NULL
    UNION ALL SELECT run, NULL, pearsonr FROM records WHERE pearsonr IS NOT NULL""")
def ragged_union(spark, folder):
    rows = run_records(spark, folder)
    classes = rows.where("predict_pearsonr is null").select("run", F.col("predict_accuracy").alias("accuracy"))
    pairs = rows.where("predict_pearsonr is not null").select("run", F.col("predict_pearsonr").alias("pearsonr"))
    return classes.unionByName(pairs, allowMissingColumns=True)


@query("metric_names", ctes(RECORDS, _LONG) + """
    SELECT run, replace(replace(metric, 'predict_', ''), 'overall_', '') AS metric, value FROM long""")
def metric_names(spark, folder):
    records = run_records(spark, folder)
    long = records.unpivot(["run"], [c for c in records.columns if c != "run"], "metric", "value")
    return long.where("value is not null").withColumn("metric", metric_name(F.col("metric")))


def training_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as log rows of five runs; one kind of row has only a final loss, one has none."""
    step = F.col("event_id").cast("int")
    return table(spark, folder, "events").select(
        F.col("event_type").alias("run"), step.alias("step"),
        F.when((F.col("user_id") % 7 != 0) & (F.col("user_id") % 11 != 0), F.col("value")).alias("loss"),
        F.when(F.col("user_id") % 11 == 0, F.col("value") * 2).alias("train_loss"),
    )


_LOG = """
log AS (
  SELECT event_type AS run, CAST(event_id AS INTEGER) AS step,
    CASE WHEN user_id % 7 <> 0 AND user_id % 11 <> 0 THEN value END AS loss,
    CASE WHEN user_id % 11 = 0 THEN value * 2 END AS train_loss FROM events)
"""


@query("training_logs", ctes(_LOG) + "SELECT run, step, loss, train_loss FROM log")
def training_logs(spark, folder):
    """Log files with a nested history, several per run, written and read back."""
    path = new_path(spark, "logs")
    log = training_log(spark, folder)
    entry = F.struct("step", (F.col("step") / 1000).alias("epoch"), "loss", "train_loss")
    files = log.groupBy("run", F.expr("step div 5000").alias("part")).agg(
        F.collect_list(entry).alias("log_history")
    )
    files.select("run", "log_history").write.partitionBy("run").option("maxRecordsPerFile", 1).json(path)
    return RS.scan_training_logs(spark, path)


@query("loss_curve", ctes(_LOG) + """
    SELECT run, step, coalesce(loss, train_loss) AS loss FROM log
    WHERE loss IS NOT NULL OR train_loss IS NOT NULL ORDER BY run, step""")
def loss_curve(spark, folder):
    return R.loss_curve(training_log(spark, folder)).orderBy("run", "step")


@query("steps_without_loss", ctes(_LOG) + "SELECT run, step FROM log WHERE loss IS NULL AND train_loss IS NULL")
def steps_without_loss(spark, folder):
    return R.steps_without_loss(training_log(spark, folder))


# --- names ------------------------------------------------------------------


@query("run_names", ctes(RECORDS, RUNS) + "SELECT run, model, corpus, seed FROM parsed")
def run_names(spark, folder):
    """Checkpoint numbers, prefixes and underscores cleaned, then model, corpus and seed."""
    names = run_records(spark, folder).select("run")
    with_checkpoint = names.withColumn(
        "raw", F.regexp_replace("run", "_seed", "_ckpt-20_seed")
    )
    return R.parse_run_names(with_checkpoint, "raw").select("run", "model", "corpus", "seed")


@query("reported_runs", ctes(RECORDS, RUNS) + "SELECT model, corpus, seed, accuracy, f1, pearsonr FROM runs")
def reported_runs(spark, folder):
    """Debug runs and the excluded model left out, sorted, a column subset."""
    rows = run_results(spark, folder).orderBy("model", "corpus", "seed")
    return rows.select("model", "corpus", "seed", *R.METRICS)


@query("display_names", ctes(RECORDS, RUNS) + """
    SELECT DISTINCT corpus, CASE corpus WHEN 'pubmed-qa' THEN 'PubMed QA' WHEN 'bioasq-task-b' THEN 'BioASQ'
      WHEN 'ddi-corpus' THEN 'DDI' WHEN 'ncbi-disease' THEN 'NCBI-disease' WHEN 'chemprot' THEN 'ChemProt'
      WHEN 'bc5chem' THEN 'BC5-chem' WHEN 'bc5disease' THEN 'BC5-disease' WHEN 'hoc' THEN 'HoC'
      ELSE upper(corpus) END AS heading FROM runs""")
def display_names(spark, folder):
    corpora = run_results(spark, folder).select("corpus").distinct()
    return corpora.withColumn("heading", R.display_name(F.col("corpus")))


# --- averages ---------------------------------------------------------------


@query("mean_and_std", ctes(RECORDS, RUNS) + """
    SELECT model, corpus, round(avg(accuracy) * 100, 8) AS accuracy_mean, round(stddev_pop(accuracy) * 100, 8) AS accuracy_std,
      round(avg(f1) * 100, 8) AS f1_mean, round(stddev_pop(f1) * 100, 8) AS f1_std,
      round(avg(pearsonr) * 100, 8) AS pearsonr_mean, round(stddev_pop(pearsonr) * 100, 8) AS pearsonr_std
    FROM runs GROUP BY model, corpus""")
def mean_and_std(spark, folder):
    return R.mean_and_std(run_results(spark, folder), digits=DIGITS)


_HEADLINE = """
headline AS (
  SELECT model, corpus, avg(v) * 100 AS performance, stddev_pop(v) * 100 AS spread FROM (
    SELECT model, corpus, CASE WHEN corpus IN ('pubmed-qa', 'bioasq-task-b') THEN accuracy
      WHEN corpus = 'biosses' THEN pearsonr ELSE f1 END AS v FROM runs)
  GROUP BY model, corpus)
"""
_REPORTED = ", ".join(f"'{c}'" for c in R.reported_corpora())


def _headline(spark: SparkSession, folder: str) -> DataFrame:
    return R.headline_scores(run_results(spark, folder))


@query("headline_scores", ctes(RECORDS, RUNS, _HEADLINE) + """
    SELECT model, corpus, round(performance, 6) AS performance, round(spread, 6) AS spread FROM headline""")
def headline_scores(spark, folder):
    """The metric of each corpus, mean and spread per model."""
    rows = _headline(spark, folder)
    return rows.withColumns({c: F.round(c, 6) for c in ("performance", "spread")})


@query("task_of_corpus", ctes(RECORDS, RUNS) + """
    SELECT DISTINCT corpus, CASE WHEN corpus IN ('bc5chem', 'bc5disease', 'bc2gm', 'jnlpba', 'ncbi-disease') THEN 'ner'
      WHEN corpus = 'hoc' THEN 'document_classification' WHEN corpus IN ('chemprot', 'ddi-corpus', 'gad') THEN 'relation_extraction'
      WHEN corpus IN ('bioasq-task-b', 'pubmed-qa') THEN 'qa' END AS task FROM runs""")
def task_of_corpus(spark, folder):
    corpora = run_results(spark, folder).select("corpus").distinct()
    return corpora.withColumn("task", R.task_of(F.col("corpus")))


@query("dataset_average", ctes(RECORDS, RUNS, _HEADLINE) + f"""
    SELECT model, round(sum(performance) / 11, 6) AS dataset_average FROM headline WHERE corpus IN ({_REPORTED}) GROUP BY model""")
def dataset_average(spark, folder):
    return R.dataset_average(_headline(spark, folder)).withColumn("dataset_average", F.round("dataset_average", 6))


@query("task_average", ctes(RECORDS, RUNS, _HEADLINE) + f"""
    SELECT model, round(sum(performance / (4 * CASE WHEN corpus = 'hoc' THEN 1 WHEN corpus IN ('chemprot', 'ddi-corpus', 'gad') THEN 3
      WHEN corpus IN ('bioasq-task-b', 'pubmed-qa') THEN 2 ELSE 5 END)), 6) AS task_average
    FROM headline WHERE corpus IN ({_REPORTED}) GROUP BY model""")
def task_average(spark, folder):
    return R.task_average(_headline(spark, folder)).withColumn("task_average", F.round("task_average", 6))


# --- tables -----------------------------------------------------------------

_WIDE_COLUMNS = ", ".join(
    f"coalesce(CAST(round(max(CASE WHEN corpus = '{c}' THEN performance END), 8) AS VARCHAR), '') AS \"{c}\""
    for c in R.reported_corpora()
)


@query("score_table", ctes(RECORDS, RUNS, _HEADLINE) + f"""
    SELECT model, {_WIDE_COLUMNS} FROM headline WHERE corpus IN ({_REPORTED}) GROUP BY model""")
def score_table(spark, folder):
    """Models by corpora in task order."""
    return R.pivot_scores(_headline(spark, folder), DIGITS)


_TURNED_COLUMNS = ", ".join(
    f"max(CASE WHEN model = '{m}' THEN round(performance, 8) END) AS \"{m}\"" for m in REPORTED_MODELS
)


@query("score_table_turned", ctes(RECORDS, RUNS, _HEADLINE) + f"""
    SELECT corpus, {_TURNED_COLUMNS} FROM headline WHERE corpus IN ({_REPORTED}) GROUP BY corpus""")
def score_table_turned(spark, folder):
    """Corpora by models."""
    wide = _headline(spark, folder).where(F.col("corpus").isin(R.reported_corpora()))
    table = wide.groupBy("model").pivot("corpus", R.reported_corpora()).agg(F.round(F.first("performance"), DIGITS))
    return R.transpose(table, "model", REPORTED_MODELS)


@query("score_report", ctes(RECORDS, RUNS, _HEADLINE) + f"""
    SELECT model, {_WIDE_COLUMNS}, round(sum(performance) / 11, 8) AS dataset_average,
      round(sum(performance / (4 * CASE WHEN corpus = 'hoc' THEN 1 WHEN corpus IN ('chemprot', 'ddi-corpus', 'gad') THEN 3
        WHEN corpus IN ('bioasq-task-b', 'pubmed-qa') THEN 2 ELSE 5 END)), 8) AS task_average
    FROM headline WHERE corpus IN ({_REPORTED}) GROUP BY model""")
def score_report(spark, folder):
    """Raw records to the table of models by corpora with both averages."""
    records = run_records(spark, folder)
    plain = records.withColumnsRenamed({c: c.replace("predict_", "").replace("overall_", "") for c in records.columns})
    return jobs.score_report(plain, DIGITS)


@query("best_two_models", ctes(RECORDS, RUNS, _HEADLINE) + """
    SELECT corpus, model, round(performance, 6) AS performance, CAST(place AS INTEGER) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY performance DESC, model) AS place FROM headline)
    WHERE place <= 2""")
def best_two_models(spark, folder):
    rows = R.best_two(_headline(spark, folder))
    return rows.select("corpus", "model", F.round("performance", 6).alias("performance"), "place")


@query("model_columns", ctes(RECORDS, RUNS) + """
    SELECT DISTINCT model, CASE WHEN contains(model, 'bert') THEN 'base' ELSE regexp_extract(model, '^(h-index|random|sjr)', 1) END AS family,
      CASE WHEN contains(model, 'bert') THEN '' ELSE regexp_extract(model, '(mid|top)', 1) END AS criterion,
      CASE WHEN contains(model, 'bert') THEN '0%' ELSE right(model, 3) END AS remaining,
      CAST(CASE WHEN contains(model, 'bert') THEN 1 WHEN contains(model, 'random') THEN 3 WHEN contains(model, 'h-index') THEN 4 ELSE 5 END AS BIGINT) AS place
    FROM runs""")
def model_columns(spark, folder):
    """Models by metric family, then criterion, in the order of the final table."""
    models = run_results(spark, folder).select("model").distinct()
    return R.model_columns(models).orderBy("place", "criterion", "remaining")


# --- grid -------------------------------------------------------------------

_GRID = f"""
grid AS (
  SELECT m.model || '_' || c.corpus || '_seed' || s.seed AS run, m.model, c.corpus, s.seed
  FROM (SELECT DISTINCT model FROM runs) m,
    (SELECT unnest({list(R.METRIC_OF_CORPUS)!r}) AS corpus) c, (SELECT unnest(range(6)) AS seed) s)
"""


def _grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every reported model on every corpus with six seeds."""
    models = run_results(spark, folder).select("model").distinct()
    return R.run_grid(models, list(R.METRIC_OF_CORPUS), 6)


@query("run_grid", ctes(RECORDS, RUNS, _GRID) + "SELECT run, model, corpus, CAST(seed AS INTEGER) AS seed FROM grid")
def run_grid(spark, folder):
    return _grid(spark, folder)


@query("missing_runs", ctes(RECORDS, RUNS, _GRID) + """
    SELECT run, model, corpus, CAST(seed AS INTEGER) AS seed FROM grid
    WHERE run NOT IN (SELECT model || '_' || corpus || '_seed' || seed FROM runs)""")
def missing_runs(spark, folder):
    name = F.format_string("%s_%s_seed%d", "model", "corpus", "seed")
    return R.missing_runs(_grid(spark, folder), run_results(spark, folder).select(name.alias("run")))


# --- configuration ----------------------------------------------------------


def measured_bands(spark: SparkSession, folder: str) -> DataFrame:
    """A band file made from the corpus: for each metric its quartiles, open for the whole corpus."""
    metrics = ["sjr", "h_index"]
    rows = scored(spark, folder)
    parts = []
    for m in metrics:
        top = rows.agg(F.round(F.max(m).cast("double"), 4).alias("hi"), F.round(F.min(m).cast("double"), 4).alias("lo"))
        parts.append(top.select(F.lit(m).alias("metric"), F.array(
            F.array(F.col("lo").cast("string"), F.col("hi").cast("string"), F.lit("span%")),
            F.array(F.lit("null"), F.lit("null"), F.lit("all")),
        ).alias("bands")))
    both = parts[0].unionByName(parts[1])
    return both.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("metric", "bands")))).alias("value"))


_SPAN = ctes(*SCORED_ALL) + """,
    span AS (
      SELECT 'sjr' AS metric, round(min(sjr)::DOUBLE, 4) AS low, round(max(sjr)::DOUBLE, 4) AS high, 'span%' AS name FROM scored
      UNION ALL SELECT 'sjr', NULL, NULL, 'all'
      UNION ALL SELECT 'h_index', min(h_index)::DOUBLE, max(h_index)::DOUBLE, 'span%' FROM scored
      UNION ALL SELECT 'h_index', NULL, NULL, 'all')"""


@query("band_configuration", _SPAN + " SELECT metric, low, high, name FROM span")
def band_configuration(spark, folder):
    """A nested band file, written from the corpus and scanned."""
    path = new_path(spark, "bands")
    measured_bands(spark, folder).write.text(path)
    return RS.scan_bands(spark, path)


@query("band_names", ctes(*SCORED_ALL, """
    named AS (
      SELECT band, split_part(band, '_', 1) AS metric, split_part(band, '_', 2) AS name FROM (
        SELECT DISTINCT b.band FROM scored s JOIN (VALUES ('none_all', 'none', NULL::DOUBLE, NULL::DOUBLE),
          ('random_50%', 'random', 0.0, 0.5), ('random_25%', 'random', 0.0, 0.25), ('h-index_top50%', 'h-index', 103, 1400),
          ('h-index_mid50%', 'h-index', 53, 190), ('h-index_top25%', 'h-index', 190, 1400), ('h-index_mid25%', 'h-index', 77, 142),
          ('sjr_top25%', 'sjr', 1.312, 100), ('sjr_mid25%', 'sjr', 0.462, 0.984), ('sjr_top50%', 'sjr', 0.759, 100)) b(band, metric, low, high)
        ON b.metric = 'none' OR CASE b.metric WHEN 'sjr' THEN s.sjr WHEN 'h-index' THEN s.h_index ELSE s.random END BETWEEN b.low AND b.high))
""") + """
    SELECT metric, CASE WHEN contains(name, '%') THEN left(name, length(name) - 3) ELSE '' END AS criteria,
      CASE WHEN contains(name, '%') THEN right(name, 3) ELSE '100%' END AS remaining FROM named""")
def band_names(spark, folder):
    """Criterion and remaining share from the names of the bands that hold documents."""
    bands = S.band_membership(scored(spark, folder)).select("band").distinct()
    parts = F.split("band", "_")
    return R.band_names(bands.select(F.get(parts, F.lit(0)).alias("metric"), F.get(parts, F.lit(1)).alias("name")))


@query("percentile_configuration", ctes(*SCORED_ALL) + f"""
    SELECT 'h-index' AS metric, unnest({S.PERCENT_STEPS!r}::DOUBLE[]) AS pct,
      round(unnest(quantile_cont(h_index::DOUBLE, {[p / 100 for p in S.PERCENT_STEPS]!r}::DOUBLE[])), 4) AS value FROM scored""")
def percentile_configuration(spark, folder):
    """A statistics file with a percentile map, written from the corpus and scanned."""
    path = new_path(spark, "percentiles")
    rows = S.exact_percentiles(scored(spark, folder), "h_index")
    entry = F.struct(F.concat(F.col("pct").cast("string"), F.lit("%")), F.round("value", 4))
    table = rows.agg(F.map_from_entries(F.collect_list(entry)).alias("h-index_percentiles"))
    table.select(F.to_json(F.struct("h-index_percentiles", F.lit(1).alias("abstract_nb"))).alias("value")).write.text(path)
    return RS.scan_percentiles(spark, path)
