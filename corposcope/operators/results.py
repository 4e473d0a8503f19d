"""Run names, result records and the tables made of them.

Raw records may be many; each table starts with an aggregate per model and
corpus, so everything after it is a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


# Metric columns of a result record.
METRICS = ["accuracy", "f1", "pearsonr"]

# The headline metric of each corpus.
METRIC_OF_CORPUS = {
    "bc5chem": "f1", "bc5disease": "f1", "jnlpba": "f1", "ncbi-disease": "f1", "bc2gm": "f1",
    "hoc": "f1", "ddi-corpus": "f1", "chemprot": "f1", "gad": "f1",
    "pubmed-qa": "accuracy", "bioasq-task-b": "accuracy",
    "biosses": "pearsonr",
}

# The corpora of each reported task, in table order.
TASKS = {
    "ner": ["bc5chem", "bc5disease", "bc2gm", "jnlpba", "ncbi-disease"],
    "document_classification": ["hoc"],
    "relation_extraction": ["chemprot", "ddi-corpus", "gad"],
    "qa": ["bioasq-task-b", "pubmed-qa"],
}

# Headings that are not just the corpus name in capitals.
DISPLAY_NAMES = {
    "pubmed-qa": "PubMed QA", "bioasq-task-b": "BioASQ", "ddi-corpus": "DDI",
    "ncbi-disease": "NCBI-disease", "chemprot": "ChemProt", "bc5chem": "BC5-chem",
    "bc5disease": "BC5-disease", "hoc": "HoC",
}

# Order of the metric families in the final table.
FAMILY_ORDER = ["base", "none", "random", "h-index", "sjr"]


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def parse_run_names(df: DataFrame, run: str = "run") -> DataFrame:
    """Add ``model, corpus, seed`` parsed from names like ``sjr_top25%_blurb-bc5chem_seed3``."""
    name = F.replace(F.col(run), F.lit("ncbi_disease"), F.lit("ncbi-disease"))
    name = F.replace(name, F.lit("blurb-"), F.lit(""))
    name = F.regexp_replace(name, "_ckpt-[0-9]*", "")
    # All models but the base ones have an underscore in their name.
    joined = F.regexp_replace(name, "^([^_]*)_", "$1-")
    parts = F.split(F.when(F.contains(run, F.lit("bert-base")), name).otherwise(joined), "_")
    seed = F.replace(F.get(parts, F.lit(2)), F.lit("seed"), F.lit("")).try_cast("int")
    return df.withColumns(
        {"model": F.get(parts, F.lit(0)), "corpus": F.get(parts, F.lit(1)), "seed": seed}
    )


def reported_runs(df: DataFrame, run: str = "run") -> DataFrame:
    """Leave out debug runs and the model trained on the whole corpus."""
    return df.where(~F.contains(run, F.lit("debug")) & (F.col("model") != "none-all"))


def mean_and_std(df: DataFrame, metrics: list[str] = METRICS, digits: int = 2) -> DataFrame:
    """Mean and population standard deviation of each metric x 100 per model and corpus."""
    cells = []
    for m in metrics:
        cells.append(F.round(F.avg(m) * 100, digits).alias(f"{m}_mean"))
        cells.append(F.round(F.stddev_pop(m) * 100, digits).alias(f"{m}_std"))
    return df.groupBy("model", "corpus").agg(*cells)


def headline_scores(df: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """``model, corpus, performance, spread``: the corpus's own metric x 100, unrounded."""
    wanted = _lookup(METRIC_OF_CORPUS, F.col("corpus"))
    value = F.coalesce(*[F.when(wanted == m, F.col(m)) for m in metrics]).cast("double")
    return df.groupBy("model", "corpus").agg(
        (F.avg(value) * 100).alias("performance"), (F.stddev_pop(value) * 100).alias("spread")
    )


def reported_corpora() -> list[str]:
    return [c for corpora in TASKS.values() for c in corpora]


def pivot_scores(scores: DataFrame, digits: int = 2) -> DataFrame:
    """One row per model, one column per reported corpus in task order, empty text for missing."""
    corpora = reported_corpora()
    wide = scores.where(F.col("corpus").isin(corpora)).groupBy("model").pivot("corpus", corpora).agg(
        F.round(F.first("performance"), digits)
    )
    return wide.select("model", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in corpora])


def transpose(wide: DataFrame, row: str, values: list[str], name: str = "corpus") -> DataFrame:
    """Swap rows and columns: ``values`` are the entries of ``row`` that become columns."""
    long = wide.unpivot([row], [c for c in wide.columns if c != row], name, "value")
    return long.groupBy(name).pivot(row, values).agg(F.first("value"))


def dataset_average(scores: DataFrame) -> DataFrame:
    """Sum of the present scores over the number of all reported corpora."""
    corpora = reported_corpora()
    mine = scores.where(F.col("corpus").isin(corpora))
    return mine.groupBy("model").agg((F.sum("performance") / len(corpora)).alias("dataset_average"))


def task_average(scores: DataFrame) -> DataFrame:
    """Mean over tasks of the mean over the task's corpora; a missing score adds 0."""
    share = {c: str(1.0 / (len(TASKS) * len(cs))) for cs in TASKS.values() for c in cs}
    weight = _lookup(share, F.col("corpus")).cast("double")
    mine = scores.where(F.col("corpus").isin(reported_corpora()))
    return mine.groupBy("model").agg(F.sum(F.col("performance") * weight).alias("task_average"))


def task_of(corpus: Column) -> Column:
    return _lookup({c: t for t, cs in TASKS.items() for c in cs}, corpus)


def display_name(corpus: Column) -> Column:
    return F.coalesce(_lookup(DISPLAY_NAMES, corpus), F.upper(corpus))


def best_two(scores: DataFrame) -> DataFrame:
    """Best and second-best model per corpus; equal scores go by model name."""
    order = Window.partitionBy("corpus").orderBy(F.desc("performance"), "model")
    return scores.withColumn("place", F.row_number().over(order)).where("place <= 2")


def model_columns(models: DataFrame) -> DataFrame:
    """Add ``family, criterion, remaining`` and the position of each model in the final table."""
    name = F.col("model")
    family = F.when(F.contains(name, F.lit("bert")), "base")
    for known in ("h-index", "random", "sjr", "none"):
        family = family.when(F.contains(name, F.lit(known)), known)
    criterion = F.when(
        F.col("family").isin("h-index", "sjr"),
        F.when(F.contains(name, F.lit("mid")), "mid").when(F.contains(name, F.lit("top")), "top"),
    )
    rest = F.replace(F.replace(name, F.concat("family", F.lit("-"))), F.coalesce("criterion", F.lit("")))
    remaining = (
        F.when(F.col("family") == "base", "0%").when(F.col("family") == "none", "100%").otherwise(rest)
    )
    place = F.array_position(F.array(*[F.lit(f) for f in FAMILY_ORDER]), F.col("family"))
    return (
        models.withColumn("family", family)
        .withColumn("criterion", F.coalesce(criterion, F.lit("")))
        .withColumn("remaining", remaining)
        .withColumn("place", place)
    )


def band_names(bands: DataFrame) -> DataFrame:
    """``metric, criteria, remaining`` from band names such as ``top25%``."""
    percent = F.contains("name", F.lit("%"))
    return bands.select(
        "metric",
        F.when(percent, F.expr("left(name, greatest(length(name) - 3, 0))")).otherwise("").alias("criteria"),
        F.when(percent, F.right("name", F.lit(3))).otherwise("100%").alias("remaining"),
    )


def run_grid(models: DataFrame, corpora: list[str], seeds: int) -> DataFrame:
    """Every run to be made: ``run, model, corpus, seed``. Corpora and seeds are
    short literal lists exploded per model."""
    return (
        models.select("model")
        .withColumn("corpus", F.explode(F.array(*[F.lit(c) for c in corpora])))
        .withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
        .withColumn("run", F.format_string("%s_%s_seed%d", "model", "corpus", "seed"))
    )


def missing_runs(grid: DataFrame, finished: DataFrame) -> DataFrame:
    """Grid entries without a result."""
    return grid.join(finished.select("run").distinct(), "run", "left_anti")


def loss_curve(log: DataFrame) -> DataFrame:
    """``run, step, loss`` from log rows, taking ``train_loss`` where there is no ``loss``."""
    return with_loss(log).where("loss is not null")


def steps_without_loss(log: DataFrame) -> DataFrame:
    return with_loss(log).where("loss is null").select("run", "step")


def with_loss(log: DataFrame) -> DataFrame:
    return log.select("run", "step", F.coalesce("loss", "train_loss").alias("loss"))
