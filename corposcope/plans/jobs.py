"""Whole jobs: from article files to scored shards, from scored articles to
training rows, from run records to the score table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import journals as J, results as R, tokens as T
from ..operators.ordering import train_validation_split
from ..operators.scoring import Band, select_band_in_train
from ..session import staged
from ..sources import articles as A, journals as JS
from ..streaming.intake import score_scanned


def score_files(
    spark: SparkSession, article_files: str | list[str], rank_files: str | list[str], target: str
) -> DataFrame:
    """Score article files against rank lists and write one folder per input file.

    Returns the files that were left out because they are broken.
    """
    profiles = J.journal_profiles(J.rank_rows(JS.scan_journal_ranks(spark, rank_files)))
    scored, broken = score_scanned(A.scan_articles(spark, article_files), profiles)
    A.write_scored(scored, target)
    return broken


def training_rows(
    tokens: DataFrame,
    key: str,
    *,
    length: int = 512,
    band: Band | None = None,
    fraction: float = 0.01,
    batch_size: int = 1024,
    seed: int = 42,
) -> DataFrame:
    """``split, batch, chunk`` and token arrays of fixed length.

    The seeded order decides the split; the band applies to the training part;
    each part is packed in its own order. ``tokens`` is read several times, so
    pass a stored table.
    """
    split = train_validation_split(tokens, key, fraction, seed=seed)
    if band is not None and band.metric != "none":
        split = select_band_in_train(split, band.metric, band.low, band.high)
    parts = []
    for name in ("train", "validation"):
        part = split.where(F.col("split") == name)
        packed = T.pack_shuffled(part, key, length, batch_size=batch_size, seed=seed)
        parts.append(packed.withColumn("split", F.lit(name)))
    return parts[0].unionByName(parts[1])


def prepare_training(
    spark: SparkSession, scored_path: str, vocab: str, target: str, *, length: int | None = 512, model_max: int = 512,
    band: Band | None = None, fraction: float = 0.01, seed: int = 42, mask_id: int, vocab_size: int,
    probability: float = 0.15,
) -> None:
    """Scored shards to masked training rows on disk, one folder per split.

    ``vocab`` is the path of a piece file. ``length`` is cut to what the model takes.
    """
    length = T.sequence_length(length, model_max)
    scored = A.read_scored(spark, scored_path)
    tokens = staged(T.tokenise(scored, vocab, drop=["text", "shard"]), "tokens")
    rows = training_rows(tokens, "id", length=length, band=band, fraction=fraction, seed=seed)
    row_key = F.concat_ws("-", "split", "batch", "chunk")
    masked = T.mask_tokens(
        rows, row_key, mask_id=mask_id, vocab_size=vocab_size, probability=probability, seed=seed
    )
    A.write_splits(masked, target)


def score_report(records: DataFrame, digits: int = 2) -> DataFrame:
    """Raw records with a ``run`` and metric columns to the table of models by
    corpora with both averages."""
    scores = R.headline_scores(R.reported_runs(R.parse_run_names(records)))
    table = R.pivot_scores(scores, digits)
    return (
        table.join(R.dataset_average(scores), "model", "left")
        .join(R.task_average(scores), "model", "left")
        .withColumns({c: F.round(c, digits) for c in ("dataset_average", "task_average")})
    )
