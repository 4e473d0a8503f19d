"""From logits to label ids, label names and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import active_labels, argmax, positive_flags, visible_pairs


def predicted_class(df: DataFrame, logits: str, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, argmax(F.col(logits)))


def predicted_labels(df: DataFrame, logits: str, names: list[str], out: str = "prediction") -> DataFrame:
    """Names of the labels with a positive logit."""
    flagged = df.withColumn("_flags", positive_flags(F.col(logits)))
    return flagged.withColumn(out, active_labels(F.col("_flags"), names)).drop("_flags")


def predicted_tags(
    df: DataFrame, logits: str, labels: str, names: list[str]
) -> DataFrame:
    """``pred_tags`` and ``true_tags`` at the positions whose label counts.

    ``logits`` holds one array per position; the names are the tag vocabulary.
    """
    table = F.array(*[F.lit(n) for n in names])
    return (
        df.withColumn("_ids", F.transform(logits, argmax))
        .withColumn("_seen", visible_pairs(F.col("_ids"), F.col(labels)))
        .withColumns(
            {
                "pred_tags": F.transform("_seen", lambda x: F.get(table, x["p"])),
                "true_tags": F.transform("_seen", lambda x: F.get(table, x["l"])),
            }
        )
        .drop("_ids", "_seen")
    )
