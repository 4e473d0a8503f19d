"""Label vocabularies and the encoding of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from .lookup import lookup_join

# Fixed value: the label of unlabelled rows.
UNLABELLED = "-1"


def sequence_columns(
    df: DataFrame, task: str, text: str | None = None, label: str | None = None
) -> tuple[str, str]:
    """Names of the word and the tag column: as given, else ``tokens`` and
    ``<task>_tags``, else the first two columns."""
    text = text or ("tokens" if "tokens" in df.columns else df.columns[0])
    tags = f"{task}_tags"
    return text, label or (tags if tags in df.columns else df.columns[1])


def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    """``(label)``: distinct values of a label column or of the lists in it, as strings."""
    is_list = isinstance(df.schema[column].dataType, ArrayType)
    value = F.explode(column) if is_list else F.col(column)
    return df.select(value.alias("label")).select(F.col("label").cast("string")).distinct()


def label_vocabulary(labels: DataFrame) -> DataFrame:
    """``(label, label_id)`` in sorted order. A label set is bounded by the classes
    of a model, so the numbering window sees a handful of rows."""
    order = Window.orderBy("label")
    return labels.distinct().select("label", (F.row_number().over(order) - 1).alias("label_id"))


def labels_of_splits(df: DataFrame, column: str, *, check: bool = False) -> DataFrame:
    """Label vocabulary over all splits without the unlabelled marker.

    ``check`` counts the labels at once and refuses fewer than two.
    """
    vocabulary = label_vocabulary(distinct_labels(df, column).where(F.col("label") != UNLABELLED))
    if check and vocabulary.count() < 2:
        raise ValueError("classification needs at least two labels")
    return vocabulary


def labels_missing_from(df: DataFrame, column: str, split: str, base: str = "train") -> DataFrame:
    """Labels that occur in ``split`` but not in ``base``."""
    here = distinct_labels(df.where(F.col("split") == split), column)
    return here.join(distinct_labels(df.where(F.col("split") == base), column), "label", "left_anti")


def encode_label(df: DataFrame, column: str, vocabulary: DataFrame, **join) -> DataFrame:
    """Add ``label_id``; unlabelled rows keep -1."""
    table = vocabulary.select(F.col("label").alias(column), "label_id")
    text = df.withColumn(column, F.col(column).cast("string"))
    joined = lookup_join(text, table, column, "left", **join)
    unlabelled = F.col(column) == UNLABELLED
    return joined.withColumn("label_id", F.when(unlabelled, -1).otherwise(F.col("label_id")))


def decode_label(df: DataFrame, column: str, vocabulary: DataFrame, **join) -> DataFrame:
    """Add ``label`` for the label id in ``column``."""
    table = vocabulary.select(F.col("label_id").alias(column), "label")
    return lookup_join(df, table, column, "left", **join)


def inside_ids(vocabulary: DataFrame) -> DataFrame:
    """Add ``inside_id``: the id of ``I-x`` for a label ``B-x`` if it exists, else the own id."""
    inside = vocabulary.select(F.col("label").alias("_inside"), F.col("label_id").alias("_inside_id"))
    wanted = F.when(
        F.col("label").startswith("B-"), F.replace("label", F.lit("B-"), F.lit("I-"))
    ).otherwise(F.col("label"))
    return (
        vocabulary.withColumn("_inside", wanted)
        .join(inside, "_inside", "left")
        .select("label", "label_id", F.coalesce("_inside_id", "label_id").alias("inside_id"))
    )


def merge_splits(df: DataFrame, split: str, into: str) -> DataFrame:
    """Union of two splits under the name of the second."""
    return df.withColumn("split", F.when(F.col("split") == split, into).otherwise(F.col("split")))
