"""Relations of annotated documents as entity-masked sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import sentence_begin, sentence_end, slice_text


def _entity(argument: str) -> Column:
    """First entity of the document with the id the relation names."""
    return F.get(F.filter("entities", lambda e: e["id"] == F.col(f"relation.{argument}")), F.lit(0))


def relation_arguments(documents: DataFrame) -> DataFrame:
    """One row per relation with both argument entities ``e1`` and ``e2`` resolved.

    Entities live in the same row as the relation, so there is no join.
    """
    exploded = documents.withColumn("relation", F.explode("relations"))
    return exploded.withColumns({"e1": _entity("arg1_id"), "e2": _entity("arg2_id")})


def masked_sentences(documents: DataFrame, *, keep_last: bool = False) -> DataFrame:
    """``id, text, label`` per relation: the sentence around both entities with
    each entity replaced by ``@TYPE$``.

    Only the first passage text and the first offsets of an entity count. The
    entity that starts earlier comes first; entities that overlap leave an
    empty middle.
    """

    def offset(entity: str, i: int) -> Column:
        return F.get(F.get(F.col(f"{entity}.offsets"), F.lit(0)), F.lit(i))

    def stand_in(entity: str) -> Column:
        return F.concat(F.lit("@"), F.col(f"{entity}.type"), F.lit("$"))

    rows = relation_arguments(documents).select(
        F.concat_ws("_", "document_id", "relation.id").alias("id"),
        F.col("relation.type").alias("label"),
        F.get(F.col("passages")[0]["text"], F.lit(0)).alias("_text"),
        F.struct(offset("e1", 0).alias("s"), offset("e1", 1).alias("e"), stand_in("e1").alias("m")).alias("_a"),
        F.struct(offset("e2", 0).alias("s"), offset("e2", 1).alias("e"), stand_in("e2").alias("m")).alias("_b"),
    )
    forward = F.col("_a.s") < F.col("_b.s")
    text = F.col("_text")
    ordered = rows.select(
        "id", "label", "_text",
        F.when(forward, F.col("_a")).otherwise(F.col("_b")).alias("_l"),
        F.when(forward, F.col("_b")).otherwise(F.col("_a")).alias("_r"),
        sentence_begin(text, F.least("_a.s", "_b.s")).alias("_begin"),
        sentence_end(text, F.greatest("_a.e", "_b.e"), keep_last=keep_last).alias("_end"),
    )
    return ordered.select(
        "id",
        F.concat(
            slice_text(text, F.col("_begin"), F.col("_l.s")),
            F.col("_l.m"),
            slice_text(text, F.col("_l.e"), F.col("_r.s")),
            F.col("_r.m"),
            slice_text(text, F.col("_r.e"), F.col("_end")),
        ).alias("text"),
        "label",
    )
