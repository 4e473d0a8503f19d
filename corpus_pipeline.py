"""The training corpus from ``documents``: language, exact and near copies, mix, packing.

Each stage is ``(spark, docs, folder) -> DataFrame`` and is stored before the next one reads it; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corposcope.llm import exact_dedup, language, mixing, packing, simhash
from corposcope.llm.common import documents, stored


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops texts without a letter and texts that are not in a known language."""
    return language.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts linked by their SimHash fingerprints, the row with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every row as often as the mix of the sources takes it."""
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of sequences with their ids."""
    return packing.pack_documents(docs, packing.tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)


# Fingerprints, tilts and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
