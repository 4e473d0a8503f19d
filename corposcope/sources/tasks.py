"""Task datasets: one table with nested annotations, partitioned by task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The dataset configurations of each task family.
TASK_DATASETS = {
    "ner": ["bc5chem", "bc5disease", "bc2gm", "jnlpba", "ncbi_disease"],
    "pico": ["ebm_pico"],
    "relation_extraction": ["chemprot", "ddi_corpus", "gad"],
    "sentence_similarity": ["biosses"],
    "document_classification": ["hallmarks_of_cancer"],
    "qa": ["bioasq_task_b", "pubmed_qa"],
}

DOCUMENT_SCHEMA = """
document_id string,
passages array<struct<text: array<string>>>,
entities array<struct<id: string, type: string, offsets: array<array<int>>>>,
relations array<struct<id: string, type: string, arg1_id: string, arg2_id: string>>
"""


def write_tasks(df: DataFrame, path: str) -> None:
    """``task`` and ``dataset`` become folders."""
    df.write.partitionBy("task", "dataset").parquet(path)


def scan_tasks(spark: SparkSession, path: str, task: str | None = None) -> DataFrame:
    """All task datasets, or those of one task, in which case only its folders are read."""
    if task is not None and task not in TASK_DATASETS:
        raise ValueError(f"task {task} not found, available tasks are {sorted(TASK_DATASETS)}")
    df = spark.read.parquet(path)
    return df if task is None else df.where(F.col("task") == task)
