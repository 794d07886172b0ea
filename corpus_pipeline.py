"""The training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Part of subpackage ``roadflow.llm``. Every stage but the last returns the columns of ``documents``; each works
on all that the stage before kept.

toxicity         documents that score 0.5 or more go
near_duplicates  one document of each SimHash component stays
decontamination  documents with any window of a benchmark item go
pii              personal data and the terms that disclose it are masked in place
mixing           the corpus as blocks of words drawn to the sources' target weights, a row per block taken

Defined results, of every stage: a null text is empty, links with other texts without words, and is otherwise kept; a
null doc_id or source is a value like any other; repeated rows are near duplicates of each other, so one stays; an
empty table gives an empty one with the same columns; further columns, whatever their names, pass all stages but the
last; whole texts are read, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadflow.llm import contamination, mixing, pii, simhash, toxicity
from roadflow.llm.common import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_blocks(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

#: The learned and iterative stages have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
