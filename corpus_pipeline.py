"""Training-corpus pipeline: five stages over the whole ``documents`` table.

Each stage calls one operator of ``invdex.llm``; it takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``:

1. toxicity: documents predicted toxic go;
2. near_duplicates: one document of each SimHash group stays (smallest doc_id);
3. decontamination: documents contaminated by the benchmark go;
4. personal_data: every entity in the text is replaced by its kind;
5. mixing: sources are mixed to their target weights, one row per repetition.

Defined cases: those of the operators; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from invdex.llm import decontaminate, mixing, pii, simhash, toxicity
from invdex.llm.common import prepare, table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
]

# Toxicity scores and fingerprints can't be expressed in SQL; tests/llm checks
# the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
