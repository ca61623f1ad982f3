"""The corpus pipeline: five stages over ``documents``, each written and read again.

1. quality: documents that the ordinal classifier rejects go.
2. near_dedup: one document of each group of near copies stays.
3. decontamination: documents that hold a benchmark passage go.
4. secrets: secrets inside texts are replaced, ``n_chars`` follows.
5. mixing: documents are emitted as often as their source's target asks.

All stages but the last return the columns of documents; the last adds
``mix_copy``. The classifiers and graphs have no SQL form, so there is no
``ORACLE_SQL``: the tests hold every stage against a plain version of it.

Defined results: rows with a null or empty text stay until the last stage, where
they are emitted at their source's rate; a null doc_id is no copy of any other
row; rows with the same id are judged by their own texts; repeated rows are one
after stage 2; texts of any length are read whole; an empty table gives no rows;
further columns pass through, but one named ``mix_copy`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import decontam, mixing, neardup, quality, secrets
from weftline.llm.scratch import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("decontamination", decontamination_stage), ("secrets", secrets_stage), ("mixing", mixing_stage)]
#: Trained weights, signatures and graph searches have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
