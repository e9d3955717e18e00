"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), ``docs`` being all that the stage before kept, and
returns a DataFrame; ``run`` writes every stage as Parquet in the shared folder of the
cluster and reads it again, so a lost executor costs one stage at most. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import decontaminate, pieces, pii, quality_mil, simhash
from tierwise.llm.common import shared_dir, table
from tierwise.llm.queries import QUERIES, SQL, tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_mil.keep_good(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return pieces.encode_documents(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: The classifier, the fingerprints, the edit distance and the segmentation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {**QUERIES, "pipeline": run}
