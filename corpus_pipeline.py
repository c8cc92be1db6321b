"""From raw documents to sampled segmentations: the stages of a training corpus, one operator each.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
docs. run() writes each stage's rows to the shared folder as Parquet and reads them again, so no stage
is computed twice and a lost executor costs one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.llm import classifier, mixing, pieces, rules, simhash
from quire.llm.common import read, shared_folder
from quire.llm.queries import MODEL

#: SQL can't express the classifier's and the sampling stages.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return rules.kept(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these and their labels, scores at its threshold or more."""
    return classifier.kept(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: shingles of five words, 0.8 alike or more."""
    return simhash.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by whole documents."""
    return mixing.resampled(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document."""
    return pieces.sampled(docs, MODEL)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", source_mixing),
    ("SentencePiece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
