"""A training corpus from raw documents: each stage takes the documents that the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import shared_folder
from headway.llm import decontaminate, jaccard_join, line_dedup, quality_classifier, sentencepiece_dropout
from headway.llm.shared import table

# Near copies share 80 percent of their runs of five words; op8's own values bind its query only.
NEAR_PERCENT, NEAR_SHINGLE = 80, 5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classified(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return quality_classifier.without_rejected(docs, quality_classifier.resample(docs, table(spark, folder, "labels")))


def fresh_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the lines that an earlier one holds; n_chars follows the text."""
    left = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return left.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Rows that repeat an id and a set are one."""
    return jaccard_join.without_near_copies(docs, NEAR_PERCENT, NEAR_SHINGLE)


def uncontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.without_contaminated(docs, decontaminate.find_contamination(docs, table(spark, folder, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of every document, and whether they decode to its text."""
    vocabulary = sentencepiece_dropout.read_vocabulary()
    made = sentencepiece_dropout.encode(docs.select("doc_id", "text"), vocabulary, check_col="lossless")
    return made.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "lossless")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classified),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("SentencePiece encoding", encoded),
]

# The classifier's model and the keyed segmentation have no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    root = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, folder).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
