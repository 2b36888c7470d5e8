"""The corpus pipeline: stages over the documents table, each calling one operator of clicktide.llm.

    quality rules -> SimHash near-dedup -> benchmark decontamination -> PII redaction -> packing

Every stage works on all rows that its predecessor kept. All but the last return the columns of documents;
the last returns the pieces of the packed training sequences with their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm import common, decontaminate, packing, pii, quality_rules, queries, simhash


def counted(docs: DataFrame) -> DataFrame:
    """n_chars as the length of the text, after a stage that changes texts."""
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that a rule rejects go."""
    return docs.where(quality_rules.accepted(F.col("text")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each component stays, that with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, bits=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: passages of test items go, with their document if they cover more than half of it."""
    return counted(decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"), window=10, most_covered=0.5))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: spans of personal data are replaced by their kind."""
    return counted(pii.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the pieces of the training sequences, with their ids."""
    return packing.pack(docs, queries.BYTE_BPE, capacity=1024, end_id=0)


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL has neither the boosted trees nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read by the next stage.

    A stage's table is removed when its successor is written, so the folder holds one copy of the corpus beside
    the tables of the last stage.
    """
    docs, held = common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        last, held = held, common.shared_folder(spark)
        docs = common.store(stage(spark, docs, sf_dir), held)
        if last:
            common.remove(spark, last)
    return STAGES[-1][1](spark, docs, sf_dir)
