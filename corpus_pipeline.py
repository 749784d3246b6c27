"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), where docs is the stage before's result, written as Parquet
and read again, and works on all of it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from graphloom.llm import byte_bpe, near_dedup, pii, shared, toxicity, wu_manber
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents with this score or more are rejected as toxic.
TOXIC = 0.5


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model rejects; it learns from four fifths of the labelled ones, by id."""
    learnable = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(learnable)
    model = toxicity.fit(docs.select("doc_id", "text").where(learnable), labels)
    return toxicity.score(docs, model, "toxicity_score").where(F.col("toxicity_score") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of texts that share 80 % of their five-word shingles."""
    return near_dedup.representatives(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item (or all of a shorter one)."""
    return wu_manber.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets in the place of each span of personal data; n_chars follows the text."""
    redacted = pii.redact(docs, pii.fit(docs))
    return redacted.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of what they decode to."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.tokenized(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; what each but the last returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can't express the trained toxicity score; tests/llm/test_pipeline.py holds the stages against a brute-force version.
ORACLE_SQL = None
