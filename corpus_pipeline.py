"""From raw documents to token ids: language, near duplicates, secrets, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlens.llm import byte_bpe, language_id, mixing, near_duplicates, secret_scan
from buildlens.llm.common import table, written


#: Rows that tasks and Python workers hand each other at once: texts may be long, and both sides hold a batch.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no clear language, go."""
    spark.conf.set(*BATCH)
    return language_id.recognised(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    spark.conf.set(*BATCH)
    return near_duplicates.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become a mark."""
    spark.conf.set(*BATCH)
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken up to twice, so that the sources come to their target weights."""
    spark.conf.set(*BATCH)
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian 32-bit), ids_sha256, and the digest of the decoded bytes."""
    spark.conf.set(*BATCH)
    tokenizer = byte_bpe.load()
    coded = docs.select("doc_id", "lang", "source", byte_bpe.coded(F.col("text"), tokenizer).alias("coded"))
    decoded = coded.select("doc_id", "lang", "source", "coded.*")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Trained models, hashes and token ids are beyond SQL: the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage's rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
