"""Documents to training tokens: toxic texts, near copies, leaked test items and secrets go first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm import byte_bpe, secret_scan
from stratalake.llm.common import source, staged
from stratalake.llm.decontaminate import drop_leaks
from stratalake.llm.near_dedup import NearDedup, drop_similar
from stratalake.llm.queries import vocabulary
from stratalake.llm.toxicity import drop_toxic, train_toxicity
from stratalake.session import scratch_path

# Near copies share 80 % of their shingles of five words.
COPIES = NearDedup(words=5, percent=80, least_shared=0.5)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, learned from the labels of these documents, does not find toxic."""
    net = train_toxicity(docs, source(spark, sf_dir, "labels"))
    return drop_toxic(docs, net)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies."""
    return drop_similar(docs, COPIES)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item stands."""
    return drop_leaks(docs, source(spark, sf_dir, "benchmark"))


def documents_without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of secrets."""
    versions = docs.withColumn("version", F.lit(1))
    found = secret_scan.scan_history(versions, scratch_path(spark, "ledger"), path="doc_id")
    return secret_scan.redact(docs, found)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and the number of those."""
    return byte_bpe.encode(docs, vocabulary()).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", clean_documents),
    ("near_dedup", distinct_documents),
    ("decontamination", uncontaminated_documents),
    ("secret_scan", documents_without_secrets),
    ("byte_bpe", encoded_documents),
]

# The network, the sketches, the alignment and the encoder have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each reading what the one before wrote."""
    docs = source(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
