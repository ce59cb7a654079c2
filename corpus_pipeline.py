"""The corpus pipeline: language ID, near-duplicate removal, decontamination, secret redaction, encoding.

``STAGES`` lists (name, function) pairs.  Each function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read back as the next stage's ``docs``.  All but the last
return the columns of ``documents``; each works on all rows its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import bpe, decontaminate, langid, secrets, simhash
from ledgerlight.llm.common import id_remainder, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; those without letters or between languages go."""
    return langid.accepted(docs, langid.train(docs.where(id_remainder("doc_id", 5) != 0)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHashes (3-word shingles) are linked at 3 bits or fewer."""
    return simhash.first_of_each(docs, words=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs, exactly or with one edit in 16 characters."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a placeholder."""
    return secrets.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and whether they decode to its text."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(docs.withColumn("doc", F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))),
                                    ranks, public_tokenizers.PATTERN, "doc"), ranks)
    return decoded.select("doc.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          (F.col("decoded") == F.col("doc.text").cast("binary")).alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]

#: SQL can't state naive Bayes, fingerprint components or byte-pair merges: tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
