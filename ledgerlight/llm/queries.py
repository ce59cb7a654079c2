"""The registered queries of this subpackage: each derives its contract's columns from an operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, decontaminate, filteraudit, htmltext, imatch, katz, langid, secrets, simhash, suffixdedup, tokenfile, urls
from ..session import scratch_path
from .common import id_remainder, table


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff and add-one scores of every document, learnt from those whose crc32(doc_id) mod 7 is not 2."""
    found = katz.score(table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) != 2)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 50-byte strings that start in one with a smaller id."""
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents"), 50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding host rule and verdict of every page's url."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document over 3-word shingles, and its component at 3 bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that occur in documents with at most one edit in 16 characters."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the tokenizers library, written to plane files and read back."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    path = scratch_path(spark, "token-files")
    tokenfile.write(table(spark, sf_dir, "documents"), path, definition, end_id=2)
    return tokenfile.read(spark, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the ranks of a public byte-level BPE, and the bytes they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every document and of an edit of it, and how alike they and the next document's are."""
    docs = table(spark, sf_dir, "documents")
    return imatch.robustness(docs, imatch.lexicon(docs))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secret spans of every document, and those that the corpus-wide ownership of their values adds."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[secrets.counted(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"), "n_live")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    return (langid.predict(docs, model)
            .select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its lightest repair, and the digest of what that gives."""
    return conversations.report(table(spark, sf_dir, "conversations"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by weights learnt from pages that mark theirs."""
    pages = table(spark, sf_dir, "pages")
    return htmltext.extracted(pages, htmltext.learn(pages))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from the documents of each language, in all 120 orders."""
    return filteraudit.interactions(*filteraudit.failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz": op1_katz,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_simhash": op4_simhash,
    "op5_decontaminate": op5_decontaminate,
    "op6_token_files": op6_token_files,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_imatch": op8_imatch,
    "op9_secrets": op9_secrets,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_html_text": op12_html_text,
    "op13_filter_audit": op13_filter_audit,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filters": urls.oracle_sql(), "op13_filter_audit": filteraudit.oracle_sql()}
