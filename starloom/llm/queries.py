"""The operators over their whole tables, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import (
    decontam,
    fingerprints,
    merkle,
    mixing,
    near_dedup,
    oracle,
    prefix_trie,
    quality,
    secrets,
    shards,
    tokens,
    training_order,
    warc,
    weak_rules,
)
from starloom.sinks.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed value: the id of the end mark in the byte-level vocabulary.
END = 50256


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """A file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; ``over_limit`` marks those of more than 512."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, tokenizer_file())
    return counted.withColumn("over_limit", counted["n_tokens"] > 512)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of ten words of benchmark items."""
    documents, benchmark = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontam.contamination(documents, benchmark).drop("spans")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and the next document."""
    return fingerprints.compare_neighbours(_table(spark, sf_dir, "documents"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 contiguous shards of equal bytes."""
    return shards.document_shards(_table(spark, sf_dir, "documents"), 40)


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in fixed-stride shards, read back."""
    docs = _table(spark, sf_dir, "documents")
    path, ranks = scratch_path(spark, "shards"), tokenizer_file("byte_bpe_50k.tiktoken")
    return training_order.training_sequences(docs, path, ranks, END)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id among its near copies."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, read back and assembled."""
    path = scratch_path(spark, "warc")
    warc.write_captures(_table(spark, sf_dir, "pages"), path, compression="gzip")
    return warc.resolve(warc.assemble(warc.read_warc(spark, path)))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, credentials of several parts linked."""
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's places in a mixture of the sources to tempered weights."""
    docs = _table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "source", mixing.text_size().alias("size"))
    return mixing.mix(rows, size=rows["size"])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learnt from two thirds of the labels."""
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.score_documents(docs, labels)


def op11_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and the verdict of all rules together."""
    return weak_rules.judge(_table(spark, sf_dir, "documents"))[0]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest, and what a changed length does to it."""
    docs = _table(spark, sf_dir, "documents")
    stored = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    longer = F.when(changed, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(docs, stored, claimed=[*stored[:3], longer, stored[4]])


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of rebuilt conversations with the totals of its subtree."""
    turns = _table(spark, sf_dir, "conversations")
    return prefix_trie.prefix_trie(turns).drop("node", "parent")


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_order_minhash": op3_order_minhash,
    "op4_shards": op4_shards,
    "op5_training_order": op5_training_order,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_warc": op7_warc,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_weak_rules": op11_weak_rules,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op2_decontamination": oracle.DECONTAMINATION,
    "op4_shards": oracle.SHARDS,
    "op6_near_duplicates": oracle.NEAR_DUPLICATES,
    "op7_warc": oracle.WARC,
    "op12_merkle_manifest": oracle.MERKLE,
    "op13_prefix_trie": oracle.PREFIX_TRIE,
}
