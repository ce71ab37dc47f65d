"""From raw documents to training order, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept and
returns a DataFrame; all but the last keep the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starloom.llm import decontam, mixing, near_dedup, quality, queries, training_order
from starloom.sinks.scratch import pin, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _free(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of the documents has it."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores 0.5 or more.

    Scores depend on the text alone: null and empty texts have the score of a text without
    lines, repeated rows come out alike, and rows without an id are scored as well. An empty
    table stays empty; without labels of both kinds nothing is learnt, and texts score 0.5.
    Columns of any name pass through.
    """
    labels = _table(spark, sf_dir, "labels").filter(~quality.held_out())
    score = _free(docs, "_score")
    scored = quality.add_scores(docs, quality.train(docs, labels), score)
    return scored.filter(F.col(score) >= 0.5).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Of rows with the same id and text one stays. Rows without an id stay.
    """
    kept, copy = _free(docs, "_kept"), _free(docs, "_copy")
    found = near_dedup.near_duplicates(docs).filter("kept AND doc_id IS NOT NULL")
    known = docs.join(
        found.select(F.col("doc_id").alias(kept)).distinct(), F.col("doc_id") == F.col(kept), "left_semi"
    )
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    once = known.withColumn(copy, F.row_number().over(same)).filter(F.col(copy) == 1)
    return once.select(docs.columns).union(docs.filter("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item.

    Null and empty texts share none, so they stay, as do all documents if the benchmark is
    empty. Repeated rows come out alike; ids are not looked at. An empty table stays empty, and
    columns of any name pass through.
    """
    hits = _free(docs, "_hits")
    found = decontam.find_benchmark(docs, _table(spark, sf_dir, "benchmark"), name=hits)
    return found.filter(F.col(hits)["n_hit"] == 0).select(docs.columns)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of a mixture to tempered weights, those of sources below
    their weight once more; every document stays.

    A NULL source is a source of its own. Null and empty texts take one byte.
    Repeated rows each keep a place; ids only order the documents of a source. An empty table
    stays empty, and columns of any name pass through.
    """
    aside = {c: _free(docs, f"_{c}") for c in docs.columns if c in mixing.ADDED}
    mixed = mixing.mix(docs.withColumnsRenamed(aside))
    ordered = mixed.repartitionByRange("mix_slot", "mix_offset")
    ordered = ordered.sortWithinPartitions("mix_slot", "mix_offset").drop(*mixing.ADDED)
    return ordered.withColumnsRenamed({new: old for old, new in aside.items()}).select(docs.columns)


def training_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in fixed-stride shards in training order; one row per sequence.

    The texts form one stream in stored order, each closed by the end mark, so null and empty
    texts are an end mark alone and repeated rows are tokenized each. Null and repeated ids are
    listed as they are, other columns are not looked at. An empty table gives no sequences.
    """
    ranks = queries.tokenizer_file("byte_bpe_50k.tiktoken")
    return training_order.training_sequences(
        docs, scratch_path(spark, "shards"), ranks, queries.END
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixture),
    ("token-ID / binary output", training_shards),
]

#: A trained classifier, a schedule and tokenized shards cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{stage.__name__}")
    return docs
