"""Token counts without token ids.

A byte-level BPE splits text into pre-tokens and each pre-token into pieces, independently of
its neighbours. So the pieces of each distinct pre-token are counted once, and a document's
tokens are the sum of pieces times frequency over its pre-tokens.

1. Every text is cut into pre-tokens once, and counted per document. Pre-tokens of a bounded
   list (the most frequent ones of a bounded sample, with their pieces) are summed on the spot:
   the list is the broadcast side of the join, and takes the hot keys out of the shuffle.
2. The others are stored per document; the distinct ones get their pieces in one pass.
3. The stored frequencies are joined to these pieces and summed per document.

Which pre-tokens the list holds changes the cost and never the counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from starloom.llm.arrays import bound_batches
from starloom.sinks.scratch import pin

#: Bounds of the broadcast list and of the documents it is taken from.
LISTED = 200_000
SAMPLED = 4_000

#: The pre-token pattern of the byte-level vocabulary (also in the tokenizer's
#: package), and the code points for which the pattern engines are known to agree.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
AGREED = r"[^\x00-ԯ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣]"


class PreTokens:
    """Cuts texts into pre-tokens as the tokenizer of ``file`` does, and counts their pieces."""

    _known: dict[str, PreTokens] = {}

    def __init__(self, file: str) -> None:
        self.tokenizer = Tokenizer.from_file(file)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that take text around them are not supported")
        if self.tokenizer.normalizer is not None:
            raise ValueError("a tokenizer with a normalizer is not supported")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.split = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)").split
        self.fast = regex.compile(PATTERN).findall
        self.odd = re.compile(AGREED).search

    @classmethod
    def of(cls, file: str) -> PreTokens:
        """The one of this worker process."""
        if file not in cls._known:
            cls._known[file] = cls(file)
        return cls._known[file]

    def count(self, text: str) -> tuple[Counter, int]:
        """(frequencies of the pre-tokens, special tokens written out in the text)."""
        parts = self.split(text)
        found: Counter = Counter()
        for part in parts:
            if self.odd(part):
                found.update(part[a:b] for _, (a, b) in self.cut(part))
            else:
                found.update(self.fast(part))
        return found, len(parts) - 1

    def pieces(self, tokens: list[str]) -> list[int]:
        """Pieces of each pre-token; it is not split again."""
        return [len(e) for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]


def _listed(docs: DataFrame, text: str, file: str) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens of a sample, at most ``LISTED``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens.of(file)
        found: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                found.update(cutter.count(value or "")[0])
        tokens = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(tokens, pa.string()),
                pa.array([found[t] for t in tokens], pa.int64()),
                pa.array(cutter.pieces(tokens), pa.int64()),
            ],
            ["token", "found", "pieces"],
        )

    share = min(1.0, SAMPLED / max(1, docs.count()))
    sample = docs.select(text).sample(share, seed=1).limit(2 * SAMPLED)
    counted = sample.repartition(8).mapInArrow(cut, "token string, found long, pieces long")
    ranked = counted.groupBy("token").agg(F.sum("found").alias("found"), F.max("pieces").alias("pieces"))
    rows = ranked.orderBy(F.desc("found"), "token").limit(LISTED).collect()
    return {r["token"]: r["pieces"] for r in rows}


def count_tokens(docs: DataFrame, file: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``n_bytes`` and ``n_tokens`` (long).

    ``file`` is a byte-level BPE of the ``tokenizers`` library that every executor can read.
    A null or empty text has no tokens. Special tokens written out in a text count as one.
    Rows are numbered once when they are stored, so repeated rows, repeated ids and null ids
    stay apart. An empty table gives no rows; columns named ``n_bytes`` or ``n_tokens`` are
    replaced.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.drop("n_bytes", "n_tokens")
    kept = [c for c in docs.columns if c != text]
    listed = spark.sparkContext.broadcast(_listed(docs, text, file))

    @F.arrow_udf("struct<known: long, rest: array<struct<token: string, times: long>>>")
    def frequencies(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cutter, pieces = PreTokens.of(file), listed.value
        for batch in batches:
            known, ends, tokens, times = [], [0], [], []
            for value in batch.to_pylist():
                found, total = cutter.count(value) if value else ({}, 0)
                for token, n in found.items():
                    if token in pieces:
                        total += n * pieces[token]
                    else:
                        tokens.append(token)
                        times.append(n)
                known.append(total)
                ends.append(len(tokens))
            rest = pa.StructArray.from_arrays(
                [pa.array(tokens, pa.string()), pa.array(times, pa.int64())], ["token", "times"]
            )
            yield pa.StructArray.from_arrays(
                [pa.array(known, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)],
                ["known", "rest"],
            )

    def piece_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens.of(file)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            counts = pa.array(cutter.pieces(tokens), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["_token", "_pieces"])

    stored = pin(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("_own"),
            F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
            frequencies(text).alias("_f"),
        ),
        "pre-tokens",
    )
    others = stored.select("_row", F.explode("_f.rest").alias("_t")).select(
        "_row", F.col("_t.token").alias("token"), F.col("_t.times").alias("times")
    )
    pieces = others.select("token").distinct().mapInArrow(piece_counts, "_token string, _pieces long")
    summed = (
        others.join(pieces, F.col("token") == F.col("_token"))
        .groupBy(F.col("_row").alias("_of"))
        .agg(F.sum(F.col("times") * F.col("_pieces")).alias("_more"))
    )
    more = F.coalesce(F.col("_more"), F.lit(0))
    return stored.join(summed, F.col("_row") == F.col("_of"), "left").select(
        *[F.col(f"_own.`{c}`") for c in kept], "n_bytes", (F.col("_f.known") + more).alias("n_tokens")
    )
