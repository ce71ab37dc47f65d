"""Contiguous shards of equal bytes.

Rows stand in the order of a whole-number key. Each range of the key gives its total of bytes
and rows; prefix sums over these totals tell every range what lies before it, so each row
knows its global byte offset without a global sort in one task. The shard is where the middle
of the row falls when all bytes are cut at equal targets: a shard is a contiguous run, and
differs from the target by less than its first and last row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.llm.ranges import running_totals, spread
from starloom.sinks.scratch import pin


def contiguous_shards(
    df: DataFrame, shards: int, size: str, key: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``shard`` (int, 0 to ``shards`` - 1) and ``slot`` (long, gapless from 0 in each).

    ``size`` names a positive whole-number column, ``key`` the whole-number column that orders
    the rows, NULL first; ``ties`` order rows of equal keys, and rows equal in those too may
    change places with each other. A key on very many rows, NULL too, is spread over ranges
    of its ties. A single row larger than a target leaves neighbouring
    shards empty. An empty table gives no rows. Other columns pass through; a ``shard`` or
    ``slot`` among them is replaced.
    """
    df = df.drop("shard", "slot")
    # The row's own columns travel as one, so that their names cannot clash.
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        F.col(size).alias("_size"),
        F.lit(1).cast("bigint").alias("_one"),
        F.col(key).alias("_key"),
        *[F.col(c).alias(f"_tie{k}") for k, c in enumerate(ties)],
    )
    rows = pin(packed, "to-shard")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = [f"_tie{k}" for k in range(len(ties))]
    ranged = spread(rows, "_key", own, max(least, count // 500_000), "_part", "_place")
    placed = running_totals(
        ranged, [], "_part", ["_key", "_place", *own], {"_size": "_offset", "_one": "_index"}
    )
    middle = (F.col("_offset") * 2 + F.col("_size")) * shards
    shard = F.call_function("div", middle, F.lit(max(1, 2 * total)))
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), shard).cast("int"))
    # At most one row per shard.
    firsts = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_index").alias("_first"))
    joined = placed.join(F.broadcast(firsts), F.col("shard") == F.col("_shard"))
    return joined.select("_row.*", "shard", (F.col("_index") - F.col("_first")).alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, size: str, key: str) -> None:
    """Write ``df`` as one folder per shard, rows in slot order within its files."""
    placed = contiguous_shards(df, shards, size, key)
    placed.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def document_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document with its shard; a null text has no bytes. The law is ``bytes``:
    sizes (text bytes plus 16) are near equal."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return contiguous_shards(rows, shards, "size", "doc_id", ["text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
