"""A bitmap of fixed size that keeps rows out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the map: 4 MB, whatever the input.
BITS = 1 << 25


def mark(rows: DataFrame, key: str, among: DataFrame, name: str) -> DataFrame:
    """``rows`` plus the boolean ``name``: false if column ``key`` is NULL or not in the single
    column of ``among``, true if it is there or shares a bit with a value that is.

    Only rows marked true need to be joined to ``among``. The map is broadcast; the more
    values it holds, the more rows are marked, and the join decides in any case.
    """

    def bit(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(BITS))

    value = F.col(among.columns[0])
    bits = among.groupBy(F.bitmap_bucket_number(bit(value)).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit(value))).alias("_bits")
    )
    own = bit(F.col(key))
    bucket = F.when(F.col(key).isNotNull(), F.bitmap_bucket_number(own))
    at = F.bitmap_bit_position(own).cast("int")
    place = F.call_function("div", at, F.lit(8)).cast("int") + 1
    byte = F.conv(F.hex(F.substring("_bits", place, F.lit(1))), 16, 10).cast("int")
    found = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1
    joined = rows.join(F.broadcast(bits), bucket == F.col("_bucket"), "left")
    return joined.withColumn(name, F.coalesce(found, F.lit(False))).drop("_bucket", "_bits")
