"""Row numbers over whole tables without putting a table or a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.ordering import Order, null_safe_match, sort_columns
from starloom.sinks.scratch import pin

# monotonically_increasing_id() is (partition << 33) + row within the partition.
_LOCAL_BITS = 33

# Rows of a range. More ranges than partitions of a shuffle are made where there are more rows.
RANGE_ROWS = 1_000_000

# Most rows of a key that one task numbers.
HOT_ROWS = 100_000


def _positions(
    df: DataFrame, order: Order | None, position: str, stable_input: bool = False
) -> DataFrame:
    """Add the 0-based position of each row in the global sort order.

    The rows are range-partitioned and sorted; the position is the row's place in its
    partition plus the sizes of the partitions before it. The sorted rows are pinned
    because both parts must see the same range bounds, and bounds are sampled anew
    for every shuffle.

    Rows equal in all sort columns are told apart by a tag, which lets a large group of
    copies spread over several ranges. The tag numbers the rows as they arrive, so it is
    pinned too: a task run again after a lost executor must send each row where it went
    before. Only a ``stable_input`` arrives in the same order every time and needs no pin.
    The number of ranges follows the number of rows and is given, as adaptive execution would
    merge ranges by compressed size and so put a group of copies together again.

    Without an order the rows keep their partitions, and nothing is shuffled.
    """
    laid_out = df
    if order:
        tagged = df.withColumn("_tag", F.monotonically_increasing_id())
        if not stable_input:
            tagged = pin(tagged, "tagged")
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(least, tagged.count() // RANGE_ROWS)
        by = [*sort_columns(order), F.col("_tag")]
        laid_out = tagged.repartitionByRange(ranges, *by).sortWithinPartitions(*by).drop("_tag")
    placed = pin(laid_out.withColumn("_place", F.monotonically_increasing_id()), "placed")
    # One row of two numbers per range or input split. The hint says that they are few: a grouping
    # is planned to be as large as the rows, and these would be shuffled for the join.
    sizes = placed.groupBy(F.shiftright("_place", _LOCAL_BITS).alias("_part")).agg(
        F.count("*").alias("_rows")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    joined = placed.join(F.broadcast(starts), F.shiftright("_place", _LOCAL_BITS) == F.col("_part"))
    own = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*own, (F.col("_start") + local).alias(position))


def surrogate_key(
    df: DataFrame,
    order_cols: Order | None,
    name: str,
    start: int = 1,
    stable_input: bool = False,
) -> DataFrame:
    """Dense ids ``start``, ``start + 1``, ... in the order of ``order_cols``.

    ``order_cols=None`` numbers the rows as they lie, which costs no shuffle but may
    number them differently the next time. Say ``stable_input=True`` for a plain scan of
    files, possibly filtered and projected: reading it again gives the same row order,
    which saves one write of the rows.
    """
    numbered = _positions(df, order_cols, "_position", stable_input)
    return numbered.select(
        (F.col("_position") + start).alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )


def row_number_per_key(
    df: DataFrame, keys: Sequence[str], order: Order, name: str = "row_number"
) -> DataFrame:
    """Number the rows of each key from 1 in the given order; NULL keys form a group.

    A window numbers the rows of a key in one task, which is right for keys of up to
    ``HOT_ROWS`` rows. Larger ones, found by a count that combines map-side, are set apart:
    their rows are placed in one global order of key and ``order``, spread over as many ranges
    as they fill, and a row's number is its position minus that of the first row of its key.
    ``df`` is read twice, with hot keys three times, and must give the same rows each time.
    """
    by = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    counted = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.count("*").alias("_rows"))
    hot = pin(counted.filter(F.col("_rows") > HOT_ROWS).drop("_rows"), "hot")
    columns = [F.col(f"`{c}`") for c in df.columns]

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.select(*columns, F.row_number().over(by).cast("bigint").alias(name))

    if hot.isEmpty():
        return numbered(df)
    pairs = [(k, f"_key_{k}") for k in keys]
    among = null_safe_match(df, hot, pairs)
    placed = _positions(df.join(hot, among, "left_semi"), [*keys, *order], "_position")
    firsts = pin(
        placed.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
            F.min("_position").alias("_first")
        ),
        "firsts",
    )
    matched = placed.join(firsts, null_safe_match(placed, firsts, pairs))
    number = F.col("_position") - F.col("_first") + 1
    return numbered(df.join(hot, among, "left_anti")).union(
        matched.select(*columns, number.alias(name))
    )
