"""Ranges of a sort key with fixed borders, and prefix sums over a whole table.

The borders are numbers taken from the data once and written into the plan. Every job, and
every task that runs again after a lost executor, therefore puts a row into the same range,
which Spark's own range partitioning (sampled anew for each shuffle) does not promise.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.operators.numbering import row_number_per_key

#: Most ranges; a border costs 8 bytes in the plan. Beyond it ranges get longer, not wrong:
#: their rows are streamed or spilled.
MOST_RANGES = 40_000


def borders(df: DataFrame, key: str, ranges: int) -> list[int]:
    """Ascending values of the whole-number column ``key`` that cut its rows into about
    ``ranges`` equal parts; each of them occurs in the column."""
    return sorted(set(_shares(df, key, ranges)))


def _shares(df: DataFrame, key: str, ranges: int) -> list[int]:
    ranges = max(1, min(MOST_RANGES, ranges))
    if ranges == 1:
        return []
    shares = [k / ranges for k in range(1, ranges)]
    return df.agg(F.percentile_approx(key, shares, max(10_000, 20 * ranges))).first()[0] or []


def spread(
    df: DataFrame, key: str, ties: Sequence[str], ranges: int, part: str, tie: str
) -> DataFrame:
    """Add ``part``, numbers of ranges of ``key`` (NULL first) and, within a hot key, of ``ties``;
    and ``tie``, which orders the rows of a hot key and is 0 for others. ``df`` must be stored.

    A key is hot if its rows fill more than one range, which shows as a border that comes
    twice, or if it is NULL on so many rows. Only rows of hot keys are numbered, spread over
    tasks; rows equal in all ties are told apart there. Without hot keys this is one grouping
    for the borders.
    """
    found = _shares(df, key, ranges)
    cuts = sorted(set(found))
    count, nulls = df.agg(F.count("*"), F.count_if(F.col(key).isNull())).first()
    rows = max(1, -(-count // max(1, min(MOST_RANGES, ranges))))
    hot = sorted({a for a, b in zip(found, found[1:]) if a == b})
    at = range_of(F.col(key), cuts).cast("bigint")
    # At most one key per range.
    listed = df.sparkSession.createDataFrame([(k,) for k in hot], "_hot long")
    known = df.join(F.broadcast(listed), F.col(key) == F.col("_hot"), "left")
    many = F.col("_hot").isNotNull()
    if nulls > rows:
        many = many | F.col(key).isNull()
    elif not hot:
        return df.withColumns({part: at, tie: F.lit(0).cast("bigint")})
    order = [(t, "asc", "first") for t in ties]
    numbered = row_number_per_key(known.filter(many).drop("_hot"), [key], order, tie)
    # More ranges within a key than it has rows for do not exist, so others come behind them.
    width = F.lit(count // rows + 2).cast("bigint")
    inside = F.call_function("div", F.col(tie) - 1, F.lit(rows).cast("bigint"))
    others = known.filter(~many).drop("_hot").withColumn(tie, F.lit(0).cast("bigint"))
    return numbered.withColumn(part, at * width + inside).unionByName(
        others.withColumn(part, at * width + width - 1)
    )


def range_of(key: Column, cuts: Sequence[int]) -> Column:
    """The number of borders at or below ``key``; NULL comes first, in range 0.

    Borders lie in a list of lists, so a row is compared with about twice the root of them.
    """
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    rows = [list(cuts[i : i + step]) for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(r[0]).cast("bigint") for r in rows])
    lists = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in r]) for r in rows])
    at = F.size(F.filter(heads, lambda b: b <= key))
    inner = F.size(F.filter(F.element_at(lists, F.greatest(at, F.lit(1))), lambda b: b <= key))
    found = F.when(at == 0, F.lit(0)).otherwise((at - 1) * step + inner)
    return F.when(key.isNull(), F.lit(0)).otherwise(found).cast("int")


def in_range(value: int | None, cuts: Sequence[int]) -> int:
    """The same for one number on the driver."""
    return 0 if value is None else bisect.bisect_right(cuts, value)


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    part: str,
    order: Sequence[str],
    sums: dict[str, str],
) -> DataFrame:
    """Add ``sums[name]``: the sum of column ``name`` over the rows before, in the order of
    ``part`` (a whole number) and then ``order``, within each ``group``.

    Totals per (group, part) come from one grouping with map-side sums; their prefix sums are
    taken over these few rows, and the rows of a part only add what lies before them there.
    No task sees more than one part, however many rows a group has. Group and part columns
    must not be NULL.
    """
    keys = [*group, part]
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums],
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumns({n: F.coalesce(F.sum(c).over(within), F.lit(0)) for c, n in sums.items()})
    on = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    joined = rows.join(starts, on)
    for c, n in sums.items():
        joined = joined.withColumn(n, F.col(n) + F.col(f"_before_{c}"))
    return joined.drop(*[f"_key_{k}" for k in keys], *[f"_before_{c}" for c in sums])
