"""Duplicate, uniqueness, NULL, length and sentinel audits.

Groups are counted by aggregates that combine on the map side, so a key that owns a
large share of the table reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.ordering import null_safe_match, sort_columns
from starloom.sinks.scratch import pin


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "num_duplicates") -> DataFrame:
    """Put the number of rows sharing ``keys`` on every row; NULL keys are one group.

    Keys are counted with map-side sums and stored; the rows are joined to their counts. Both
    sides are plain shuffles, so adaptive execution splits the rows of a hot key over several
    tasks, and sends the counts to the rows where they turn out to be few.
    """
    pairs = [(k, f"_key_{k}") for k in keys]
    groups = df.groupBy(*[F.col(k).alias(a) for k, a in pairs]).agg(F.count("*").alias(name))
    counts = pin(groups, "counts")
    joined = df.join(counts, null_safe_match(df, counts, pairs))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], name)


def suspect_keys(df: DataFrame, keys: Sequence[str], name: str = "_rows") -> DataFrame:
    """Every key that is repeated or has a NULL part, with its row count, stored: what both a
    duplicate report and a key audit look at, from one grouping of the table."""
    return pin(dq_unique(df, keys, name), "suspects")


def dup_check_window(
    df: DataFrame,
    keys: Sequence[str],
    limit: int = 5,
    out_cols: Sequence[str] | None = None,
    name: str = "num_duplicates",
    suspects: DataFrame | None = None,
) -> DataFrame:
    """The first ``limit`` rows (rows, not keys) by group size, if repeated.

    Every row carries the size of its group; rows are sorted by size descending, then
    key with NULL last, cut to ``limit``, and groups of one are then left out. A group
    of n rows thus takes up to n of the lines. ``out_cols`` are the key columns to
    show beside the count (default all).

    Rows of a group look the same in this output, so each of the leading groups is
    repeated by its size instead of reading the table a second time. ``suspects`` are the
    table's :func:`suspect_keys` if they are there already; it is not read then.
    """
    groups = _repeated(df, keys, F.count("*"), name, suspects)
    order = sort_columns([(name, "desc", "last"), *keys])
    leading = groups.orderBy(*order).limit(limit)
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col(name), F.lit(limit)).cast("int")))
    rows = leading.withColumn("_copy", copies).orderBy(*order).limit(limit)
    return rows.select(name, *(keys if out_cols is None else out_cols))


def dup_check_group(
    df: DataFrame,
    keys: Sequence[str],
    count_col: str | None = None,
    limit: int = 5,
    name: str = "num_duplicates",
    suspects: DataFrame | None = None,
) -> DataFrame:
    """The ``limit`` most repeated keys; ``count_col`` counts its non-NULL values only.
    ``suspects``, which count rows, are for reports without it."""
    if suspects is not None and count_col is not None:
        raise ValueError("suspects count rows, not values")
    counted = F.count("*") if count_col is None else F.count(count_col)
    groups = _repeated(df, keys, counted, name, suspects)
    order = sort_columns([(name, "desc", "last"), *keys])
    return groups.orderBy(*order).limit(limit).select(name, *keys)


def _repeated(
    df: DataFrame, keys: Sequence[str], counted: Column, name: str, suspects: DataFrame | None
) -> DataFrame:
    if suspects is None:
        groups = df.groupBy(*keys).agg(counted.alias(name))
    else:
        groups = suspects.select(*keys, F.col("_rows").alias(name))
    return groups.filter(F.col(name) > 1)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, NULL keys included."""
    return df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter("_rows > 1").drop("_rows")


def dq_unique(df: DataFrame, keys: Sequence[str], name: str = "num_rows") -> DataFrame:
    """Every key that is repeated or has a NULL part, with its row count."""
    groups = df.groupBy(*keys).agg(F.count("*").alias(name))
    bad = F.col(name) > 1
    for key in keys:
        bad = bad | F.col(key).isNull()
    return groups.filter(bad)


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs in each column, as ``<column>_nulls``."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def dq_max_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """One row with the number of over-long values per column, as ``<column>_too_long``."""
    return df.agg(
        *[F.count_if(F.length(c) > n).alias(f"{c}_too_long") for c, n in limits.items()]
    )


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail the job on a NULL in a required column, within the pass that writes ``df``."""

    def checked(c: str):
        failure = F.raise_error(F.lit(f"NULL in required column {c}"))
        return F.when(F.col(c).isNull(), failure.cast(df.schema[c].dataType)).otherwise(F.col(c))

    return df.withColumns({c: checked(c) for c in cols})


def sentinel_probe(df: DataFrame, column: str, value=0, name: str = "num_sentinels") -> DataFrame:
    """One row: how many values of ``column`` equal the sentinel."""
    return df.filter(F.col(column) == F.lit(value)).agg(F.count("*").alias(name))
