"""Ordered removal of repeated keys; NULL keys count as equal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.ordering import Order, null_safe_match, sort_columns
from starloom.operators.quality import repeated_keys
from starloom.sinks.scratch import pin


def _first_rows(df: DataFrame, keys: Sequence[str], order: Order, count: int, name: str) -> DataFrame:
    """The first ``count`` rows of every key.

    With a filter on nothing but the row number Spark cuts each key to ``count`` rows
    in the map tasks already, so a hot key is shuffled as a handful of rows.
    """
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= count)


def dedupe_ordered(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key, the first in the given order."""
    return _first_rows(df, keys, order, 1, "_rank").drop("_rank")


def dup_survivors(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first row of every key that occurs more than once.

    Two rows per key are enough to tell; they come out of one shuffle, and counting
    them needs no second one.
    """
    pair = _first_rows(df, keys, order, 2, "_rank")
    pair = pair.withColumn("_seen", F.count("*").over(Window.partitionBy(*keys)))
    return pair.filter((F.col("_rank") == 1) & (F.col("_seen") > 1)).drop("_rank", "_seen")


def delete_using_anti(
    df: DataFrame, victims: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``victims``.

    ``null_safe=False`` compares as SQL ``=`` does: rows with a NULL key are never deleted.
    The victims' keys are stored first: read back they are a plain shuffle in the join, not
    the one of a grouping that made them, and only that lets a hot key's rows be split.
    """
    named = pin(victims.select([F.col(k).alias(f"_key_{k}") for k in keys]), "victims")
    if null_safe:
        match = null_safe_match(df, named, [(k, f"_key_{k}") for k in keys])
    else:
        match = reduce(lambda a, b: a & b, [df[k] == named[f"_key_{k}"] for k in keys])
    return df.join(named, match, "left_anti")


def dedupe_delete_reinsert(
    df: DataFrame, keys: Sequence[str], order: Order, null_safe: bool = True
) -> DataFrame:
    """Delete all rows of repeated keys, then put the first row of each back.

    With NULL-safe matching this equals :func:`dedupe_ordered`, which needs one pass
    and is the one to use; this form is for callers that keep the survivors apart.
    """
    singles = delete_using_anti(df, repeated_keys(df, keys), keys, null_safe)
    return singles.unionByName(dup_survivors(df, keys, order))
