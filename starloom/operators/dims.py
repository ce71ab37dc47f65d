"""Dimension builders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.functions.columns import calendar_parts, epoch_to_timestamp
from starloom.functions.ordering import Order
from starloom.operators.dedupe import dedupe_ordered


def _not_null(columns: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def dim_distinct(df: DataFrame, cols: dict[str, str], not_null: Sequence[str] = ()) -> DataFrame:
    """Distinct whole rows of the renamed columns ``{source: output}``.

    Distinct covers every column, so one key may keep several rows. ``not_null``
    names source columns.
    """
    kept = df.filter(_not_null(not_null)) if not_null else df
    return kept.select([F.col(src).alias(out) for src, out in cols.items()]).distinct()


def dim_time(df: DataFrame, ms_col: str, name: str = "start_time") -> DataFrame:
    """One row per distinct second with its calendar parts.

    The parts are computed after the distinct, once per second instead of per event.
    """
    seconds = df.filter(F.col(ms_col).isNotNull()).select(epoch_to_timestamp(ms_col).alias(name))
    return calendar_parts(seconds.distinct(), name)


def max_per_key(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(name))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    cols: Sequence[str],
    ties: str = "all",
    tie_order: Order = (),
) -> DataFrame:
    """Distinct ``keys + cols`` rows that carry the latest ``order_col`` of their key.

    NULL keys and keys without any ``order_col`` value are left out. ``ties="all"``
    keeps every distinct row at the latest value, ``"first"`` keeps one, picked by
    ``tie_order`` and then by the output columns.

    The log is first reduced, map-side, to one row per distinct ``keys + cols`` with
    its own latest value; only those rows are shuffled and compared.
    """
    states = (
        df.filter(_not_null([*keys, order_col]))
        .groupBy(*keys, *cols)
        .agg(F.max(order_col).alias("_last"))
    )
    if ties == "first":
        order = [("_last", "desc", "last"), *tie_order, *cols]
        return dedupe_ordered(states, keys, order).drop("_last")
    if ties != "all":
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    tops = states.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.max("_last").alias("_top")
    )
    same_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    latest = states.join(tops, same_key & (F.col("_last") == F.col("_top")))
    return latest.select(*keys, *cols)
