"""Fact building through a natural key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def join_natural_key(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner equi-join on a natural key ``[(left column, right column), ...]``.

    The key need not be unique: every match is a row. NULL never matches, and such
    rows are dropped before the shuffle. No side is hinted: Spark broadcasts one
    only when its size is below the session's threshold; past that the join sorts
    both sides and adaptive execution splits hot keys. Both inputs must therefore
    come without a grouping on the same key, which would block the split.
    """
    match = reduce(lambda a, b: a & b, [left[lc] == right[rc] for lc, rc in on])
    return left.join(right, match, "inner")


def fact_build(
    events: DataFrame,
    catalogue: DataFrame,
    on: Sequence[tuple[str, str]],
    where: Column,
    cols: Mapping[str, Column],
) -> DataFrame:
    """Events that satisfy ``where``, matched to the catalogue, as ``{name: expression}``.

    Pass a raw catalogue: repeated catalogue rows multiply the events they match.
    """
    joined = join_natural_key(events.filter(where), catalogue, on)
    return joined.select([expr.alias(name) for name, expr in cols.items()])
