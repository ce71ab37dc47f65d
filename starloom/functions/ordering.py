"""Sort orders with explicit NULL placement, and NULL-safe key matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A sort column: a name (ascending, NULLs last) or (name, "asc"|"desc", "first"|"last").
Order = Sequence[str | tuple[str, str, str]]

_DIRECTIONS = {
    ("asc", "first"): F.asc_nulls_first,
    ("asc", "last"): F.asc_nulls_last,
    ("desc", "first"): F.desc_nulls_first,
    ("desc", "last"): F.desc_nulls_last,
}


def sort_columns(order: Order) -> list[Column]:
    specs = [(o, "asc", "last") if isinstance(o, str) else o for o in order]
    return [_DIRECTIONS[direction, nulls](name) for name, direction, nulls in specs]


def null_safe_match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition under which NULL keys match each other."""
    return reduce(
        lambda a, b: a & b, [left[lc].eqNullSafe(right[rc]) for lc, rc in pairs]
    )
