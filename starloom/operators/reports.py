"""Top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.ordering import Order, sort_columns
from starloom.operators.dedupe import dedupe_ordered


def top_sorted(df: DataFrame, order: Order, k: int) -> DataFrame:
    """The first ``k`` rows in the given order."""
    return df.orderBy(*sort_columns(order)).limit(k)


def topk_join_agg(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    group: str,
    count_col: str,
    k: int = 5,
    mode: str = "reference",
    dim_order: Order = (),
    name: str = "num_rows",
) -> DataFrame:
    """The ``k`` groups of a dimension attribute with the most fact rows.

    Counts non-NULL ``count_col`` over the inner join on ``(fact column, dim column)``;
    ties are broken by the group. A key with several dimension rows counts once per
    row; ``mode="unique"`` first reduces the dimension to one row per key, the first
    by ``dim_order``.

    Facts are counted per key and dimension rows per (key, group) before the join, so
    neither a hot key nor a fact row is ever shuffled for it: the count over the join
    is the sum of (fact count x dimension copies).
    """
    fact_key, dim_key = on
    if mode == "unique":
        dim = dedupe_ordered(dim, [dim_key], [*dim_order, group])
    elif mode != "reference":
        raise ValueError(f"mode must be 'reference' or 'unique', not {mode!r}")
    per_key = (
        fact.filter(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("_fact_key"))
        .agg(F.count(count_col).alias("_facts"))
    )
    members = (
        dim.filter(F.col(dim_key).isNotNull())
        .groupBy(F.col(dim_key).alias("_dim_key"), F.col(group))
        .agg(F.count("*").alias("_copies"))
    )
    joined = per_key.join(members, F.col("_fact_key") == F.col("_dim_key"))
    totals = joined.groupBy(group).agg(F.sum(F.col("_facts") * F.col("_copies")).alias(name))
    return top_sorted(totals, [(name, "desc", "last"), group], k)
