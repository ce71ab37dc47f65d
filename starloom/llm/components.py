"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.sinks.scratch import pin


def _pointed(links: DataFrame) -> DataFrame:
    """(_at, _least): the smallest neighbour of each node, by map-side minima. Stored, so that
    a join with it has plain shuffles and the links of a large star can be split."""
    least = links.groupBy(F.col("u").alias("_at")).agg(F.min("v").alias("_least"))
    return pin(least, "least")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to its smallest neighbour instead."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _pointed(both).withColumn("_least", F.least("_at", "_least"))
    moved = both.filter("v > u").join(least, F.col("u") == F.col("_at"))
    return moved.select(F.col("v").alias("u"), F.col("_least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = _pointed(links)
    moved = links.join(least, F.col("u") == F.col("_at"))
    beside = moved.filter("v <> _least").select(F.col("v").alias("u"), F.col("_least").alias("v"))
    own = least.select(F.col("_at").alias("u"), F.col("_least").alias("v"))
    return beside.union(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    ``links`` has whole-number columns ``u`` and ``v``; their order does not matter, a link of
    a node with itself or with NULL is left out. Rounds of large and small stars roughly halve
    the depth until all links are stars; each round is stored, so a lost executor costs one
    round at most, and only two numbers per round come to the driver.
    """
    stars = pin(
        links.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        stars = pin(_small_star(_large_star(stars)), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
