"""Catalogue lookups and table removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from starloom.sinks.publish import drop_table


def list_tables(spark: SparkSession, db: str) -> list[str]:
    """Distinct table names of one database."""
    return sorted({t.name for t in spark.catalog.listTables(db) if not t.isTemporary})


def drop_tables(spark: SparkSession, db: str, tables: Sequence[str]) -> list[str]:
    """Drop the named tables where they exist, files of replaced rows included; returns those
    that did."""
    found = [t for t in tables if spark.catalog.tableExists(f"{db}.{t}")]
    for name in found:
        drop_table(spark, f"{db}.{name}")
    return found
