"""What the whole job writes and shuffles beside its rows."""

import gzip
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators import surrogate_key
from starloom.plans import queries, star


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("volume")
    orders = spark.range(200).select(
        F.col("id").alias("o_orderkey"),
        F.lit("O").alias("o_orderstatus"),
        (F.col("id") * 1000 + 0.5).alias("o_totalprice"),
        F.lit("2-HIGH").alias("o_orderpriority"),
    )
    lines = spark.range(1000).select(
        (F.col("id") % 200).alias("l_orderkey"),
        (F.col("id") % 17).alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.lit("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        F.lit(datetime(1995, 3, 1)).cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_json_of_the_job_is_written_in_compressed_files_of_bounded_length(spark, tables, monkeypatch):
    """Plain text was most of what the job wrote."""
    seen = []
    monkeypatch.setattr(star, "run_star", lambda spark, log, catalogue, db, **options: seen.extend([log, catalogue]))
    monkeypatch.setattr(queries, "JSON_FILE_ROWS", 50, raising=False)
    queries._job(spark, tables)
    for path, count in zip(seen, (1000, 200)):
        files = list(Path(path.removeprefix("file:")).glob("part-*"))
        assert files and all(f.name.endswith(".json.gz") for f in files)
        texts = [gzip.decompress(f.read_bytes()) for f in files]
        assert max(t.count(b"\n") for t in texts) <= 50
        assert sum(t.count(b"\n") for t in texts) == count == spark.read.json(path).count()
        assert 3 * sum(f.stat().st_size for f in files) < sum(map(len, texts))


@pytest.mark.parametrize("order", [None, ["v"]])
def test_numbered_rows_are_not_shuffled_to_their_range_starts(spark, order):
    """Rows larger than what is broadcast, as those of a large table are."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    rows = spark.range(60_000).select(F.xxhash64("id").alias("v"))
    spark.conf.set(name, "64KB")
    try:
        numbered = surrogate_key(rows, order, "id", start=5)
        text = numbered._jdf.queryExecution().executedPlan().toString()
        found = numbered.collect()
    finally:
        spark.conf.set(name, before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted(r.id for r in found) == list(range(5, 60_005))
    if order:
        assert [r.v for r in sorted(found, key=lambda r: r.id)] == sorted(r.v for r in found)
