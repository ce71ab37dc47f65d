"""One key holds a third of the rows: results stay whole and the work stays spread."""

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from starloom.operators import (
    count_per_key,
    dedupe_ordered,
    delete_using_anti,
    dup_check_window,
    dup_survivors,
    join_natural_key,
    latest_per_key,
    numbering,
    repeated_keys,
    row_number_per_key,
    surrogate_key,
    topk_join_agg,
)

ROWS = 30_000


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_scale(spark):
    """Thresholds shrunk to the test data, so that joins shuffle and hot partitions split."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Key 'hot' on a third of the rows, NULL on some, the rest on 500 keys."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 31 != 0, F.concat(F.lit("k"), (i % 500).cast("string")))
    spark.range(0, ROWS, 1, 8).select(
        key.alias("key"), (i * 7919 % 1000).alias("value"), i.alias("id")
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rows(hot):
    return [tuple(r) for r in hot.collect()]


def test_count_per_key(spark, hot, rows):
    sizes = Counter(k for k, _, _ in rows)
    with small_scale(spark):
        counted = count_per_key(hot, ["key"])
        assert "skew=true" in final_plan(counted)
    found = [tuple(r) for r in counted.collect()]
    assert sorted(map(repr, found)) == sorted(repr((k, v, i, sizes[k])) for k, v, i in rows)


def test_natural_key_join_splits_the_hot_partition(spark, hot, rows):
    names = sorted({k for k, _, _ in rows if k})
    catalogue = spark.createDataFrame([(n, len(n)) for n in [*names, "hot"]], "title string, size int")
    with small_scale(spark):
        joined = join_natural_key(hot, catalogue, [("key", "title")])
        assert "skew=true" in final_plan(joined)
        found = Counter(r.id for r in joined.collect())
    assert found == Counter({i: 2 if k == "hot" else 1 for k, _, i in rows if k})


def test_anti_join_splits_the_hot_partition(spark, hot, rows):
    victims = spark.createDataFrame([("k1",), (None,), ("k1",)], "key string")
    with small_scale(spark):
        kept = delete_using_anti(hot, victims, ["key"])
        assert "skew=true" in final_plan(kept)
        found = sorted(r.id for r in kept.collect())
    assert found == sorted(i for k, _, i in rows if k not in ("k1", None))


def test_delete_by_repeated_keys_splits_the_hot_partition(spark, hot, rows):
    sizes = Counter(k for k, _, _ in rows)
    for null_safe in (True, False):
        with small_scale(spark):
            kept = delete_using_anti(hot, repeated_keys(hot, ["key"]), ["key"], null_safe)
            assert "skew=true" in final_plan(kept)
            found = sorted(r.id for r in kept.collect())
        assert found == sorted(
            i for k, _, i in rows if sizes[k] == 1 or (k is None and not null_safe)
        )


def by_value(rows):
    groups = {}
    for k, v, i in rows:
        groups.setdefault(k, []).append((v, i))
    return {k: sorted(g) for k, g in groups.items()}


def largest_share(df):
    """Share of the rows in the fullest task of the stage that returns them."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_counts_and_numbers_spread_at_default_settings(spark, tmp_path):
    """A third of the rows on one key and no option set: no task has the whole key."""
    path = str(tmp_path / "rows")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    spark.range(0, 600_000, 1, 8).select(key.alias("key"), "id").write.parquet(path)
    rows = spark.read.parquet(path)
    with settings(spark, spark__sql__shuffle__partitions="8"):
        assert largest_share(count_per_key(rows, ["key"])) < 0.3
        assert largest_share(row_number_per_key(rows, ["key"], ["id"])) < 0.3


@pytest.mark.parametrize("hot_rows", [numbering.HOT_ROWS, 5_000, 100])
def test_row_numbers(hot, rows, monkeypatch, hot_rows):
    monkeypatch.setattr(numbering, "HOT_ROWS", hot_rows)
    expected = {
        (k, v, i, n) for k, g in by_value(rows).items() for n, (v, i) in enumerate(g, 1)
    }
    numbered = row_number_per_key(hot, ["key"], ["value", "id"])
    assert dict(numbered.dtypes)["row_number"] == "bigint"
    found = [tuple(r) for r in numbered.collect()]
    assert len(found) == ROWS
    assert set(found) == expected


def test_row_numbers_write_hot_keys_only(spark, hot, rows, monkeypatch):
    written = {}
    original = numbering.pin

    def keep(df, label):
        written[label] = original(df, label)
        return written[label]

    monkeypatch.setattr(numbering, "pin", keep)
    row_number_per_key(hot, ["key"], ["value", "id"])
    assert set(written) == {"hot"} and written["hot"].isEmpty()
    monkeypatch.setattr(numbering, "HOT_ROWS", 5_000)
    row_number_per_key(hot, ["key"], ["value", "id"])
    sizes = Counter(k for k, _, _ in rows)
    assert written["tagged"].count() == written["placed"].count() == sizes["hot"]


def test_surrogate_key_is_dense_in_order(hot, rows):
    keyed = surrogate_key(hot, [("value", "desc", "last"), "id"], "row_id", start=5)
    expected = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert [tuple(r) for r in keyed.orderBy("row_id").collect()] == [
        (n, *r) for n, r in enumerate(expected, 5)
    ]


@pytest.mark.parametrize("stable_input", [True, False])
def test_copies_are_numbered_by_several_tasks(spark, monkeypatch, stable_input):
    """All rows equal and from one task: ranges of the sort columns alone would be one."""
    pinned = []
    original = numbering.pin

    def keep(df, label):
        pinned.append(original(df, label))
        return pinned[-1]

    monkeypatch.setattr(numbering, "pin", keep)
    copies = spark.range(0, 20_000, 1, 1).select(F.lit("same").alias("key"))
    keyed = surrogate_key(copies, ["key"], "row_id", stable_input=stable_input)
    assert sorted(r.row_id for r in keyed.collect()) == list(range(1, 20_001))
    assert len(pinned) == (1 if stable_input else 2)
    parts = pinned[-1].groupBy(F.shiftright("_place", 33)).count().collect()
    assert len(parts) == 4 and max(p["count"] for p in parts) < 10_000


def test_dedupe_cuts_keys_before_the_shuffle(hot, rows):
    first = dedupe_ordered(hot, ["key"], ["value", "id"])
    assert sorted(map(repr, (tuple(r) for r in first.collect()))) == sorted(
        repr((k, *g[0])) for k, g in by_value(rows).items()
    )
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange hashpartitioning") :]


def test_survivors_need_one_shuffle(hot, rows):
    kept = dup_survivors(hot, ["key"], ["value", "id"])
    initial = kept._jdf.queryExecution().executedPlan().toString()
    assert initial.count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in kept.collect()} == {
        (k, *g[0]) for k, g in by_value(rows).items() if len(g) > 1
    }


@pytest.mark.parametrize("limit", [1, 5, 20, 10_050])
def test_duplicate_check_takes_rows_not_keys(hot, rows, limit):
    sizes = Counter(k for k, _, _ in rows)
    lines = sorted(
        ((sizes[k], k) for k, _, _ in rows), key=lambda r: (-r[0], r[1] is None, r[1] or "")
    )[:limit]
    found = [tuple(r) for r in dup_check_window(hot, ["key"], limit).collect()]
    assert found == [r for r in lines if r[0] > 1]


def test_latest_row_of_a_hot_key(spark, hot, rows):
    latest = latest_per_key(hot, ["key"], "value", ["id"])
    tops = {k: g[-1][0] for k, g in by_value(rows).items()}
    assert {tuple(r) for r in latest.collect()} == {
        (k, i) for k, v, i in rows if k is not None and v == tops[k]
    }


def test_top_k_counts_before_joining(spark, hot, rows):
    dim = spark.createDataFrame(
        [("hot", "A"), ("hot", "B"), ("hot", "B"), ("k1", "A"), (None, "A")],
        "key string, name string",
    )
    sizes = Counter(k for k, _, _ in rows)
    top = topk_join_agg(hot, dim, ("key", "key"), "name", "id")
    assert [tuple(r) for r in top.collect()] == [
        ("B", 2 * sizes["hot"]),
        ("A", sizes["hot"] + sizes["k1"]),
    ]
    unique = topk_join_agg(hot, dim, ("key", "key"), "name", "id", mode="unique")
    assert [tuple(r) for r in unique.collect()] == [("A", sizes["hot"] + sizes["k1"])]
