"""Every registered query against its SQL, whole tables, values and types."""

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from starloom.plans import oracle, queries
from compare import connect, duck_rows, duck_types, spark_rows, spark_types

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries.ALL) == set(oracle.ALL)
    assert set(queries.ALL) <= set(spark_entry.queries())
    assert set(oracle.ALL) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_query_equals_sql(spark, con, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    sql = spark_entry.oracle_sql()[name]
    assert spark_types(df) == duck_types(con, sql)
    assert spark_rows(df) == duck_rows(con, sql)


# Reports that come sorted, with a column that falls from row to row.
ORDERED = {
    "topk_join_agg": ["num_plays"],
    "topk_join_agg_fanout": ["num_plays"],
    "topk_join_agg_unique": ["num_plays"],
    "star_top_artists": ["num_plays"],
    "star_top_artists_clean": ["num_plays"],
    "star_top_artists_unique": ["num_plays"],
    "dup_check_window": ["num_duplicates"],
    "dup_check_group": ["num_duplicates"],
    "sort_mixed_nulls": [],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_top_rows_come_in_order(spark, con, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    found = [tuple(r) for r in df.collect()]
    result = con.execute(oracle.ALL[name])
    columns = [d[0] for d in result.description]
    picked = [columns.index(c) for c in df.columns]
    assert found == [tuple(row[i] for i in picked) for row in result.fetchall()]
    for c in ORDERED[name]:
        values = [row[df.columns.index(c)] for row in found]
        assert values == sorted(values, reverse=True)


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 5


def test_results_do_not_depend_on_the_session_time_zone(spark, con):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("epoch_to_timestamp", "calendar_parts", "dim_time", "star_songplays"):
            df = spark_entry.queries()[name](spark, SF_DIR)
            assert spark_rows(df) == duck_rows(con, spark_entry.oracle_sql()[name]), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
