"""What the physical plans must and must not contain."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from pyspark.sql import DataFrameWriter
from starloom.plans import queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no benchmark tables")


def query(spark, name):
    return spark_entry.queries()[name](spark, SF_DIR)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pair_joins_no_python_no_single_task_windows(spark, monkeypatch):
    """In the last plan of each query and in those of the steps it stores on the way."""
    plans = []
    parquet = DataFrameWriter.parquet

    def seen(self, *args, **options):
        plans.append((name, plan(self._df)))
        return parquet(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    for name in queries.ALL:
        if not name.startswith("star_job"):  # its steps are registered one by one
            plans.append((name, plan(query(spark, name))))
    assert len(plans) > len(queries.ALL)
    for name, text in plans:
        assert not re.search(r"CartesianProduct|NestedLoop|EvalPython|InPandas|InArrow", text), name
        # The one window without a partition runs over a row per range of a sort.
        for line in text.splitlines():
            if "Exchange SinglePartition" in line and "Window" in text:
                assert "_start" in text, name


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(query(spark, "filter_equals"))
    assert "EqualTo(l_returnflag,R)" in text
    text = plan(query(spark, "topk_join_agg"))
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<s_suppkey:bigint,s_nationkey:int>" in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan(query(spark, "dup_check_window"))


def test_facts_are_counted_before_the_join(spark):
    text = plan(query(spark, "topk_join_agg"))
    join = text.index("Join")
    assert "partial_count(l_shipdate" in text[join:]


def test_latest_rows_shuffle_the_log_once(spark):
    latest = query(spark, "latest_per_key")
    latest.collect()
    assert "ReusedExchange" in plan(latest)


@pytest.mark.parametrize(
    "name", ["sort_mixed_nulls", "topk_join_agg", "dup_check_window", "dup_check_group", "star_top_artists"]
)
def test_top_k_sorts_no_more_than_k_rows(spark, name):
    assert "TakeOrderedAndProject" in plan(query(spark, name))


@pytest.mark.parametrize("name", ["dedupe_ordered", "dup_survivors", "star_artists_clean"])
def test_first_rows_are_cut_in_the_map_tasks(spark, name):
    assert plan(query(spark, name)).count("WindowGroupLimit") == 2
