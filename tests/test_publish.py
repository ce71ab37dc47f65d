import importlib
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from starloom.operators import delete_using_anti
from starloom.sinks import (
    Work,
    clean_old,
    create_empty,
    create_tables,
    finish_pending,
    pin,
    publish,
    publish_all,
    scratch_root,
    scratch_run,
    truncate_table,
    undo_pending,
)
from starloom.sinks.publish import pending, table_buckets
from starloom.sources import drop_tables, list_tables


@pytest.fixture(scope="module")
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    return "shop"


def values(spark, table):
    return sorted(r[0] for r in spark.table(table).collect())


def location(spark, table):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return Path(next(r[1] for r in rows if r[0] == "Location").removeprefix("file:"))


def test_swap_replaces_and_repeats(spark, db):
    for _ in range(2):
        publish(spark.range(5), f"{db}.swapped")
    assert values(spark, f"{db}.swapped") == [0, 1, 2, 3, 4]
    publish(spark.range(2), f"{db}.swapped")
    assert values(spark, f"{db}.swapped") == [0, 1]
    assert [t for t in list_tables(spark, db) if t.startswith("swapped")] == ["swapped"]


def test_swap_may_read_what_it_replaces(spark, db):
    publish(spark.range(5), f"{db}.self")
    publish(spark.table(f"{db}.self").filter("id > 2"), f"{db}.self")
    assert values(spark, f"{db}.self") == [3, 4]


def test_old_rows_stay_until_they_are_cleaned(spark, db):
    folders = []
    for n in (3, 4, 5):
        publish(spark.range(n), f"{db}.kept")
        folders.append(location(spark, f"{db}.kept"))
    assert all(f.exists() for f in folders)
    assert len(clean_old(spark, f"{db}.kept")) == 2
    assert [f.exists() for f in folders] == [False, False, True]
    assert values(spark, f"{db}.kept") == [0, 1, 2, 3, 4] and clean_old(spark, f"{db}.kept") == []


def test_a_reader_planned_before_the_swap_ends(spark, db):
    publish(spark.range(3), f"{db}.read")
    before = spark.table(f"{db}.read").filter("id >= 0")
    before._jdf.queryExecution().executedPlan()
    publish(spark.range(10, 14), f"{db}.read")
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    assert values(spark, f"{db}.read") == [10, 11, 12, 13]


@pytest.mark.parametrize("stop", ["SET TBLPROPERTIES", "SET LOCATION", "DROP TABLE"])
def test_a_stop_at_any_step_leaves_a_whole_table(spark, db, monkeypatch, stop):
    table = f"{db}.stopped_{stop.split()[0].lower()}_{stop.split()[1].lower()}"
    publish(spark.range(7), table)
    original = type(spark).sql

    def sql(self, text, *args, **options):
        if stop in text:
            raise RuntimeError("stopped")
        return original(self, text, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        with pytest.raises(RuntimeError):
            publish(spark.range(20, 25), table)
    expected = list(range(20, 25)) if stop == "DROP TABLE" else list(range(7))
    assert values(spark, table) == expected
    # Dropping what the stopped job left behind, and cleaning, keeps the table.
    for left in list_tables(spark, db):
        if left.startswith(f"{table.split('.')[1]}__"):
            spark.sql(f"DROP TABLE {db}.{left}")
    clean_old(spark, table)
    assert values(spark, table) == expected
    publish(spark.range(2), table)
    assert values(spark, table) == [0, 1]


def test_append_refuses_what_it_would_change(spark, db):
    money = "cast(1.567 as decimal(18,{})) as price"
    publish(spark.range(2).selectExpr(money.format(2)), f"{db}.priced")
    for other in ([money.format(3)], [money.format(2), "1 as more"], ["1 as price"]):
        with pytest.raises(ValueError, match="columns differ"):
            publish(spark.range(2).selectExpr(*other), f"{db}.priced", "append")
    assert spark.table(f"{db}.priced").count() == 2


def test_append_keeps_the_layout(spark, db):
    def rows(n):
        return spark.range(0, n, 1, 40).selectExpr("concat('s', id % 100) as song_id", "id")

    publish(rows(1000), f"{db}.laid", bucket_by=(2, ["song_id"]))
    first = len(spark.table(f"{db}.laid").inputFiles())
    publish(rows(4000), f"{db}.laid", "append")
    assert spark.table(f"{db}.laid").count() == 5000
    assert table_buckets(spark, f"{db}.laid") == (2, ["song_id"])
    assert len(spark.table(f"{db}.laid").inputFiles()) <= first + 8


def test_pins_of_a_run_go_with_it(spark):
    with scratch_run(spark) as folder:
        pinned = pin(spark.range(10), "numbers")
        assert Path(folder).exists() and all(folder in f for f in pinned.inputFiles())
    assert not Path(folder).exists()


def test_failed_job_changes_nothing(spark, db):
    publish(spark.range(3), f"{db}.safe")
    with pytest.raises(Exception):
        publish(spark.range(3).selectExpr("id + cast(raise_error('no') as bigint) as id"), f"{db}.safe")
    assert values(spark, f"{db}.safe") == [0, 1, 2]


def test_append_doubles(spark, db):
    publish(spark.range(3), f"{db}.doubled", mode="append")
    publish(spark.range(3), f"{db}.doubled", mode="append")
    assert values(spark, f"{db}.doubled") == [0, 0, 1, 1, 2, 2]


def test_bucketed_tables_join_without_a_shuffle(spark, db):
    for name in ("facts", "dims"):
        for _ in range(2):
            publish(
                spark.range(1000).selectExpr("concat('s', id % 100) as song_id", "id"),
                f"{db}.{name}",
                bucket_by=(4, ["song_id"]),
                sort_by=["song_id"],
            )
    assert table_buckets(spark, f"{db}.facts") == (4, ["song_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{db}.facts").join(spark.table(f"{db}.dims"), "song_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    publish(spark.table(f"{db}.facts").limit(10), f"{db}.facts", "append")
    assert spark.table(f"{db}.facts").count() == 1010
    with pytest.raises(ValueError, match="buckets differ"):
        publish(spark.table(f"{db}.facts"), f"{db}.facts")


def test_sorted_files_cover_ranges_and_a_hot_value_spreads(spark, db):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish(spark.range(0, 8000, 1, 8), f"{db}.ranged", sort_by=["id"])
        publish(spark.range(0, 8000, 1, 8).selectExpr("1 as k", "id"), f"{db}.hot", sort_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.table(f"{db}.ranged").groupBy(F.input_file_name()).agg(F.min("id"), F.max("id"))
    spans = sorted((low, high) for _, low, high in files.collect())
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    sizes = spark.table(f"{db}.hot").groupBy(F.input_file_name()).count().collect()
    assert sum(r[1] for r in sizes) == 8000 and max(r[1] for r in sizes) < 4000


def test_columns_must_stay(spark, db):
    publish(spark.range(3), f"{db}.typed")
    with pytest.raises(ValueError, match="columns differ"):
        publish(spark.range(3).selectExpr("cast(id as int) as id"), f"{db}.typed")


def test_create_truncate_drop(spark, db):
    schemas = {"one": T.StructType.fromDDL("a int"), "two": T.StructType.fromDDL("b string")}
    assert create_tables(spark, db, schemas, {"two": (2, ["b"])}) == ["one", "two"]
    publish(spark.createDataFrame([("x",)], "b string"), f"{db}.two", bucket_by=(2, ["b"]))
    assert create_tables(spark, db, schemas) == []
    assert spark.table(f"{db}.two").count() == 1
    truncate_table(spark, f"{db}.two")
    assert spark.table(f"{db}.two").count() == 0 and table_buckets(spark, f"{db}.two")
    folder = location(spark, f"{db}.two")
    assert drop_tables(spark, db, ["one", "two", "three"]) == ["one", "two"]
    assert not folder.exists()
    assert not {"one", "two"} & set(list_tables(spark, db))


def test_pin_goes_to_the_shared_folder(spark):
    pinned = pin(spark.range(10).selectExpr("id", "cast(null as string) as s"), "numbers")
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(scratch_root(spark) in f for f in pinned.inputFiles())
    assert pinned.count() == 10
    assert pin(spark.range(0), "none").isEmpty()


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def __init__(self, **values):
            self.get = values.get

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(**{"spark.master": "spark://host:7077"}))
    assert scratch_root(Session(**{"spark.checkpoint.dir": "s3a://b/x/"})) == "s3a://b/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(**{"spark.master": "local-cluster[2,1,1024]"}))
    own = scratch_root(Session(**{"spark.master": "local[2]"}))
    assert own == scratch_root(Session(**{"spark.master": "local"})) and Path(own).exists()


def test_null_keys_in_deletes(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    victims = spark.createDataFrame([(None,), ("a",)], "k string")
    safe = delete_using_anti(df, victims, ["k"])
    assert [r.v for r in safe.collect()] == [3]
    plain = delete_using_anti(df, victims, ["k"], null_safe=False)
    assert sorted(r.v for r in plain.collect()) == [2, 3]


# --- several tables together ------------------------------------------------------------


publishing = importlib.import_module("starloom.sinks.publish")


class Stopped(Exception):
    pass


@pytest.fixture
def several(spark):
    """Three tables with rows: two to be swapped, one of them in buckets, one appended to."""
    name = f"together_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    schema = spark.range(0).schema
    create_empty(spark, f"{name}.b", schema, (3, ["id"]), ["id"])
    for table in "abc":
        publish(spark.range(4), f"{name}.{table}", bucket_by=(3, ["id"]) if table == "b" else None)
    return name


def works(spark, db):
    rows = spark.range(10, 13)
    return [
        Work(f"{db}.a", rows, describe=lambda written: {"rows": str(written.count())}),
        Work(f"{db}.b", rows, bucket_by=(3, ["id"])),
        Work(f"{db}.c", rows, "append"),
    ]


OLD = {t: [0, 1, 2, 3] for t in "abc"}
NEW = {"a": [10, 11, 12], "b": [10, 11, 12], "c": [0, 1, 2, 3, 10, 11, 12]}


def state(spark, db):
    return {t: values(spark, f"{db}.{t}") for t in list_tables(spark, db)}


def stop_at(patch, spark, name, call):
    """Let the given call of a step of publishing fail, before or after it was done."""
    original, seen = getattr(publishing, name), []

    def step(*args, **options):
        seen.append(1)
        if len(seen) == call:
            raise Stopped
        return original(*args, **options)

    patch.setattr(publishing, name, step)


STEPS = [("_fill", n) for n in (1, 2, 3)] + [("_note", n) for n in (1, 2, 3)]
STEPS += [("_apply", n) for n in (1, 2, 3)] + [("_move_files", 1), ("_set_properties", 1)]


def test_tables_are_published_together(spark, several):
    publish_all(spark, several, works(spark, several))
    assert state(spark, several) == NEW and pending(spark, several) == (False, [])
    assert publishing.table_properties(spark, f"{several}.a")["rows"] == "3"
    assert table_buckets(spark, f"{several}.b") == (3, ["id"])
    assert finish_pending(spark, several) == [] == undo_pending(spark, several)
    publish_all(spark, several, works(spark, several))
    assert values(spark, f"{several}.c") == sorted([*NEW["c"], 10, 11, 12])


@pytest.mark.parametrize("step, call", STEPS)
@pytest.mark.parametrize("recover", [finish_pending, undo_pending])
def test_a_stop_leaves_all_old_or_all_new_tables(spark, several, monkeypatch, step, call, recover):
    with monkeypatch.context() as patch:
        stop_at(patch, spark, step, call)
        with pytest.raises(Stopped):
            publish_all(spark, several, works(spark, several))
    ready = pending(spark, several)[0]
    recover(spark, several)
    assert state(spark, several) == (NEW if ready and recover is finish_pending else OLD)
    assert pending(spark, several) == (False, [])
    # Nothing of it is in the way of the next run.
    publish_all(spark, several, works(spark, several))
    if not ready or recover is undo_pending:
        assert state(spark, several) == NEW


def test_half_moved_files_are_moved_or_taken_back(spark, several, monkeypatch):
    rows = spark.range(10, 40, 1, 3).repartition(3)
    for recover, expected in ((undo_pending, OLD["c"]), (finish_pending, [*OLD["c"], *range(10, 40)])):
        with monkeypatch.context() as patch:
            stop_at(patch, spark, "_apply", 1)
            with pytest.raises(Stopped):
                publish_all(spark, several, [Work(f"{several}.c", rows, "append")])
        change = pending(spark, several)[1][0]
        folder, own = (Path(p.removeprefix("file:")) for p in (change.folder, change.old))
        moved = sorted(folder.glob("part-*"))[0]
        moved.rename(own / moved.name)
        recover(spark, several)
        assert values(spark, f"{several}.c") == expected and not folder.exists()


def test_publishing_together_refuses_other_columns_first(spark, several):
    wrong = Work(f"{several}.b", spark.range(3).withColumnRenamed("id", "x"), bucket_by=(3, ["id"]))
    with pytest.raises(ValueError, match="columns differ"):
        publish_all(spark, several, [works(spark, several)[0], wrong])
    assert state(spark, several) == OLD and pending(spark, several) == (False, [])
