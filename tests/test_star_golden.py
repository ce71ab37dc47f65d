"""The whole job on the mini warehouse, against hand-computed rows."""

import importlib
from datetime import datetime

import pytest

from golden import write_golden
from starloom.plans import star
from starloom.sources import list_tables


def at(minute, second):
    return datetime(2001, 9, 9, 1, minute, second)


EXACT_PLAYS = [
    (at(46, 40), 1, "free", "SO1", "AR1", "1"),
    (at(46, 40), 1, "free", "SO3", "AR1", "1"),
    (at(46, 40), 1, "free", "SO5", "AR3", "1"),
    (at(46, 50), 2, "free", "SO4", "AR2", "2"),
    (at(46, 50), 2, "free", "SO4", "AR2", "2"),
    (at(46, 50), 2, "paid", "SO2", "AR1", "2"),
]
PLAY_COLUMNS = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id"]


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return write_golden(tmp_path_factory.mktemp("golden"))


@pytest.fixture(scope="module")
def whole(spark, paths):
    return star.run_star(spark, *paths, db="golden_whole", ordered_ids=True)


@pytest.fixture(scope="module")
def exact(spark, paths):
    return star.run_star(
        spark, *paths, db="golden_exact", scale=5, remove_duplicates=False, drop_staging=False
    )


def test_plays_exact_durations(exact):
    assert rows(exact.tables["songplays"], *PLAY_COLUMNS) == sorted(EXACT_PLAYS, key=repr)


def test_plays_whole_durations_are_cut_not_rounded(whole):
    extra = (at(47, 20), 3, "free", "SO9", "AR2", "4")
    expected = sorted([*EXACT_PLAYS, extra], key=repr)
    assert rows(whole.tables["songplays"], *PLAY_COLUMNS) == expected


def test_play_ids_are_dense_and_follow_time(whole):
    plays = whole.tables["songplays"].orderBy("songplay_id").collect()
    assert [p.songplay_id for p in plays] == list(range(1, 8))
    assert [p.start_time for p in plays] == sorted(p.start_time for p in plays)


def test_users_keep_ties(whole):
    assert rows(whole.tables["users"], "user_id", "level") == [
        (1, "paid"), (2, "free"), (2, "paid"), (3, "free"),
    ]


def test_songs_without_sentinel_year(whole):
    assert rows(whole.tables["songs"], "song_id", "year") == [
        ("SO1", 2001), ("SO2", None), ("SO3", 2003), ("SO4", None),
        ("SO5", 2010), ("SO6", 1999), ("SO7", 1999), ("SO9", 2015),
    ]
    assert whole.sentinels == 2


def test_artists_before_and_after_repair(exact, whole):
    assert exact.tables["artists"].count() == 7
    kept = {
        (a, n, loc, None if lat is None else int(lat), None if lon is None else int(lon))
        for a, n, loc, lat, lon in rows(whole.tables["artists"])
    }
    assert kept == {
        ("AR1", "Band One", "Oslo", 59, 10),
        ("AR1", "Band One feat. Guest", "Oslo", 59, 10),
        ("AR2", "Solo", "", None, None),
        ("AR3", "Band One", None, 1, 1),
        ("AR4", None, "X", 5, 5),
    }


def test_artists_repair_keeps_fractions(exact):
    found = rows(star.clean_artists(exact.tables["artists"]), "artist_id", "name", "latitude")
    assert [(a, n, None if v is None else float(v)) for a, n, v in found] == [
        ("AR1", "Band One feat. Guest", 59.9),
        ("AR1", "Band One", 59.9),
        ("AR2", "Solo", None),
        ("AR3", "Band One", 1.0),
        ("AR4", None, 5.0),
    ]


def test_time(whole):
    expected = [
        (at(m, s), 1, 9, 36, 9, 2001, 0)
        for m, s in [(46, 40), (46, 45), (46, 50), (47, 0), (47, 10), (47, 20)]
    ]
    assert rows(whole.tables["time"]) == sorted(expected, key=repr)


def test_duplicate_reports(whole):
    found = {name: [tuple(r) for r in found] for name, found in whole.duplicates.items()}
    assert found == {
        "users": [(2, 2), (2, 2)],
        "songs": [],
        "artists": [(2,), (2,), (2,), (2,)],
        "time": [],
        "songplays": [(3, at(46, 40)), (3, at(46, 50))],
    }
    assert whole.repaired == ["artists", "songs"]


def test_top_artists(exact, whole):
    def top(plays, table):
        return [tuple(r) for r in star.top_artists(plays, table).collect()]

    plays, table = exact.tables["songplays"], exact.tables["artists"]
    assert top(plays, table) == [("Band One", 7), ("Band One feat. Guest", 3), ("Solo", 2)]
    assert top(plays, star.clean_artists(table)) == [
        ("Band One", 4), ("Band One feat. Guest", 3), ("Solo", 2),
    ]
    assert top(whole.tables["songplays"], whole.tables["artists"]) == [
        ("Band One", 4), ("Band One feat. Guest", 3), ("Solo", 3),
    ]
    unique = star.top_artists(plays, table, mode="unique").collect()
    assert sum(r.num_plays for r in unique) == plays.count()


def test_published_tables_answer_plain_sql(spark, whole):
    found = spark.sql(
        """
        SELECT a.name, count(p.start_time) AS plays
        FROM golden_whole.songplays p JOIN golden_whole.artists a USING (artist_id)
        GROUP BY a.name ORDER BY plays DESC, a.name LIMIT 5
        """
    )
    top = star.top_artists(whole.tables["songplays"], whole.tables["artists"])
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in top.collect()]


def test_staging_dropped_or_kept(spark, whole, exact):
    assert list_tables(spark, "golden_whole") == sorted(star.STAR)
    assert set(star.STAGING) <= set(list_tables(spark, "golden_exact"))


def test_key_audits(exact):
    audits = star.key_audits(exact.tables)
    assert audits["songplays_key"].count() == 0
    assert rows(audits["users_key"]) == [(2, 2)]
    assert rows(audits["artists_key"]) == [("AR1", 3), ("AR4", 2)]
    assert list(audits["songplays_required"].first()) == [0] * 5


def test_second_run_gives_the_same_tables(spark, paths, whole):
    before = {n: rows(t) for n, t in whole.tables.items()}
    again = star.run_star(spark, *paths, db="golden_whole", ordered_ids=True)
    assert {n: rows(t) for n, t in again.tables.items()} == before


def test_appending_twice_doubles_and_is_reported(spark, paths, monkeypatch):
    def scanned(plays):
        raise AssertionError("the ids of the published plays were read")

    monkeypatch.setattr(star, "_scan_last_id", scanned)
    star.run_star(spark, *paths, db="golden_twice")
    second = star.run_star(spark, *paths, db="golden_twice", append=True)
    assert second.tables["time"].count() == 12
    assert [r.num_duplicates for r in second.duplicates["time"]] == [2] * 5
    ids = [r[0] for r in rows(second.tables["songplays"], "songplay_id")]
    assert sorted(ids) == list(range(1, 15))


def test_last_id_is_scanned_if_the_note_does_not_fit(spark, paths):
    star.run_star(spark, *paths, db="golden_note")
    table = "golden_note.songplays"
    assert star._last_id(spark, table) == 7
    plan = spark.table(table).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    # Rows that another program has added.
    spark.sql(f"INSERT INTO {table} SELECT songplay_id + 100, * EXCEPT (songplay_id) FROM {table}")
    assert star._last_id(spark, table) == 107
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('{star.LAST_ID}')")
    assert star._last_id(spark, table) == 107


def test_any_audited_dimension_is_repaired_on_request(spark, paths):
    run = star.run_star(spark, *paths, db="golden_repair", repair=["users", "songs", "artists", "time"])
    assert rows(run.tables["users"], "user_id", "level") == [(1, "paid"), (2, "free"), (3, "free")]
    assert run.repaired == ["users", "artists", "songs"]
    assert [tuple(r) for r in run.duplicates["users"]] == [(2, 2), (2, 2)]
    assert run.audits["users_key"] == run.audits["songs_key"] == run.audits["time_key"] == 0
    first = {name: rows(run.tables[name]) for name in ("users", "songs", "time")}
    # Copies that an append brings are repaired in the whole table.
    again = star.run_star(spark, *paths, db="golden_repair", append=True, repair=["users", "songs", "time"])
    assert again.repaired == ["users", "songs", "time"]
    assert {name: rows(again.tables[name]) for name in first} == first
    # Not asked for this time: five rows left by the first load, seven new ones.
    assert again.tables["artists"].count() == 5 + 7
    assert rows(again.tables["songs"], "song_id", "year")[1] == ("SO2", None)
    with pytest.raises(ValueError, match="no rule"):
        star.run_star(spark, *paths, db="golden_repair", repair=["songplays"])


def test_each_key_is_grouped_once(spark, whole, monkeypatch):
    """Reports and audits of users, songs and time read stored suspects, not the tables."""
    suspects = star.shared_suspects(whole.tables)
    checks = {**star.duplicate_checks(whole.tables, suspects), **star.key_audits(whole.tables, suspects)}
    for name in ("users", "songs", "time"):
        for check in (checks[name], checks[f"{name}_key"]):
            assert all("suspects" in f for f in check.inputFiles())
    plain = {**star.duplicate_checks(whole.tables), **star.key_audits(whole.tables)}
    assert {n: rows(c) for n, c in checks.items()} == {n: rows(c) for n, c in plain.items()}


STOPS = [("_fill", 1, False), ("_fill", 4, False), ("_note", 2, False)]
STOPS += [("_apply", n, False) for n in (1, 2, 3, 4, 5)] + [("_fill", 5, True), ("_apply", 3, True)]


@pytest.mark.parametrize("step, call, append", STOPS)
def test_a_stopped_job_leaves_five_old_or_five_new_tables(spark, paths, monkeypatch, step, call, append):
    publishing = importlib.import_module("starloom.sinks.publish")
    db = f"golden_stop_{step}_{call}_{append}".lower()
    if append:
        star.run_star(spark, *paths, db=db, remove_duplicates=False)
    old = {n: spark.table(f"{db}.{n}").count() if append else 0 for n in star.STAR}
    original, seen = getattr(publishing, step), []

    def stop(*args, **options):
        # Publishing the staging tables counts only from the star tables on.
        noted = step == "_note" or any(f".{n}" in str(args) for n in star.STAR)
        seen.extend([1] if noted else [])
        if noted and len(seen) == call:
            raise KeyboardInterrupt
        return original(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(publishing, step, stop)
        with pytest.raises(KeyboardInterrupt):
            star.run_star(spark, *paths, db=db, append=append, remove_duplicates=False)
    publishing.finish_pending(spark, db)
    now = {n: spark.table(f"{db}.{n}").count() for n in star.STAR}
    loaded = {"songplays": 7, "users": 4, "songs": 8, "artists": 7, "time": 6}
    new = {n: old[n] + loaded[n] for n in star.STAR}
    assert now == (new if step == "_apply" else old)
