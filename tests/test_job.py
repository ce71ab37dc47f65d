import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from golden import write_golden
from starloom import job
from starloom.plans import star
from starloom.sinks.publish import table_buckets


def call(spark, *words):
    job.run(spark, job.parser().parse_args(words))


def test_create_load_check_report(spark, tmp_path, capsys):
    log, catalogue = write_golden(tmp_path)
    call(spark, "create", "--db", "cli")
    assert {t.name for t in spark.catalog.listTables("cli")} == {
        "staging_events", "staging_songs", "songplays", "users", "songs", "artists", "time",
    }
    call(spark, "load", "--db", "cli", "--log", log, "--catalogue", catalogue, "--unordered-ids")
    out = capsys.readouterr().out
    assert "users: [(2, 2), (2, 2)]" in out and "time: no duplicates" in out
    assert "repaired: artists, songs" in out
    assert "('Band One', 4)\n('Band One feat. Guest', 3)\n('Solo', 3)\n" in out
    ids = sorted(r[0] for r in spark.table("cli.songplays").select("songplay_id").collect())
    assert ids == list(range(1, 8))

    call(spark, "check", "--db", "cli")
    assert "artists: no duplicates" in capsys.readouterr().out
    call(spark, "report", "--db", "cli", "--mode", "unique")
    assert capsys.readouterr().out.count("\n") <= 5

    call(spark, "create", "--db", "cli")
    assert spark.table("cli.songplays").isEmpty()


def test_the_command_starts_from_any_folder(tmp_path):
    """As documented, in a process of its own that does not know the package."""
    log, catalogue = write_golden(tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, str(Path(job.__file__)), "load", "--db", "own"]
    done = subprocess.run(
        [*command, "--log", log, "--catalogue", catalogue],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "repaired: artists, songs" in done.stdout and "('Band One', 4)" in done.stdout
    asked = subprocess.run([*command[:2], "--help"], cwd=tmp_path, env=env, capture_output=True, timeout=120)
    assert asked.returncode == 0


def test_load_after_create_with_other_options(spark, tmp_path, capsys):
    log, catalogue = write_golden(tmp_path)
    call(spark, "create", "--db", "cli_layout", "--buckets", "4")
    assert table_buckets(spark, "cli_layout.songplays") == (4, ["song_id"])
    load = ["load", "--db", "cli_layout", "--log", log, "--catalogue", catalogue]
    call(spark, *load, "--buckets", "16", "--scale", "5")
    assert table_buckets(spark, "cli_layout.songplays") == (16, ["song_id"])
    assert spark.table("cli_layout.songplays").count() == 6
    assert "users_key: 1 rows" in capsys.readouterr().out
    # Tables with rows keep their columns: refused before anything is written.
    before = {t: spark.table(f"cli_layout.{t}").count() for t in star.STAR}
    for options in (["--scale", "0"], ["--append", "--scale", "0"]):
        with pytest.raises(ValueError, match="columns differ"):
            call(spark, *load, *options)
    assert {t: spark.table(f"cli_layout.{t}").count() for t in star.STAR} == before
    call(spark, "truncate", "--db", "cli_layout")
    assert all(spark.table(f"cli_layout.{t}").isEmpty() for t in star.STAR)
    call(spark, "clean", "--db", "cli_layout")


def test_tolerant_load_sets_rows_aside(spark, tmp_path, capsys):
    log, catalogue = write_golden(tmp_path)
    file = next(p for p in Path(log).rglob("*") if p.is_file() and p.read_text().strip())
    lines = file.read_text().splitlines()
    play = next(json.loads(text) for text in lines if json.loads(text)["page"] == "NextSong")
    file.write_text("\n".join([*lines, json.dumps({**play, "userId": "who?"}), json.dumps({**play, "userId": ""}), '{"broken": ']))
    song = next(p for p in Path(catalogue).rglob("*.json") if json.loads(p.read_text())["song_id"] == "SO7")
    document = {**json.loads(song.read_text()), "song_id": "SO70"}
    song.write_text(
        song.read_text()
        + "\n" + json.dumps({**document, "duration": "abc"})
        + "\n" + json.dumps({**document, "title": "t" * 257})
    )
    load = ["load", "--db", "cli_tolerant", "--log", log, "--catalogue", catalogue]
    with pytest.raises(Exception):
        call(spark, *load)
    call(spark, *load, "--tolerant")
    out = capsys.readouterr().out
    assert "rejected_lines: 4 rows" in out and "rejected_plays: " in out
    rejected = spark.table("cli_tolerant.rejected_lines").collect()
    problems = [tuple(p) for r in rejected for p in r.problems]
    assert sorted((c, v[:3], p) for c, v, p in problems) == [
        ("duration", "abc", "does not fit decimal(18,0)"),
        ("title", "ttt", "longer than 256"),
        ("userId", "who", "does not fit int"),
    ]
    assert {r.user_id for r in spark.table("cli_tolerant.rejected_plays").collect()} == {None}
    assert [r.line for r in rejected if not r.problems] == ['{"broken": ']
    assert spark.table("cli_tolerant.songplays").count() == 7
    songs = {r.song_id for r in spark.table("cli_tolerant.songs").collect()}
    assert "SO7" in songs and "SO70" not in songs
