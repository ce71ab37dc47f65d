"""The star schema: its tables, its audits and the job that builds it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.columns import epoch_to_timestamp, null_if_sentinel
from starloom.operators import (
    dedupe_ordered,
    dim_distinct,
    dim_time,
    dq_max_length,
    dq_not_null,
    dq_unique,
    dup_check_group,
    dup_check_window,
    fact_build,
    latest_per_key,
    require_not_null,
    sentinel_probe,
    surrogate_key,
    suspect_keys,
    topk_join_agg,
)
from starloom.plans import schemas
from starloom.sinks.publish import (
    Bucketing,
    Work,
    check_layout,
    create_empty,
    drop_table,
    finish_pending,
    publish,
    publish_all,
    table_buckets,
    table_properties,
)
from starloom.sinks.scratch import scratch_run
from starloom.sources import (
    drop_tables,
    path_mapping,
    read_json_auto,
    read_json_mapped,
    read_path_mapping,
    read_with_rejects,
)

STAGING = ("staging_events", "staging_songs")
STAR = ("songplays", "users", "songs", "artists", "time")

# The most complete record first: known coordinates, then a known location.
ARTIST_KEYS = ["artist_id", "name"]
ARTIST_ORDER = [
    ("latitude", "asc", "last"),
    ("longitude", "asc", "last"),
    ("location", "desc", "last"),
]

# What a dimension's rows are repaired by: key, and which row of a key stays, the others by
# every column so that the result does not depend on their order.
REPAIRS = {
    "users": (["user_id"], ["level", "last_name", "first_name", "gender"]),
    "songs": (["song_id"], [("year", "desc", "last"), "title", "artist_id", "duration"]),
    "artists": (ARTIST_KEYS, ARTIST_ORDER),
    "time": (["start_time"], ["hour"]),
}

# Table property with the last id given to a play.
LAST_ID = "starloom.last_id"

# Plays per bucket, where the caller does not say how many buckets.
BUCKET_ROWS = 4_000_000

# Stable order of the plays for their ids.
PLAY_ORDER = ["start_time", "user_id", "session_id", "song_id", "artist_id"]


def layout(buckets: int) -> dict[str, tuple[int, list[str]]]:
    """Tables stored in buckets; the other dimensions are small enough to broadcast."""
    return {name: (buckets, ["song_id"]) for name in ("songplays", "songs")}


def songplays(events: DataFrame, songs: DataFrame) -> DataFrame:
    """Plays matched to the catalogue by title, artist name and duration."""
    return fact_build(
        events,
        songs,
        on=[("song", "title"), ("artist", "artist_name"), ("length", "duration")],
        where=F.col("page") == schemas.PLAY_PAGE,
        cols={
            "start_time": epoch_to_timestamp(events["ts"]),
            "user_id": events["userId"],
            "level": events["level"],
            "song_id": songs["song_id"],
            "artist_id": songs["artist_id"],
            "session_id": events["sessionId"].cast("string"),
            "location": events["location"],
            "user_agent": events["userAgent"],
        },
    )


def users(events: DataFrame) -> DataFrame:
    """Each user as of the latest event on any page; ties that differ stay."""
    names = {"firstName": "first_name", "lastName": "last_name"}
    latest = latest_per_key(events, ["userId"], "ts", ["firstName", "lastName", "gender", "level"])
    return latest.withColumnsRenamed({"userId": "user_id", **names})


def songs(catalogue: DataFrame) -> DataFrame:
    columns = ["song_id", "title", "artist_id", "year", "duration"]
    return dim_distinct(catalogue, {c: c for c in columns}, not_null=["song_id"])


def artists(catalogue: DataFrame) -> DataFrame:
    """Distinct artist rows; an id may still have several names or places."""
    return dim_distinct(
        catalogue,
        {
            "artist_id": "artist_id",
            "artist_name": "name",
            "artist_location": "location",
            "artist_latitude": "latitude",
            "artist_longitude": "longitude",
        },
        not_null=["artist_id"],
    )


def time(events: DataFrame) -> DataFrame:
    return dim_time(events, "ts")


def clean_artists(table: DataFrame) -> DataFrame:
    """One row per artist id and name."""
    return dedupe_ordered(table, ARTIST_KEYS, ARTIST_ORDER)


def clean_songs(table: DataFrame) -> DataFrame:
    """Year 0 stands for an unknown year."""
    return null_if_sentinel(table, "year")


def top_artists(plays: DataFrame, table: DataFrame, k: int = 5, mode: str = "reference") -> DataFrame:
    """Most played artist names."""
    return topk_join_agg(
        plays,
        table,
        on=("artist_id", "artist_id"),
        group="name",
        count_col="start_time",
        k=k,
        mode=mode,
        dim_order=ARTIST_ORDER,
        name="num_plays",
    )


def shared_suspects(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The suspect keys of the tables whose duplicate report and key audit look at one key, so
    that each of them is grouped once."""
    keys = {"users": ["user_id"], "songs": ["song_id"], "time": ["start_time"]}
    return {name: suspect_keys(tables[name], key) for name, key in keys.items() if name in tables}


def duplicate_checks(
    tables: dict[str, DataFrame], suspects: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The bounded duplicate report of each of the given star tables."""
    known = (suspects or {}).get
    checks = {
        "users": lambda t: dup_check_window(t, ["user_id"], limit=5, suspects=known("users")),
        "songs": lambda t: dup_check_window(t, ["song_id"], limit=5, suspects=known("songs")),
        "artists": lambda t: dup_check_window(t, ARTIST_KEYS, limit=20, out_cols=[]),
        "time": lambda t: dup_check_group(t, ["start_time"], suspects=known("time")),
        "songplays": lambda t: dup_check_group(t, ["start_time"], count_col="songplay_id"),
    }
    return {name: check(tables[name]) for name, check in checks.items() if name in tables}


def key_audits(
    tables: dict[str, DataFrame], suspects: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Declared keys and required columns, which Parquet tables do not enforce."""
    known = {n: s.withColumnRenamed("_rows", "num_rows") for n, s in (suspects or {}).items()}
    keys = {
        "songplays": "songplay_id",
        "users": "user_id",
        "songs": "song_id",
        "artists": "artist_id",
        "time": "start_time",
    }
    audits = {
        f"{name}_key": known[name] if name in known else dq_unique(tables[name], [key])
        for name, key in keys.items()
    }
    return audits | {"songplays_required": dq_not_null(tables["songplays"], schemas.REQUIRED)}


@dataclass
class StarRun:
    """What a run left behind: the published tables and what its checks found."""

    tables: dict[str, DataFrame]
    duplicates: dict[str, list] = field(default_factory=dict)
    repaired: list[str] = field(default_factory=list)
    sentinels: int = 0
    # Rows per audit that break a declared key or have NULL in a required column.
    audits: dict[str, int] = field(default_factory=dict)
    # Rows a tolerant load set aside, per table that holds them.
    rejected: dict[str, int] = field(default_factory=dict)


REJECTED_LINES, REJECTED_PLAYS = "rejected_lines", "rejected_plays"


def load_staging(
    spark: SparkSession,
    log_path: str,
    catalogue_path: str,
    db: str,
    log_paths_file: str | None = None,
    scale: int = 0,
    mode: str = "FAILFAST",
) -> dict[str, DataFrame]:
    """Parse both JSON sets once into staging tables.

    The five builds read only the columns they need from Parquet; straight from JSON
    each of them would parse the whole text again. ``PERMISSIVE`` stores broken lines, and those
    with values that do not fit or are too long, in the table ``rejected_lines`` with what is
    wrong with them; any other mode fails on them.
    """
    event_schema, song_schema = schemas.staging_events(scale), schemas.staging_songs(scale)
    if log_paths_file:
        mapping = read_path_mapping(spark, log_paths_file, event_schema)
    else:
        mapping = path_mapping([f"$['{f.name}']" for f in event_schema.fields], event_schema)
    if mode == "PERMISSIVE":
        own_names = [(f.name, f.name, f.dataType) for f in song_schema.fields]
        limits = [schemas.text_lengths(t, schemas.EVENT_LENGTHS) for t in (event_schema, song_schema)]
        events, bad_events = read_with_rejects(spark, log_path, mapping, lengths=limits[0])
        songs_, bad_songs = read_with_rejects(spark, catalogue_path, own_names, lengths=limits[1])
        publish(bad_events.unionByName(bad_songs), f"{db}.{REJECTED_LINES}")
    else:
        events = read_json_mapped(spark, log_path, mapping, mode=mode)
        songs_ = read_json_auto(spark, catalogue_path, song_schema, mode=mode)
    loads = {"staging_events": (events, event_schema), "staging_songs": (songs_, song_schema)}
    for name, (frame, schema) in loads.items():
        typed = frame.select([F.col(f.name).cast(f.dataType) for f in schema.fields])
        _make_room(spark, f"{db}.{name}", typed)
        publish(typed, f"{db}.{name}")
    staged = {name: spark.table(f"{db}.{name}") for name in loads}
    if mode == "FAILFAST":
        for name, (_, schema) in loads.items():
            limits = schemas.text_lengths(schema, schemas.EVENT_LENGTHS)
            over = dq_max_length(staged[name], limits).first().asDict()
            too_long = {column: n for column, n in over.items() if n}
            if too_long:
                raise ValueError(f"values of {name} exceed their declared length: {too_long}")
    return staged


def _make_room(
    spark: SparkSession, table: str, frame: DataFrame, bucket_by: Bucketing | None = None
) -> None:
    """Refuse rows an existing table cannot take. One without rows, as ``create`` leaves it,
    is dropped and gets the new columns and buckets."""
    if not spark.catalog.tableExists(table):
        return
    try:
        check_layout(frame, table, bucket_by)
    except ValueError:
        if not spark.table(table).isEmpty():
            raise
        drop_table(spark, table)


def run_star(spark: SparkSession, log_path: str, catalogue_path: str, db: str, **options) -> StarRun:
    """Load, build, check, repair and publish; a second run gives the same tables.

    Options: ``log_paths_file`` maps the log's paths; ``scale`` decimal digits are kept;
    ``buckets`` of plays and songs (default: those of the tables, or by the number of plays);
    ``repair``: dimensions of which rows with a repeated key are removed if their duplicate
    report finds any (default artists only); ``load_mode`` FAILFAST, or PERMISSIVE to set lines with an error and incomplete plays aside
    in tables of their own; ``append=True`` adds this load's rows to the star tables instead of
    replacing them; ``ordered_ids=True`` numbers the plays in a fixed order, which sorts the
    fact, otherwise as they lie; ``remove_duplicates``, ``clean_sentinels`` and
    ``drop_staging`` (all True).

    All five tables are checked for columns and buckets before the first is written, and all
    five are written before the first is changed. Changes that a stopped run has left are
    completed first. Intermediate results are gone when the run ends.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    finish_pending(spark, db)
    with scratch_run(spark):
        return _run(spark, log_path, catalogue_path, db, **options)


def _last_id(spark: SparkSession, table: str) -> int:
    """The last id given to a play: as noted beside the rows, if there are as many rows, which
    file footers tell; else by a scan of the ids."""
    noted = table_properties(spark, table).get(LAST_ID)
    if noted is not None and spark.table(table).count() == int(noted):
        return int(noted)
    return _scan_last_id(spark.table(table))


def _scan_last_id(plays: DataFrame) -> int:
    return plays.agg(F.coalesce(F.max("songplay_id"), F.lit(0))).first()[0]


def _run(
    spark: SparkSession,
    log_path: str,
    catalogue_path: str,
    db: str,
    log_paths_file: str | None = None,
    scale: int = 0,
    buckets: int | None = None,
    load_mode: str = "FAILFAST",
    remove_duplicates: bool = True,
    repair: Sequence[str] = ("artists",),
    clean_sentinels: bool = True,
    drop_staging: bool = True,
    append: bool = False,
    ordered_ids: bool = False,
) -> StarRun:
    star = {name: schemas.all_tables(scale)[name] for name in STAR}
    run = StarRun(tables={})
    if unknown := set(repair) - set(REPAIRS):
        raise ValueError(f"no rule to repair {sorted(unknown)}")

    def table(name: str) -> DataFrame:
        return spark.table(f"{db}.{name}")

    # Asked once: nothing below fills a table before all are published.
    filled = {n for n in STAR if spark.catalog.tableExists(f"{db}.{n}") and not table(n).isEmpty()}
    if append and "songplays" in filled:
        # Plain questions to the catalogue, before anything is parsed.
        for name in filled:
            check_layout(spark.createDataFrame([], star[name]), f"{db}.{name}", buckets_too=False)

    staged = load_staging(spark, log_path, catalogue_path, db, log_paths_file, scale, load_mode)
    events, catalogue = staged["staging_events"], staged["staging_songs"]
    if load_mode == "PERMISSIVE":
        run.rejected[REJECTED_LINES] = table(REJECTED_LINES).count()

    matched = songplays(events, catalogue)
    if load_mode == "PERMISSIVE":
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in schemas.REQUIRED])
        publish(matched.filter(~complete), f"{db}.{REJECTED_PLAYS}")
        run.rejected[REJECTED_PLAYS] = table(REJECTED_PLAYS).count()
        plays = matched.filter(complete)
    else:
        plays = require_not_null(matched, schemas.REQUIRED)
    first_id = 1
    if append and "songplays" in filled:
        first_id += _last_id(spark, f"{db}.songplays")
    if buckets is None:
        known = table_buckets(spark, f"{db}.songplays") if "songplays" in filled else None
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = known[0] if known else max(least, events.count() // BUCKET_ROWS)
    bucketed = layout(buckets)

    frames = {
        "users": users(events),
        "songs": songs(catalogue),
        "artists": artists(catalogue),
        "time": time(events),
    }
    frames = {
        name: frame.select([F.col(f.name).cast(f.dataType) for f in star[name].fields])
        for name, frame in frames.items()
    }
    for name in STAR:
        frame = frames.get(name)
        if frame is None:
            frame = spark.createDataFrame([], star[name])
        if append and name in filled:
            check_layout(frame, f"{db}.{name}", buckets_too=False)
            continue
        sorted_by = [star[name].fields[0].name]
        _make_room(spark, f"{db}.{name}", frame, bucketed.get(name))
        if not spark.catalog.tableExists(f"{db}.{name}"):
            create_empty(spark, f"{db}.{name}", star[name], bucketed.get(name), sorted_by)

    # What the tables will hold is checked and repaired before it is published. Tables that
    # are not to be repaired are checked as they were published.
    looked_at = dict.fromkeys(["artists", "songs", *(repair if remove_duplicates else [])])
    whole = {
        name: table(name).unionByName(frames[name]) if append and name in filled else frames[name]
        for name in looked_at
    }
    before = [n for n in looked_at if n == "artists" or (remove_duplicates and n in repair)]
    # At most 20 rows each come back.
    reports = duplicate_checks({n: whole[n] for n in before})
    run.duplicates = {name: report.collect() for name, report in reports.items()}
    run.sentinels = sentinel_probe(whole["songs"], "year").first()[0]
    changed = {
        name: dedupe_ordered(whole[name], *REPAIRS[name])
        for name in (repair if remove_duplicates else [])
        if run.duplicates[name]
    }
    if clean_sentinels and run.sentinels:
        changed["songs"] = clean_songs(changed.get("songs", whole["songs"]))
    run.repaired = list(changed)

    order = PLAY_ORDER if ordered_ids else None
    numbered = surrogate_key(plays, order, "songplay_id", first_id)
    typed = numbered.select([F.col(f.name).cast(f.dataType) for f in star["songplays"].fields])

    def work(name: str, frame: DataFrame) -> Work:
        swapped = not append or name in changed
        # Sorted files let scans skip; bucketed files are sorted within the bucket.
        spec = table_buckets(spark, f"{db}.{name}") if name in filled else bucketed.get(name)
        sorted_by = [star[name].fields[0].name]
        return Work(f"{db}.{name}", frame, "swap" if swapped else "append", spec, sorted_by)

    works = [work(name, changed.get(name, frame)) for name, frame in frames.items()]
    fact = work("songplays", typed)
    # Footers again: ids are dense.
    fact.describe = lambda written: {LAST_ID: str(first_id - 1 + written.count())}
    publish_all(spark, db, [fact, *works])

    tables = {name: table(name) for name in STAR}
    suspects = shared_suspects(tables)
    # At most 5 rows per check come back.
    rest = {n: t for n, t in tables.items() if n not in run.duplicates}
    found = {name: check.collect() for name, check in duplicate_checks(rest, suspects).items()}
    found |= run.duplicates
    run.duplicates = {name: found[name] for name in (*STAR[1:], STAR[0])}
    for name, audit in key_audits(tables, suspects).items():
        if name.endswith("_key"):
            run.audits[name] = audit.count()
        else:
            run.audits[name] = sum(audit.first())
    if drop_staging:
        drop_tables(spark, db, STAGING)
    run.tables = tables
    return run
