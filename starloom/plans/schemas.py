"""Columns of the star schema's seven tables.

Fixed values: table names, column names, their order and their types must equal those
of the data being replaced. Numbers without a declared scale hold whole numbers by
default (``scale=0``); pass another scale to keep fractions.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _LONG, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def staging_events(scale: int = 0) -> T.StructType:
    return _struct(
        ("artist", _STRING),
        ("auth", _STRING),
        ("firstName", _STRING),
        ("gender", _STRING),
        ("iteminSession", _INT),
        ("lastName", _STRING),
        ("length", T.DecimalType(18, scale)),
        ("level", _STRING),
        ("location", _STRING),
        ("method", _STRING),
        ("page", _STRING),
        ("registration", _STRING),
        ("sessionId", _INT),
        ("song", _STRING),
        ("status", _INT),
        ("ts", _LONG),
        ("userAgent", _STRING),
        ("userId", _INT),
    )


def staging_songs(scale: int = 0) -> T.StructType:
    return _struct(
        ("num_songs", _INT),
        ("artist_id", _STRING),
        ("artist_latitude", T.DecimalType(18, scale)),
        ("artist_longitude", T.DecimalType(18, scale)),
        ("artist_location", _STRING),
        ("artist_name", _STRING),
        ("song_id", _STRING),
        ("title", _STRING),
        ("duration", T.DecimalType(18, scale)),
        ("year", _INT),
    )


def songplays() -> T.StructType:
    return _struct(
        # 64 bits: a 32-bit id cannot number the plays of a large log.
        ("songplay_id", _LONG),
        ("start_time", _TIME),
        ("user_id", _INT),
        ("level", _STRING),
        ("song_id", _STRING),
        ("artist_id", _STRING),
        ("session_id", _STRING),
        ("location", _STRING),
        ("user_agent", _STRING),
    )


def users() -> T.StructType:
    return _struct(
        ("user_id", _INT),
        ("first_name", _STRING),
        ("last_name", _STRING),
        ("gender", _STRING),
        ("level", _STRING),
    )


def songs(scale: int = 0) -> T.StructType:
    return _struct(
        ("song_id", _STRING),
        ("title", _STRING),
        ("artist_id", _STRING),
        ("year", _INT),
        ("duration", T.DecimalType(18, scale)),
    )


def artists(scale: int = 0) -> T.StructType:
    return _struct(
        ("artist_id", _STRING),
        ("name", _STRING),
        ("location", _STRING),
        ("latitude", T.DecimalType(18, scale)),
        ("longitude", T.DecimalType(18, scale)),
    )


def time() -> T.StructType:
    return _struct(
        ("start_time", _TIME),
        ("hour", _INT),
        ("day", _INT),
        ("week", _INT),
        ("month", _INT),
        ("year", _INT),
        ("weekday", _INT),
    )


def all_tables(scale: int = 0) -> dict[str, T.StructType]:
    return {
        "staging_events": staging_events(scale),
        "staging_songs": staging_songs(scale),
        "songplays": songplays(),
        "users": users(),
        "songs": songs(scale),
        "artists": artists(scale),
        "time": time(),
    }


# Declared text lengths of the event log, and the length of texts without a declared one.
EVENT_LENGTHS = {"gender": 5, "level": 10, "method": 10, "page": 20}
TEXT_LENGTH = 256


def text_lengths(schema: T.StructType, declared: dict[str, int]) -> dict[str, int]:
    """The longest value allowed in each text column."""
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    return {name: declared.get(name, TEXT_LENGTH) for name in texts}


# Columns that must not be NULL in the fact.
REQUIRED = ("start_time", "user_id", "song_id", "artist_id", "session_id")

# Page value that marks a play.
PLAY_PAGE = "NextSong"
