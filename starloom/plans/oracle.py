"""The SQL each query of ``starloom.plans.queries`` must equal, in DuckDB's dialect."""

from __future__ import annotations

# Whole seconds and milliseconds of a microsecond timestamp; epoch_ms() would round up.
_MS = "epoch_us(ts) // 1000"
_SECOND = "make_timestamp((epoch_us(ts) // 1000000) * 1000000)"

_LINE_REST = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus"
)

_PLAYS = """
cat AS (
  SELECT o_orderkey, o_orderstatus, CAST(o_orderkey // 40 AS VARCHAR) AS band,
         'Title ' || (o_orderkey // 4) AS title,
         'Band ' || (o_orderkey // 40)
           || CASE WHEN o_orderpriority = '1-URGENT' THEN ' feat. Guest' ELSE '' END
           AS artist_name,
         CAST(trunc(o_totalprice / 100000) AS DECIMAL(18,0)) AS duration
  FROM orders
),
plays AS (
  SELECT l.*, c.title AS song, c.artist_name AS artist, c.duration AS length
  FROM lineitem l JOIN cat c ON c.o_orderkey = l.l_orderkey
)"""

_NULLABLE = """
lines AS (
  SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax)
  FROM lineitem
)"""

_LINE7 = """
lines AS (SELECT * REPLACE (nullif(l_linenumber, 7) AS l_linenumber) FROM lineitem)"""

_CALENDAR = """
  CAST(hour(start_time) AS INTEGER) AS hour,
  CAST(day(start_time) AS INTEGER) AS day,
  CAST(week(start_time) AS INTEGER) AS week,
  CAST(month(start_time) AS INTEGER) AS month,
  CAST(year(start_time) AS INTEGER) AS year,
  CAST(dayofweek(start_time) AS INTEGER) AS weekday"""

_STAGING = f"""{_PLAYS},
staged_songs AS (
  SELECT 'AR' || band AS artist_id,
         CAST(nullif(o_orderkey % 3, 0) AS DECIMAL(18,0)) AS artist_latitude,
         CAST(o_orderkey % 2 AS DECIMAL(18,0)) AS artist_longitude,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS artist_location,
         CASE WHEN o_orderkey % 50 <> 7 THEN artist_name END AS artist_name,
         'SO' || (o_orderkey // 2) AS song_id,
         title,
         duration,
         CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1950 + o_orderkey % 70 END AS INTEGER)
           AS year
  FROM cat
),
staged_events AS (
  SELECT artist, song, length,
         'F' || l_suppkey AS first_name,
         'L' || l_suppkey AS last_name,
         CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN l_linestatus = 'F' THEN 'free' ELSE 'paid' END AS level,
         'Place ' || (l_suppkey % 25) AS location,
         l_returnflag = 'R' AND l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL
           AND NOT coalesce(l_linenumber = 7 AND l_suppkey % 10 = 0, false) AS is_play,
         CAST(l_orderkey % 2147483647 AS VARCHAR) AS session_id,
         epoch_us(l_shipdate) // 1000 + 40500 AS ms,
         'agent ' || l_linenumber AS user_agent,
         CAST(CASE WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END
              AS INTEGER) AS user_id
  FROM plays
),
star_plays AS (
  SELECT make_timestamp((e.ms // 1000) * 1000000) AS start_time, e.user_id, e.level,
         s.song_id, s.artist_id, e.session_id, e.location, e.user_agent
  FROM staged_events e, staged_songs s
  WHERE e.is_play AND e.song = s.title AND e.artist = s.artist_name AND e.length = s.duration
),
star_users AS (
  SELECT user_id, first_name, last_name, gender, level
  FROM (SELECT *, max(ms) OVER (PARTITION BY user_id) AS last_ms FROM staged_events)
  WHERE user_id IS NOT NULL AND ms = last_ms
  GROUP BY ALL
),
star_songs AS (
  SELECT song_id, title, artist_id, year, duration FROM staged_songs GROUP BY ALL
),
star_artists AS (
  SELECT artist_id, artist_name AS name, artist_location AS location,
         artist_latitude AS latitude, artist_longitude AS longitude
  FROM staged_songs WHERE artist_id IS NOT NULL GROUP BY ALL
),
clean_artists AS (
  SELECT * FROM star_artists
  QUALIFY row_number() OVER (
    PARTITION BY artist_id, name
    ORDER BY latitude NULLS LAST, longitude NULLS LAST, location DESC NULLS LAST) = 1
),
star_time AS (
  SELECT start_time, {_CALENDAR}
  FROM (SELECT DISTINCT make_timestamp((ms // 1000) * 1000000) AS start_time
        FROM staged_events WHERE ms IS NOT NULL)
)"""


def _star(body: str) -> str:
    return f"WITH {_STAGING}\n{body}"


def _leading_rows(table: str, keys: str, shown: str, limit: int) -> str:
    """Rows of the largest groups: cut to the limit first, drop single rows second."""
    order = ", ".join(f"{k.strip()} NULLS LAST" for k in keys.split(","))
    return f"""
SELECT num_duplicates{shown} FROM (
  SELECT *, count(*) OVER (PARTITION BY {keys}) AS num_duplicates FROM {table}
  ORDER BY num_duplicates DESC, {order} LIMIT {limit})
WHERE num_duplicates > 1"""


def _top_artists(artists: str) -> str:
    return _star(
        f"""SELECT a.name, count(p.start_time) AS num_plays
FROM star_plays p JOIN {artists} a USING (artist_id)
GROUP BY a.name ORDER BY num_plays DESC, a.name NULLS LAST LIMIT 5"""
    )


_PLAY_IDS = _star(
    """SELECT row_number() OVER (
         ORDER BY start_time NULLS LAST, user_id NULLS LAST, session_id NULLS LAST,
                  song_id NULLS LAST, artist_id NULLS LAST) AS songplay_id,
       start_time, user_id, session_id, song_id, artist_id
FROM star_plays"""
)

_LINE_WINDOW = f"PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_REST}"

# First rows of repeated (order, line number) keys, and everything without them.
_LINE_SURVIVORS = f"""
ranked AS (
  SELECT *, row_number() OVER ({_LINE_WINDOW}) AS rn,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
  FROM lines
)"""

def _row_text(columns: str) -> str:
    parts = [f"coalesce({c.strip()}::VARCHAR, '~')" for c in columns.split(",")]
    return " || '|' || ".join(parts)


# (published table, its rows here, columns in order)
_PUBLISHED = [
    (
        "songplays",
        "star_plays",
        "start_time, user_id, level, song_id, artist_id, session_id, location, user_agent",
    ),
    ("users", "star_users", "user_id, first_name, last_name, gender, level"),
    (
        "songs",
        "(SELECT * REPLACE (nullif(year, 0) AS year) FROM star_songs)",
        "song_id, title, artist_id, year, duration",
    ),
    ("artists", "clean_artists", "artist_id, name, location, latitude, longitude"),
    ("time", "star_time", "start_time, hour, day, week, month, year, weekday"),
]

ALL: dict[str, str] = {
    "scan_json_mapped": """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, props->>'$.k' AS k_text FROM events""",
    "scan_json_auto": """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, props->>'$.missing' AS missing
FROM events""",
    "scan_json_files_mapped": """
SELECT event_id, epoch_us(ts) AS us, CAST(user_id AS INTEGER) AS user_id,
       CAST(trunc(value) AS DECIMAL(18,0)) AS whole_value,
       CAST(NULL AS INTEGER) AS blank_number, CAST(NULL AS VARCHAR) AS absent,
       event_id AS first_line, CASE WHEN event_id % 3 = 2 THEN 3 * event_id END AS third_line
FROM events""",
    "scan_json_files_auto": """
SELECT event_id, CAST(user_id AS INTEGER) AS "user",
       CAST(trunc(CAST(value AS DECIMAL(18,6)) * 10) / 10 AS DECIMAL(18,1)) AS value,
       '' AS blank
FROM events""",
    "cast_safe": """
SELECT p_partkey, CAST(trunc(p_retailprice) AS DECIMAL(18,0)) AS whole_price,
       CAST(trunc(p_retailprice) AS BIGINT) AS price_floor, p_size AS size_text,
       CAST(NULL AS INTEGER) AS brand_number,
       CAST(trunc(-p_retailprice) AS DECIMAL(18,0)) AS negative,
       CAST(NULL AS INTEGER) AS blank,
       CAST(left('123456789012.' || (p_partkey + 1000) || '4567899', 23) AS DECIMAL(38,10))
         AS long_cut,
       CAST('-1234567890123' || (p_partkey + 1000000) AS DECIMAL(38,0)) AS long_whole,
       CAST(['150000000000000000000', '10000000000000000000000000', '0', '-5', '0'][p_partkey % 5 + 1]
         AS DECIMAL(38,0)) AS power_whole,
       CAST(['150000000000000000000', '10000000000000000000000000', '0.001', '-5', '-0.0000000072']
         [p_partkey % 5 + 1] AS DECIMAL(38,10)) AS power_cut,
       CAST(p_partkey || '000000000000000000' AS DECIMAL(38,0)) AS large_double
FROM part""",
    "filter_equals": "SELECT * FROM lineitem WHERE l_returnflag = 'R'",
    "filter_not_null": f"WITH {_NULLABLE} SELECT * FROM lines WHERE l_tax IS NOT NULL",
    "distinct_rows": "SELECT p_name, p_brand FROM part GROUP BY ALL",
    "distinct_column": "SELECT p_name FROM part GROUP BY ALL",
    "dim_distinct": """
SELECT lang AS language, source AS origin FROM documents WHERE lang IS NOT NULL GROUP BY ALL""",
    "max_per_key": """
SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey""",
    "latest_per_key": """
SELECT DISTINCT o_custkey, o_orderstatus FROM orders
WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST) = 1""",
    "latest_per_key_first": """
SELECT o_custkey, o_orderstatus FROM orders
WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus NULLS LAST) = 1""",
    "epoch_to_timestamp": f"SELECT event_id, {_MS} AS ms, {_SECOND} AS start_time FROM events",
    "calendar_parts": f"""
SELECT event_id, start_time, {_CALENDAR}
FROM (SELECT event_id, {_SECOND} AS start_time FROM events)""",
    "dim_time": f"""
SELECT start_time, {_CALENDAR}
FROM (SELECT DISTINCT {_SECOND} AS start_time FROM events WHERE ts IS NOT NULL)""",
    "join_natural_key": f"""
WITH {_PLAYS}
SELECT p.l_orderkey, p.l_linenumber, p.l_partkey, c.o_orderkey
FROM plays p JOIN cat c
  ON p.song = c.title AND p.artist = c.artist_name AND p.length = c.duration
WHERE p.l_returnflag = 'R'""",
    "fact_build": f"""
WITH {_PLAYS}
SELECT date_trunc('second', p.l_shipdate) AS start_time, p.l_suppkey AS user_id,
       p.l_linestatus AS level, c.o_orderkey AS song_id, c.band AS artist_id,
       CAST(p.l_orderkey AS VARCHAR) AS session_id, c.o_orderstatus AS location
FROM plays p JOIN cat c
  ON p.song = c.title AND p.artist = c.artist_name AND p.length = c.duration
WHERE p.l_returnflag = 'R'""",
    "surrogate_key": """
SELECT row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey NULLS LAST) AS order_id,
       o_orderdate, o_orderkey
FROM orders""",
    "surrogate_key_load_order": "SELECT row_number() OVER () AS line_id FROM lineitem",
    "count_non_null": f"""
WITH {_NULLABLE}
SELECT l_returnflag, count(l_discount) AS num_discounts FROM lines GROUP BY l_returnflag""",
    "topk_join_agg": """
SELECT s_nationkey, count(l_shipdate) AS num_plays
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag = 'R'
GROUP BY s_nationkey ORDER BY num_plays DESC, s_nationkey NULLS LAST LIMIT 5""",
    "topk_join_agg_fanout": """
SELECT p_brand, count(l_shipdate) AS num_plays
FROM lineitem JOIN part ON l_linenumber = p_size
GROUP BY p_brand ORDER BY num_plays DESC, p_brand NULLS LAST LIMIT 5""",
    "topk_join_agg_unique": """
WITH firsts AS (
  SELECT p_size, p_brand FROM part
  QUALIFY row_number() OVER (
    PARTITION BY p_size
    ORDER BY p_retailprice NULLS LAST, p_partkey NULLS LAST, p_brand NULLS LAST) = 1
)
SELECT p_brand, count(l_shipdate) AS num_plays
FROM lineitem JOIN firsts ON l_linenumber = p_size
GROUP BY p_brand ORDER BY num_plays DESC, p_brand NULLS LAST LIMIT 5""",
    "sort_mixed_nulls": f"""
WITH {_NULLABLE}
SELECT l_discount, l_tax, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lines
ORDER BY l_discount DESC NULLS LAST, l_tax ASC NULLS FIRST, l_shipdate DESC NULLS FIRST,
         l_orderkey NULLS LAST, l_linenumber NULLS LAST, l_partkey NULLS LAST,
         l_suppkey NULLS LAST
LIMIT 20""",
    "sort_positions": f"""
WITH {_NULLABLE}
SELECT row_number() OVER (
         ORDER BY l_discount DESC NULLS LAST, l_tax ASC NULLS FIRST,
                  l_shipdate DESC NULLS FIRST, l_orderkey NULLS LAST,
                  l_linenumber NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST) AS place,
       l_discount, l_tax, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lines""",
    "window_count": """
SELECT l_orderkey, l_linenumber, l_partkey,
       count(*) OVER (PARTITION BY l_orderkey) AS num_duplicates
FROM lineitem""",
    "window_count2": f"""
WITH {_LINE7}
SELECT l_orderkey, l_linenumber, l_partkey,
       count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS num_duplicates
FROM lines""",
    "dup_check_window": _leading_rows("lineitem", "l_orderkey", ", l_orderkey", 5),
    "dup_check_window2": _leading_rows("lineitem", "l_orderkey, l_linenumber", "", 20),
    "dup_check_group": f"""
SELECT count(*) AS num_duplicates, {_SECOND} AS start_time FROM events
GROUP BY 2 HAVING count(*) > 1
ORDER BY num_duplicates DESC, start_time NULLS LAST LIMIT 5""",
    "dup_check_group_column": f"""
WITH {_NULLABLE}
SELECT count(l_discount) AS num_duplicates, l_shipdate FROM lines
GROUP BY l_shipdate HAVING count(l_discount) > 1
ORDER BY num_duplicates DESC, l_shipdate NULLS LAST LIMIT 5""",
    "row_number_per_key": """
SELECT *, row_number() OVER (
  PARTITION BY p_name, p_brand ORDER BY p_size, p_retailprice, p_partkey, p_type) AS row_number
FROM part""",
    "row_number_hot_key": """
SELECT l_returnflag, l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
       row_number() OVER (
         PARTITION BY l_returnflag
         ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_number
FROM lineitem""",
    "dup_survivors": """
SELECT * FROM part
QUALIFY row_number() OVER (
          PARTITION BY p_name, p_brand ORDER BY p_size, p_retailprice, p_partkey, p_type) = 1
    AND count(*) OVER (PARTITION BY p_name, p_brand) > 1""",
    "dedupe_ordered": f"SELECT * FROM lineitem QUALIFY row_number() OVER ({_LINE_WINDOW}) = 1",
    "delete_using_anti": """
SELECT * FROM lineitem
QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
    "delete_using_equality": f"""
WITH {_LINE7}
SELECT * FROM lines
QUALIFY l_linenumber IS NULL OR l_orderkey IS NULL
     OR count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
    "dedupe_delete_reinsert": f"""
WITH lines AS (SELECT * FROM lineitem), {_LINE_SURVIVORS}
SELECT * EXCLUDE (rn, n) FROM ranked WHERE n = 1
UNION ALL
SELECT * EXCLUDE (rn, n) FROM ranked WHERE n > 1 AND rn = 1""",
    "dedupe_null_keys": f"""
WITH {_LINE7}
SELECT * FROM lines QUALIFY row_number() OVER ({_LINE_WINDOW}) = 1""",
    "sentinel_probe": "SELECT count(*) AS num_sentinels FROM lineitem WHERE l_discount = 0",
    "sentinel_to_null": "SELECT * REPLACE (nullif(l_discount, 0) AS l_discount) FROM lineitem",
    "dq_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS num_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "dq_not_null": f"""
WITH {_NULLABLE}
SELECT count(*) - count(l_orderkey) AS l_orderkey_nulls,
       count(*) - count(l_discount) AS l_discount_nulls,
       count(*) - count(l_tax) AS l_tax_nulls
FROM lines""",
    "dq_max_length": """
SELECT count(*) FILTER (length(text) > 256) AS text_too_long,
       count(*) FILTER (length(lang) > 5) AS lang_too_long
FROM documents""",
    "publish_swap": "SELECT * FROM orders WHERE o_orderstatus <> 'P'",
    "publish_append_twice": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "publish_bucketed": "SELECT * FROM lineitem",
    "star_songplays": _star("SELECT * FROM star_plays"),
    "star_play_ids": _PLAY_IDS,
    "star_users": _star("SELECT * FROM star_users"),
    "star_songs": _star("SELECT * REPLACE (nullif(year, 0) AS year) FROM star_songs"),
    "star_artists": _star("SELECT * FROM star_artists"),
    "star_artists_clean": _star("SELECT * FROM clean_artists"),
    "star_time": _star("SELECT * FROM star_time"),
    "star_top_artists": _top_artists("star_artists"),
    "star_top_artists_clean": _top_artists("clean_artists"),
    "star_top_artists_unique": _top_artists(
        """(SELECT * FROM star_artists QUALIFY row_number() OVER (
  PARTITION BY artist_id
  ORDER BY latitude NULLS LAST, longitude NULLS LAST, location DESC NULLS LAST,
           name NULLS LAST) = 1)"""
    ),
    "star_users_duplicates": _star(_leading_rows("star_users", "user_id", ", user_id", 5)),
    "star_songs_duplicates": _star(_leading_rows("star_songs", "song_id", ", song_id", 5)),
    "star_artists_duplicates": _star(_leading_rows("star_artists", "artist_id, name", "", 20)),
    "star_time_duplicates": _star(
        """SELECT 2 * count(*) AS num_duplicates, start_time FROM star_time
GROUP BY start_time ORDER BY num_duplicates DESC, start_time LIMIT 5"""
    ),
    "star_songplays_duplicates": _star(
        """SELECT count(*) AS num_duplicates, start_time FROM star_plays
GROUP BY start_time HAVING count(*) > 1
ORDER BY num_duplicates DESC, start_time LIMIT 5"""
    ),
    "star_songplays_true_duplicates": _star(
        """SELECT start_time, user_id, session_id, song_id, count(*) AS num_rows
FROM star_plays GROUP BY ALL
HAVING count(*) > 1 OR start_time IS NULL OR user_id IS NULL OR session_id IS NULL
    OR song_id IS NULL"""
    ),
    "star_year_zero": _star("SELECT count(*) AS num_sentinels FROM star_songs WHERE year = 0"),
    "star_job": _PLAY_IDS,
    "star_job_tables": _star(
        " UNION ALL ".join(
            f"""SELECT '{table}' AS table_name, count(*) AS num_rows,
  CAST(coalesce(sum(('0x' || left(md5({_row_text(columns)}), 8))::BIGINT), 0) AS BIGINT) AS checksum
FROM {source}"""
            for table, source, columns in _PUBLISHED
        )
    ),
    "star_job_checks": _star(
        f"""SELECT 'users' AS check_name, num_duplicates || '|' || coalesce(user_id::VARCHAR, '~') AS found
FROM ({_leading_rows("star_users", "user_id", ", user_id", 5)})
UNION ALL SELECT 'songs', num_duplicates || '|' || coalesce(song_id, '~')
FROM ({_leading_rows("star_songs", "song_id", ", song_id", 5)})
UNION ALL SELECT 'artists', num_duplicates::VARCHAR
FROM ({_leading_rows("star_artists", "artist_id, name", "", 20)})
UNION ALL SELECT 'songplays', num_duplicates || '|' || start_time
FROM (SELECT count(*) AS num_duplicates, start_time FROM star_plays
      GROUP BY start_time HAVING count(*) > 1
      ORDER BY num_duplicates DESC, start_time LIMIT 5)
UNION ALL SELECT 'repaired', 'songs' FROM star_songs HAVING count_if(year = 0) > 0
UNION ALL SELECT 'repaired', 'artists'
FROM (SELECT 1 FROM star_artists GROUP BY artist_id, name HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'sentinels', CAST(count_if(year = 0) AS VARCHAR) FROM star_songs
UNION ALL SELECT 'songplays_key', '0'
UNION ALL SELECT 'songplays_required', '0'
UNION ALL SELECT 'time_key', '0'
UNION ALL SELECT 'users_key', count(*)::VARCHAR
FROM (SELECT 1 FROM star_users GROUP BY user_id HAVING count(*) > 1)
UNION ALL SELECT 'songs_key', count(*)::VARCHAR
FROM (SELECT 1 FROM star_songs GROUP BY song_id HAVING count(*) > 1 OR song_id IS NULL)
UNION ALL SELECT 'artists_key', count(*)::VARCHAR
FROM (SELECT 1 FROM clean_artists GROUP BY artist_id HAVING count(*) > 1)"""
    ),
    "table_life": """
WITH sizes AS (
  SELECT 'nation' AS table_name, count(*) AS n FROM nation
  UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'supplier', count(*) FROM supplier
)
SELECT '1 created' AS step, table_name, 0::BIGINT AS num_rows FROM sizes
UNION ALL SELECT '2 filled', table_name, CASE WHEN table_name = 'orders' THEN 2 * n ELSE n END FROM sizes
UNION ALL SELECT '3 truncated', table_name, CASE WHEN table_name = 'orders' THEN 0 ELSE n END FROM sizes
UNION ALL SELECT '4 dropped', table_name, CASE WHEN table_name = 'orders' THEN 0 ELSE n END FROM sizes
WHERE table_name <> 'supplier'""",
    "publish_append_bucketed": "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem",
    "scan_rejects": """
WITH sent AS (
  SELECT event_id, user_id, event_id % 10 = 0 AS broken, event_id % 7 = 0 AS no_number,
    event_id % 11 = 0 AS too_long FROM events
)
SELECT 'row' AS kind, event_id, user_id, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS wrong
FROM sent WHERE NOT (broken OR no_number OR too_long)
UNION ALL SELECT 'reject', NULL, NULL, '{"event_id":' || event_id || ', "user', '' FROM sent WHERE broken
UNION ALL SELECT 'reject', NULL, NULL, '{"event_id":' || event_id || ',"user":"'
    || CASE WHEN no_number THEN 'u' ELSE '' END || user_id || '","kind":"'
    || CASE WHEN too_long THEN 'much too long' ELSE 'short' END || '"}',
  concat_ws(', ', CASE WHEN no_number THEN 'user_id u' || user_id || ' does not fit bigint' END,
    CASE WHEN too_long THEN 'kind much too long longer than 8' END)
FROM sent WHERE NOT broken AND (no_number OR too_long)
UNION ALL SELECT 'strict', NULL, NULL, 'refused', NULL""",
    "surrogate_key_load_order_rows": """
SELECT l_orderkey, l_linenumber, count(*) AS num_rows, count(*) AS num_ids
FROM lineitem GROUP BY ALL""",
}
