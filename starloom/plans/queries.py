"""One query per operator, over the whole benchmark tables.

Roles: line items are the plays (return flag R marks a play), orders the catalogue they
match by title, band and whole price, events the log, orders the history of a
customer, line items on (order, line number) the repeated entity, suppliers a dimension.
A play matches at most the four orders of its title, however large the tables are.
The ``star_*`` queries run the star schema itself on staging rows derived from these
tables. ``starloom.plans.oracle`` holds the SQL each result must equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType

from starloom.functions import (
    calendar_parts,
    epoch_micros,
    epoch_to_timestamp,
    null_if_sentinel,
    truncate_decimal,
)
from starloom.operators import (
    count_per_key,
    dedupe_delete_reinsert,
    dedupe_ordered,
    delete_using_anti,
    dim_distinct,
    dim_time,
    dq_max_length,
    dq_not_null,
    dq_unique,
    dup_check_group,
    dup_check_window,
    dup_survivors,
    fact_build,
    join_natural_key,
    latest_per_key,
    max_per_key,
    repeated_keys,
    row_number_per_key,
    sentinel_probe,
    surrogate_key,
    top_sorted,
    topk_join_agg,
)
from starloom.plans import schemas, star
from starloom.sinks import create_tables, pin, publish, scratch_path, truncate_table
from starloom.sources import (
    cast_safe,
    drop_tables,
    list_tables,
    parse_json_auto,
    parse_json_mapped,
    read_json_auto,
    read_json_mapped,
    read_with_rejects,
)

Query = Callable[[SparkSession, str], DataFrame]

# Lines of a file of compressed JSON, which one task must read as a whole.
JSON_FILE_ROWS = 250_000

LINE_KEY = ["l_orderkey", "l_linenumber"]
# Every other column, so that only exact copies tie.
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
PART_ORDER = ["p_size", "p_retailprice", "p_partkey", "p_type"]
MIXED_ORDER = [
    ("l_discount", "desc", "last"),
    ("l_tax", "asc", "first"),
    ("l_shipdate", "desc", "first"),
    *LINE_KEY,
    "l_partkey",
    "l_suppkey",
]
MIXED_COLUMNS = ["l_discount", "l_tax", "l_shipdate", *LINE_KEY, "l_partkey", "l_suppkey"]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _events_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with its time as epoch milliseconds."""
    events = _read(spark, sf_dir, "events")
    return events.withColumn("ms", F.call_function("div", epoch_micros("ts"), F.lit(1000)))


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalogue rows, found by (title, artist name, whole duration).

    Four orders share a title, and some of those also the rest of the key.
    """
    orders = _read(spark, sf_dir, "orders")
    title = F.call_function("div", F.col("o_orderkey"), F.lit(4)).cast("string")
    band = F.call_function("div", F.col("o_orderkey"), F.lit(40)).cast("string")
    guest = F.when(F.col("o_orderpriority") == "1-URGENT", " feat. Guest").otherwise("")
    return orders.select(
        "o_orderkey",
        "o_orderstatus",
        band.alias("band"),
        F.concat(F.lit("Title "), title).alias("title"),
        F.concat(F.lit("Band "), band, guest).alias("artist_name"),
        truncate_decimal(F.col("o_totalprice") / 100000, source=DoubleType()).alias("duration"),
    )


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that describe their order by its attributes, as a play does its song."""
    lines = _read(spark, sf_dir, "lineitem")
    described = _catalogue(spark, sf_dir).select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("title").alias("song"),
        F.col("artist_name").alias("artist"),
        F.col("duration").alias("length"),
    )
    return lines.join(described, "l_orderkey")


NATURAL_KEY = [("song", "title"), ("artist", "artist_name"), ("length", "duration")]


def _nullable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose zero discount and tax are unknown."""
    lines = _read(spark, sf_dir, "lineitem")
    return null_if_sentinel(null_if_sentinel(lines, "l_discount"), "l_tax")


# --- scans ---------------------------------------------------------------------------


def scan_json_mapped(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    return parse_json_mapped(
        events, "props", [("$.k", "k", "int"), ("$['k']", "k_text", "string")], keep=["event_id"]
    )


def scan_json_auto(spark, sf_dir):
    schema = "k int, missing string"
    events = _read(spark, sf_dir, "events")
    return parse_json_auto(events, "props", StructType.fromDDL(schema), keep=["event_id"])


def _json_folder(spark, sf_dir, label: str) -> str:
    """The event log written out as JSON lines in nested folders, numbers quoted."""
    events = _read(spark, sf_dir, "events")
    document = F.to_json(
        F.struct(
            "event_id",
            F.struct(epoch_micros("ts").alias("us")).alias("time"),
            F.col("user_id").cast("string").alias("user"),
            F.col("value").alias("value"),
            F.lit("").alias("blank"),
            # Lists of one to three entries.
            F.slice(
                F.array(*[F.struct((F.col("event_id") * k).cast("string").alias("id")) for k in (1, 2, 3)]),
                F.lit(1),
                (F.col("event_id") % 3 + 1).cast("int"),
            ).alias("lines"),
        )
    )
    path = scratch_path(spark, label)
    events.select(document.alias("document"), "event_type").write.partitionBy("event_type").text(path)
    return path


def scan_json_files_mapped(spark, sf_dir):
    mapping = [
        ("$.event_id", "event_id", "bigint"),
        ("$['time']['us']", "us", "bigint"),
        ("$.user", "user_id", "int"),
        ("$.value", "whole_value", "decimal"),
        ("$.blank", "blank_number", "int"),
        ("$.absent", "absent", "string"),
        ("$['lines'][0]['id']", "first_line", "bigint"),
        ("$.lines[2].id", "third_line", "bigint"),
    ]
    return read_json_mapped(spark, _json_folder(spark, sf_dir, "json-mapped"), mapping)


def scan_json_files_auto(spark, sf_dir):
    schema = StructType.fromDDL("event_id bigint, user int, value decimal(18,1), blank string")
    return read_json_auto(spark, _json_folder(spark, sf_dir, "json-auto"), schema)


def cast_safe_(spark, sf_dir):
    texts = F.array(*[F.lit(t) for t in ("1.5e20", "1E25", "1e-3", "-.5E1", "-7.25e-9")])
    notation = F.element_at(texts, (F.col("p_partkey") % 5 + 1).cast("int"))
    parts = _read(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_retailprice").alias("whole_price"),
        F.col("p_retailprice").alias("price_floor"),
        F.col("p_size").cast("string").alias("size_text"),
        F.col("p_brand").alias("brand_number"),
        F.concat(F.lit("-"), F.col("p_retailprice").cast("string")).alias("negative"),
        F.lit(" ").alias("blank"),
        F.concat(F.lit("123456789012."), F.col("p_partkey") + 1000, F.lit("4567899")).alias("long_cut"),
        F.concat(F.lit("-1234567890123"), F.col("p_partkey") + 1000000, F.lit(".99")).alias("long_whole"),
        # Five notations in turn, and a double whose text has an exponent.
        notation.alias("power_whole"),
        notation.alias("power_cut"),
        F.concat("p_partkey", F.lit("e18")).cast("double").alias("large_double"),
    )
    return cast_safe(
        parts,
        {
            "whole_price": "decimal",
            "price_floor": "bigint",
            "size_text": "int",
            "brand_number": "int",
            "negative": "decimal",
            "blank": "int",
            "long_cut": "decimal(38,10)",
            "long_whole": "decimal(38,0)",
            "power_whole": "decimal(38,0)",
            "power_cut": "decimal(38,10)",
            "large_double": "decimal(38,0)",
        },
    )


# --- filters, distinct ---------------------------------------------------------------


def filter_equals(spark, sf_dir):
    return _read(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")


def filter_not_null(spark, sf_dir):
    return _nullable_lines(spark, sf_dir).filter(F.col("l_tax").isNotNull())


def distinct_rows(spark, sf_dir):
    return _read(spark, sf_dir, "part").select("p_name", "p_brand").distinct()


def distinct_column(spark, sf_dir):
    return _read(spark, sf_dir, "part").select("p_name").distinct()


def dim_distinct_(spark, sf_dir):
    documents = _read(spark, sf_dir, "documents")
    return dim_distinct(documents, {"lang": "language", "source": "origin"}, not_null=["lang"])


# --- latest row, time ----------------------------------------------------------------


def max_per_key_(spark, sf_dir):
    return max_per_key(_read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "last_order")


def latest_per_key_(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderstatus"])


def latest_per_key_first(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    return latest_per_key(
        orders, ["o_custkey"], "o_orderdate", ["o_orderstatus"], ties="first"
    )


def epoch_to_timestamp_(spark, sf_dir):
    return _events_ms(spark, sf_dir).select(
        "event_id", "ms", epoch_to_timestamp("ms").alias("start_time")
    )


def calendar_parts_(spark, sf_dir):
    events = _events_ms(spark, sf_dir)
    return calendar_parts(
        events.select("event_id", epoch_to_timestamp("ms").alias("start_time")), "start_time"
    )


def dim_time_(spark, sf_dir):
    return dim_time(_events_ms(spark, sf_dir), "ms")


# --- joins, facts --------------------------------------------------------------------


def join_natural_key_(spark, sf_dir):
    plays = _plays(spark, sf_dir).filter(F.col("l_returnflag") == "R")
    joined = join_natural_key(plays, _catalogue(spark, sf_dir), NATURAL_KEY)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderkey")


def fact_build_(spark, sf_dir):
    plays = _plays(spark, sf_dir).withColumn(
        "ms", F.call_function("div", epoch_micros("l_shipdate"), F.lit(1000))
    )
    return fact_build(
        plays,
        _catalogue(spark, sf_dir),
        on=NATURAL_KEY,
        where=F.col("l_returnflag") == "R",
        cols={
            "start_time": epoch_to_timestamp("ms"),
            "user_id": F.col("l_suppkey"),
            "level": F.col("l_linestatus"),
            "song_id": F.col("o_orderkey"),
            "artist_id": F.col("band"),
            "session_id": F.col("l_orderkey").cast("string"),
            "location": F.col("o_orderstatus"),
        },
    )


def surrogate_key_(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return surrogate_key(orders, ["o_orderdate", "o_orderkey"], "order_id", stable_input=True)


def surrogate_key_load_order(spark, sf_dir):
    """Ids without a sort; which row gets which id is open, so only the ids are shown."""
    lines = _read(spark, sf_dir, "lineitem").select(LINE_KEY)
    return surrogate_key(lines, None, "line_id").select("line_id")


# --- reports, sorts ------------------------------------------------------------------


def count_non_null(spark, sf_dir):
    lines = _nullable_lines(spark, sf_dir)
    return lines.groupBy("l_returnflag").agg(F.count("l_discount").alias("num_discounts"))


def _top(spark, sf_dir, **options):
    plays = _read(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    suppliers = _read(spark, sf_dir, "supplier")
    return topk_join_agg(
        plays, suppliers, ("l_suppkey", "s_suppkey"), "s_nationkey", "l_shipdate",
        name="num_plays", **options,
    )


def topk_join_agg_(spark, sf_dir):
    return _top(spark, sf_dir)


def topk_join_agg_fanout(spark, sf_dir):
    """Several dimension rows per key: parts listed by size, plays counted per brand."""
    lines = _read(spark, sf_dir, "lineitem")
    parts = _read(spark, sf_dir, "part")
    return topk_join_agg(
        lines, parts, ("l_linenumber", "p_size"), "p_brand", "l_shipdate", name="num_plays"
    )


def topk_join_agg_unique(spark, sf_dir):
    """The same report with the dimension reduced to one row per key."""
    lines = _read(spark, sf_dir, "lineitem")
    parts = _read(spark, sf_dir, "part")
    return topk_join_agg(
        lines, parts, ("l_linenumber", "p_size"), "p_brand", "l_shipdate", mode="unique",
        dim_order=["p_retailprice", "p_partkey"], name="num_plays",
    )


def sort_mixed_nulls(spark, sf_dir):
    lines = _nullable_lines(spark, sf_dir).select(MIXED_COLUMNS)
    return top_sorted(lines, MIXED_ORDER, 20)


def sort_positions(spark, sf_dir):
    """Place of every line item in the same order."""
    lines = _nullable_lines(spark, sf_dir).select(MIXED_COLUMNS)
    return surrogate_key(lines, MIXED_ORDER, "place", stable_input=True)


# --- duplicates ----------------------------------------------------------------------


def window_count(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return count_per_key(lines, ["l_orderkey"])


def window_count2(spark, sf_dir):
    lines = null_if_sentinel(_read(spark, sf_dir, "lineitem"), "l_linenumber", 7)
    return count_per_key(lines.select(*LINE_KEY, "l_partkey"), LINE_KEY)


def dup_check_window_(spark, sf_dir):
    return dup_check_window(_read(spark, sf_dir, "lineitem"), ["l_orderkey"], limit=5)


def dup_check_window2(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    return dup_check_window(lines, LINE_KEY, limit=20, out_cols=[])


def dup_check_group_(spark, sf_dir):
    seconds = _events_ms(spark, sf_dir).select(epoch_to_timestamp("ms").alias("start_time"))
    return dup_check_group(seconds, ["start_time"])


def dup_check_group_column(spark, sf_dir):
    return dup_check_group(
        _nullable_lines(spark, sf_dir), ["l_shipdate"], count_col="l_discount", limit=5
    )


def row_number_per_key_(spark, sf_dir):
    parts = _read(spark, sf_dir, "part")
    return row_number_per_key(parts, ["p_name", "p_brand"], PART_ORDER)


def row_number_hot_key(spark, sf_dir):
    """Each return flag holds about a third of the line items."""
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_returnflag", *LINE_KEY, "l_shipdate", "l_partkey", "l_suppkey"
    )
    order = ["l_shipdate", *LINE_KEY, "l_partkey", "l_suppkey"]
    return row_number_per_key(lines, ["l_returnflag"], order)


def dup_survivors_(spark, sf_dir):
    return dup_survivors(_read(spark, sf_dir, "part"), ["p_name", "p_brand"], PART_ORDER)


def dedupe_ordered_(spark, sf_dir):
    return dedupe_ordered(_read(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


def delete_using_anti_(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    return delete_using_anti(lines, repeated_keys(lines, LINE_KEY), LINE_KEY)


def delete_using_equality(spark, sf_dir):
    """SQL equality: rows with a NULL key stay."""
    lines = null_if_sentinel(_read(spark, sf_dir, "lineitem"), "l_linenumber", 7)
    return delete_using_anti(lines, repeated_keys(lines, LINE_KEY), LINE_KEY, null_safe=False)


def dedupe_delete_reinsert_(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    return dedupe_delete_reinsert(lines, LINE_KEY, LINE_ORDER)


def dedupe_null_keys(spark, sf_dir):
    lines = null_if_sentinel(_read(spark, sf_dir, "lineitem"), "l_linenumber", 7)
    return dedupe_delete_reinsert(lines, LINE_KEY, LINE_ORDER)


# --- audits --------------------------------------------------------------------------


def sentinel_probe_(spark, sf_dir):
    return sentinel_probe(_read(spark, sf_dir, "lineitem"), "l_discount")


def sentinel_to_null(spark, sf_dir):
    return null_if_sentinel(_read(spark, sf_dir, "lineitem"), "l_discount")


def dq_unique_(spark, sf_dir):
    return dq_unique(_read(spark, sf_dir, "lineitem"), LINE_KEY)


def dq_not_null_(spark, sf_dir):
    return dq_not_null(_nullable_lines(spark, sf_dir), ["l_orderkey", "l_discount", "l_tax"])


def dq_max_length_(spark, sf_dir):
    return dq_max_length(_read(spark, sf_dir, "documents"), {"text": 256, "lang": 5})


# --- published tables ----------------------------------------------------------------


def _scratch_db(spark, label: str) -> str:
    """A database of its own in the scratch folder."""
    name = f"starloom_{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name


def publish_swap(spark, sf_dir):
    """Publish orders, then replace them by a part of what the table holds."""
    table = f"{_scratch_db(spark, 'swap')}.orders"
    publish(_read(spark, sf_dir, "orders"), table, sort_by=["o_orderkey"])
    publish(spark.table(table).filter("o_orderstatus <> 'P'"), table, sort_by=["o_orderkey"])
    return spark.table(table)


def publish_append_twice(spark, sf_dir):
    table = f"{_scratch_db(spark, 'append')}.orders"
    for _ in range(2):
        publish(_read(spark, sf_dir, "orders"), table, mode="append")
    return spark.table(table)


def publish_bucketed(spark, sf_dir):
    """Line items stored by order, in as many buckets as shuffle partitions."""
    table = f"{_scratch_db(spark, 'buckets')}.lineitem"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = _read(spark, sf_dir, "lineitem")
    publish(lines, table, bucket_by=(buckets, ["l_orderkey"]), sort_by=["l_orderkey"])
    return spark.table(table)


# --- the star schema on derived staging rows -------------------------------------------


def staging_songs(spark, sf_dir) -> DataFrame:
    """Catalogue rows: one per order, two orders share a song id, forty a band."""
    key, whole = F.col("o_orderkey"), "decimal(18,0)"
    return _catalogue(spark, sf_dir).select(
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("AR"), F.col("band")).alias("artist_id"),
        F.nullif(key % 3, F.lit(0)).cast(whole).alias("artist_latitude"),
        (key % 2).cast(whole).alias("artist_longitude"),
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("artist_location"),
        F.when(key % 50 != 7, F.col("artist_name")).alias("artist_name"),
        F.concat(F.lit("SO"), F.call_function("div", key, F.lit(2)).cast("string")).alias("song_id"),
        "title",
        "duration",
        F.when(key % 3 == 0, 0).otherwise(1950 + key % 70).cast("int").alias("year"),
    )


def staging_events(spark, sf_dir) -> DataFrame:
    """Log rows: line items describe their order; suppliers are the users."""
    plays = _plays(spark, sf_dir)
    user = F.col("l_suppkey")
    unknown = (F.col("l_linenumber") == 7) & (user % 10 == 0)
    # Half a second past a full one, to be cut; days repeat, so users have tied events.
    millis = F.call_function("div", epoch_micros("l_shipdate"), F.lit(1000)) + 40500
    complete = (
        ~F.coalesce(unknown, F.lit(False))
        & user.isNotNull()
        & F.col("l_shipdate").isNotNull()
        & (F.col("l_returnflag") == "R")
    )
    page = F.when(complete, schemas.PLAY_PAGE).otherwise("Home")
    return plays.select(
        "artist",
        F.concat(F.lit("F"), user.cast("string")).alias("firstName"),
        F.when(user % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("L"), user.cast("string")).alias("lastName"),
        "length",
        F.when(F.col("l_linestatus") == "F", "free").otherwise("paid").alias("level"),
        F.concat(F.lit("Place "), (user % 25).cast("string")).alias("location"),
        page.alias("page"),
        (F.col("l_orderkey") % 2147483647).cast("int").alias("sessionId"),
        "song",
        millis.alias("ts"),
        F.concat(F.lit("agent "), F.col("l_linenumber").cast("string")).alias("userAgent"),
        F.when(unknown, None).otherwise(user).cast("int").alias("userId"),
    )


def star_songplays(spark, sf_dir):
    return star.songplays(staging_events(spark, sf_dir), staging_songs(spark, sf_dir))


def star_play_ids(spark, sf_dir):
    plays = star_songplays(spark, sf_dir).select(star.PLAY_ORDER)
    return surrogate_key(plays, star.PLAY_ORDER, "songplay_id")


def star_users(spark, sf_dir):
    return star.users(staging_events(spark, sf_dir))


def star_songs(spark, sf_dir):
    return star.clean_songs(star.songs(staging_songs(spark, sf_dir)))


def star_artists(spark, sf_dir):
    return star.artists(staging_songs(spark, sf_dir))


def star_artists_clean(spark, sf_dir):
    return star.clean_artists(star_artists(spark, sf_dir))


def star_time(spark, sf_dir):
    return star.time(staging_events(spark, sf_dir))


def star_top_artists(spark, sf_dir):
    return star.top_artists(star_songplays(spark, sf_dir), star_artists(spark, sf_dir))


def star_top_artists_clean(spark, sf_dir):
    return star.top_artists(star_songplays(spark, sf_dir), star_artists_clean(spark, sf_dir))


def star_top_artists_unique(spark, sf_dir):
    return star.top_artists(
        star_songplays(spark, sf_dir), star_artists(spark, sf_dir), mode="unique"
    )


def star_users_duplicates(spark, sf_dir):
    return dup_check_window(star_users(spark, sf_dir), ["user_id"], limit=5)


def star_songs_duplicates(spark, sf_dir):
    songs = star.songs(staging_songs(spark, sf_dir))
    return dup_check_window(songs, ["song_id"], limit=5)


def star_artists_duplicates(spark, sf_dir):
    artists = star_artists(spark, sf_dir)
    return dup_check_window(artists, star.ARTIST_KEYS, limit=20, out_cols=[])


def star_time_duplicates(spark, sf_dir):
    """The time table after its rows were appended a second time."""
    times = star_time(spark, sf_dir)
    return dup_check_group(times.unionByName(times), ["start_time"])


def star_songplays_duplicates(spark, sf_dir):
    return dup_check_group(star_songplays(spark, sf_dir), ["start_time"])


def star_songplays_true_duplicates(spark, sf_dir):
    """Repeated plays by their real key instead of the second alone."""
    keys = ["start_time", "user_id", "session_id", "song_id"]
    return dq_unique(star_songplays(spark, sf_dir), keys)


def star_year_zero(spark, sf_dir):
    return sentinel_probe(star.songs(staging_songs(spark, sf_dir)), "year")


def _write_json(df: DataFrame, path: str) -> None:
    """JSON lines in compressed files, bounded so that many tasks can read them."""
    df.write.option("maxRecordsPerFile", JSON_FILE_ROWS).json(path, compression="gzip")


def _job(spark, sf_dir) -> star.StarRun:
    """The whole job from JSON files to published tables."""
    constants = {"auth": "Logged In", "method": "PUT", "registration": "1540919166796"}
    events = staging_events(spark, sf_dir).withColumns(
        {
            **{name: F.lit(value) for name, value in constants.items()},
            "iteminSession": F.lit(0),
            "status": F.lit(200),
            "userId": F.coalesce(F.col("userId").cast("string"), F.lit("")),
        }
    )
    log, catalogue = scratch_path(spark, "log"), scratch_path(spark, "catalogue")
    _write_json(events, log)
    _write_json(staging_songs(spark, sf_dir), catalogue)
    return star.run_star(spark, log, catalogue, _scratch_db(spark, "star"), ordered_ids=True)


def star_job(spark, sf_dir):
    """The published plays of the whole job."""
    return _job(spark, sf_dir).tables["songplays"].select("songplay_id", *star.PLAY_ORDER)


def _fingerprint(df: DataFrame, table: str) -> DataFrame:
    """Rows of a table, and the sum of a 32-bit checksum of each."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count("*").alias("num_rows"),
        F.coalesce(F.sum(number), F.lit(0)).alias("checksum"),
    )


def star_job_tables(spark, sf_dir):
    """Every published table of the whole job."""
    tables = _job(spark, sf_dir).tables
    tables["songplays"] = tables["songplays"].drop("songplay_id")
    return reduce(DataFrame.union, [_fingerprint(t, name) for name, t in tables.items()])


def star_job_checks(spark, sf_dir):
    """What the checks of the whole job found and repaired."""
    run = _job(spark, sf_dir)
    found = [
        (name, "|".join("~" if v is None else str(v) for v in row))
        for name, rows in run.duplicates.items()
        for row in rows
    ]
    found += [("repaired", name) for name in run.repaired]
    found += [("sentinels", str(run.sentinels))]
    found += [(name, str(count)) for name, count in run.audits.items()]
    # A few dozen rows: at most 40 duplicates and one per check.
    return spark.createDataFrame(found, "check_name string, found string")


# --- the life of a table ------------------------------------------------------------------


def table_life(spark, sf_dir):
    """Create, fill, append, truncate and drop; the tables and their rows after each step."""
    db = _scratch_db(spark, "life")
    schema = {t: _read(spark, sf_dir, t).schema for t in ("nation", "orders", "supplier")}
    seen = []

    def look(step: str) -> None:
        for name in list_tables(spark, db):
            rows = spark.table(f"{db}.{name}").agg(F.count("*").alias("num_rows"))
            # Written down now, since the next step changes the table.
            named = rows.select(F.lit(step).alias("step"), F.lit(name).alias("table_name"), "num_rows")
            seen.append(pin(named, "look"))

    buckets = {"orders": (4, ["o_orderkey"])}
    create_tables(spark, db, schema, buckets)
    create_tables(spark, db, schema, buckets)
    look("1 created")
    for name in schema:
        publish(_read(spark, sf_dir, name), f"{db}.{name}", bucket_by=buckets.get(name))
    publish(_read(spark, sf_dir, "orders"), f"{db}.orders", "append")
    look("2 filled")
    truncate_table(spark, f"{db}.orders")
    look("3 truncated")
    drop_tables(spark, db, ["supplier", "absent"])
    look("4 dropped")
    return reduce(DataFrame.union, seen)


def publish_append_bucketed(spark, sf_dir):
    """Line items stored by order, and appended once more in the same buckets."""
    table = f"{_scratch_db(spark, 'more')}.lineitem"
    lines = _read(spark, sf_dir, "lineitem")
    publish(lines, table, bucket_by=(4, ["l_orderkey"]), sort_by=["l_orderkey"])
    publish(lines, table, "append", sort_by=["l_orderkey"])
    return spark.table(table)


def scan_rejects(spark, sf_dir):
    """Events as JSON lines, every tenth cut off, every seventh with a user that is no number,
    every eleventh with a kind that is too long: typed rows, rejected lines with what is wrong,
    and whether a strict load refuses them."""
    events = _read(spark, sf_dir, "events")
    n = F.col("event_id")
    user = F.when(n % 7 == 0, F.concat(F.lit("u"), "user_id")).otherwise(F.col("user_id").cast("string"))
    label = F.when(n % 11 == 0, F.lit("much too long")).otherwise(F.lit("short"))
    whole = F.to_json(F.struct("event_id", user.alias("user"), label.alias("kind")))
    broken = F.concat(F.lit('{"event_id":'), n.cast("string"), F.lit(', "user'))
    path = scratch_path(spark, "broken")
    events.select(F.when(n % 10 == 0, broken).otherwise(whole)).write.text(path)
    mapping = [("$.event_id", "event_id", "bigint"), ("$.user", "user_id", "bigint"), ("$.kind", "kind", "string")]
    good, rejects = read_with_rejects(spark, path, mapping, lengths={"kind": 8})
    try:
        read_json_mapped(spark, path, mapping).write.format("noop").mode("overwrite").save()
        strict = "loaded"
    except (PySparkException, Py4JJavaError):
        strict = "refused"
    none, no_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    wrong = F.transform("problems", lambda p: F.concat_ws(" ", p["column"], p["value"], p["problem"]))
    return (
        good.select(F.lit("row").alias("kind"), "event_id", "user_id", no_text.alias("line"), no_text.alias("wrong"))
        .union(rejects.select(F.lit("reject"), none, none, "line", F.array_join(wrong, ", ")))
        .union(spark.range(1).select(F.lit("strict"), none, none, F.lit(strict), no_text))
    )


def surrogate_key_load_order_rows(spark, sf_dir):
    """Every row has one id of its own: ids per key, beside rows per key."""
    lines = _read(spark, sf_dir, "lineitem").select(LINE_KEY)
    return surrogate_key(lines, None, "line_id").groupBy(LINE_KEY).agg(
        F.count("*").alias("num_rows"), F.countDistinct("line_id").alias("num_ids")
    )


ALL: dict[str, Query] = {
    "scan_json_mapped": scan_json_mapped,
    "scan_json_auto": scan_json_auto,
    "scan_json_files_mapped": scan_json_files_mapped,
    "scan_json_files_auto": scan_json_files_auto,
    "cast_safe": cast_safe_,
    "filter_equals": filter_equals,
    "filter_not_null": filter_not_null,
    "distinct_rows": distinct_rows,
    "distinct_column": distinct_column,
    "dim_distinct": dim_distinct_,
    "max_per_key": max_per_key_,
    "latest_per_key": latest_per_key_,
    "latest_per_key_first": latest_per_key_first,
    "epoch_to_timestamp": epoch_to_timestamp_,
    "calendar_parts": calendar_parts_,
    "dim_time": dim_time_,
    "join_natural_key": join_natural_key_,
    "fact_build": fact_build_,
    "surrogate_key": surrogate_key_,
    "surrogate_key_load_order": surrogate_key_load_order,
    "count_non_null": count_non_null,
    "topk_join_agg": topk_join_agg_,
    "topk_join_agg_fanout": topk_join_agg_fanout,
    "topk_join_agg_unique": topk_join_agg_unique,
    "sort_mixed_nulls": sort_mixed_nulls,
    "sort_positions": sort_positions,
    "window_count": window_count,
    "window_count2": window_count2,
    "dup_check_window": dup_check_window_,
    "dup_check_window2": dup_check_window2,
    "dup_check_group": dup_check_group_,
    "dup_check_group_column": dup_check_group_column,
    "row_number_per_key": row_number_per_key_,
    "row_number_hot_key": row_number_hot_key,
    "dup_survivors": dup_survivors_,
    "dedupe_ordered": dedupe_ordered_,
    "delete_using_anti": delete_using_anti_,
    "delete_using_equality": delete_using_equality,
    "dedupe_delete_reinsert": dedupe_delete_reinsert_,
    "dedupe_null_keys": dedupe_null_keys,
    "sentinel_probe": sentinel_probe_,
    "sentinel_to_null": sentinel_to_null,
    "dq_unique": dq_unique_,
    "dq_not_null": dq_not_null_,
    "dq_max_length": dq_max_length_,
    "publish_swap": publish_swap,
    "publish_append_twice": publish_append_twice,
    "publish_bucketed": publish_bucketed,
    "star_songplays": star_songplays,
    "star_play_ids": star_play_ids,
    "star_users": star_users,
    "star_songs": star_songs,
    "star_artists": star_artists,
    "star_artists_clean": star_artists_clean,
    "star_time": star_time,
    "star_top_artists": star_top_artists,
    "star_top_artists_clean": star_top_artists_clean,
    "star_top_artists_unique": star_top_artists_unique,
    "star_users_duplicates": star_users_duplicates,
    "star_songs_duplicates": star_songs_duplicates,
    "star_artists_duplicates": star_artists_duplicates,
    "star_time_duplicates": star_time_duplicates,
    "star_songplays_duplicates": star_songplays_duplicates,
    "star_songplays_true_duplicates": star_songplays_true_duplicates,
    "star_year_zero": star_year_zero,
    "star_job": star_job,
    "star_job_tables": star_job_tables,
    "star_job_checks": star_job_checks,
    "table_life": table_life,
    "publish_append_bucketed": publish_append_bucketed,
    "scan_rejects": scan_rejects,
    "surrogate_key_load_order_rows": surrogate_key_load_order_rows,
}
