"""Publishing results as Parquet tables.

Replacing a table writes a complete second set of files and then changes the table's location,
in one statement: a job may read the table it replaces, a job that stops anywhere leaves the
old rows or the new ones, and readers at work keep the files they planned with. Replaced
files stay until :func:`clean_old` is called.

Several tables are published together by :func:`publish_all`: all files are written first, then
the changes follow each other. What is to be changed is noted as a property of the database, so
a run that stops can be finished, or undone, by the next.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.sinks.scratch import remove_folder

Bucketing = tuple[int, Sequence[str]]


def _database(spark: SparkSession, table: str) -> tuple[str, str]:
    db, _, name = table.rpartition(".")
    return db or spark.catalog.currentDatabase(), name


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    # Later rows win: the storage details follow the columns.
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def table_buckets(spark: SparkSession, table: str) -> Bucketing | None:
    """(number of buckets, bucket columns) of a table, or None."""
    details = _details(spark, table)
    if "Num Buckets" not in details:
        return None
    names = details["Bucket Columns"].strip("[]").replace("`", "").split(",")
    return int(details["Num Buckets"]), [n.strip() for n in names]


def _laid_out(df: DataFrame, bucket_by: Bucketing | None, sort_by: Sequence[str]) -> DataFrame:
    """Spread rows over output files.

    Bucketed output uses a rebalance instead of a plain repartition by key: adaptive
    execution cuts an oversized bucket into several files, so a hot key does not end
    up in a single writer. With a multiple of the buckets as shuffle partitions each
    writer serves one bucket. Sorted output ranges over the key and the input partition,
    for the same reason.
    """
    if bucket_by:
        return df.hint("rebalance", *bucket_by[1])
    if sort_by:
        spread = df.withColumn("_from", F.spark_partition_id())
        ranges = spread.repartitionByRange(*sort_by, "_from")
        return ranges.sortWithinPartitions(*sort_by).drop("_from")
    return df


def columns_differ(df: DataFrame, table: DataFrame) -> bool:
    return [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in table.schema]


def check_layout(
    df: DataFrame, table: str, bucket_by: Bucketing | None = None, buckets_too: bool = True
) -> None:
    """Refuse rows that an existing table cannot take as they are."""
    spark = df.sparkSession
    if columns_differ(df, spark.table(table)):
        raise ValueError(f"columns differ from those of {table}; drop it first")
    wanted = (bucket_by[0], list(bucket_by[1])) if bucket_by else None
    if buckets_too and table_buckets(spark, table) != wanted:
        raise ValueError(f"buckets differ from those of {table}; drop it first")


def publish(
    df: DataFrame,
    table: str,
    mode: str = "swap",
    bucket_by: Bucketing | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Write ``df`` to a table.

    ``mode="swap"`` (default) replaces the rows, so running a job twice gives the same
    table; ``"append"`` adds to them, in the buckets the table has. ``bucket_by=(buckets,
    columns)`` stores rows by key hash, so that joins and groupings on the key need no
    shuffle; with ``sort_by`` alone files cover disjoint key ranges and scans skip by
    their min/max. An existing table keeps its columns and buckets: rows of other columns,
    other types or another decimal scale are refused in either mode, before anything is
    written.
    """
    spark = df.sparkSession
    if mode not in ("swap", "append"):
        raise ValueError(f"mode must be 'swap' or 'append', not {mode!r}")
    if not spark.catalog.tableExists(table):
        _write(df, table, bucket_by, sort_by)
        return
    if mode == "append":
        check_layout(df, table, buckets_too=False)
        _laid_out(df, table_buckets(spark, table), sort_by).write.insertInto(table)
        return
    check_layout(df, table, bucket_by)
    change = _planned(spark, table, "swap")
    _fill(change, df, bucket_by, sort_by)
    _apply(spark, change)


#: Table property that lists the folders of replaced rows.
REPLACED = "starloom.replaced"


def _write(
    df: DataFrame,
    table: str,
    bucket_by: Bucketing | None,
    sort_by: Sequence[str],
    folder: str | None = None,
) -> None:
    writer = _laid_out(df, bucket_by, sort_by).write.format("parquet")
    if folder:
        writer = writer.option("path", folder)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1])
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)


@dataclass
class Change:
    """A table that is to get the files of a folder: instead of its own (swap) or beside them."""

    table: str
    mode: str
    folder: str
    old: str
    properties: dict[str, str] = field(default_factory=dict)
    # What the names of the written files share.
    written: str = ""


@dataclass
class Work:
    """Rows for a table that exists, see :func:`publish`; ``describe`` gives properties of the
    table that belong to them, from the written rows."""

    table: str
    frame: DataFrame
    mode: str = "swap"
    bucket_by: Bucketing | None = None
    sort_by: Sequence[str] = ()
    describe: Callable[[DataFrame], dict[str, str]] | None = None


#: Database property that holds the changes under way.
PENDING = "starloom.pending"


def _planned(spark: SparkSession, table: str, mode: str) -> Change:
    db, name = _database(spark, table)
    folder = f"{_location(spark, db)}/{name}__{uuid.uuid4().hex}"
    return Change(f"{db}.{name}", mode, folder, _details(spark, table)["Location"])


def _passing(change: Change) -> str:
    """The external table that writes a folder: dropping it, at the end or after a stop, leaves
    the files alone."""
    return f"{change.table.rpartition('.')[0]}.{change.folder.rpartition('/')[2]}"


def _fill(change: Change, df: DataFrame, bucket_by: Bucketing | None, sort_by: Sequence[str]) -> None:
    _write(df, _passing(change), bucket_by, sort_by, change.folder)
    _, files = _files(df.sparkSession, change.folder)
    shared = re.match(r"part-[0-9]+-([0-9a-f-]{36})", files[0].getName()) if files else None
    change.written = shared[1] if shared else ""


def _set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def _apply(spark: SparkSession, change: Change) -> None:
    """Make a change; one that was made already, or in part, is completed."""
    if change.properties:
        _set_properties(spark, change.table, change.properties)
    if change.mode == "append":
        _move_files(spark, change.folder, change.old)
    elif _details(spark, change.table)["Location"] != change.folder:
        kept = dict.fromkeys([*_replaced(spark, change.table), change.old])
        # Recorded first: a folder listed too early is still the table's own and is not cleaned.
        _set_properties(spark, change.table, {REPLACED: ",".join(kept)})
        spark.sql(f"ALTER TABLE {change.table} SET LOCATION '{change.folder}'")
    spark.catalog.refreshTable(change.table)
    spark.sql(f"DROP TABLE IF EXISTS {_passing(change)}")


def _files(spark: SparkSession, folder: str) -> tuple[object, list]:
    """The file system of a folder, and the data files in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath() for status in system.listStatus(path)] if system.exists(path) else []
    return system, [f for f in found if f.getName().startswith("part-")]


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move data files between folders of one file system; their names are unique."""
    system, files = _files(spark, source)
    for file in files:
        goal = spark._jvm.org.apache.hadoop.fs.Path(target, file.getName())
        if not system.rename(file, goal):
            raise OSError(f"cannot move {file} to {goal}")
    remove_folder(spark, source)


def _note(spark: SparkSession, db: str, changes: Sequence[Change], ready: bool) -> None:
    text = json.dumps({"ready": ready, "changes": [asdict(c) for c in changes]}) if changes else ""
    coded = base64.b64encode(text.encode()).decode()
    spark.sql(f"ALTER DATABASE {db} SET DBPROPERTIES ('{PENDING}' = '{coded}')")


def pending(spark: SparkSession, db: str) -> tuple[bool, list[Change]]:
    """Whether all files of the changes under way are written, and these changes."""
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {db}").collect()}
    coded = re.search(rf"\({re.escape(PENDING)},([^)]*)\)", rows.get("Properties", ""))
    if not coded or not coded[1]:
        return False, []
    noted = json.loads(base64.b64decode(coded[1]))
    return noted["ready"], [Change(**c) for c in noted["changes"]]


def publish_all(spark: SparkSession, db: str, works: Sequence[Work]) -> None:
    """Publish rows for several tables of a database together.

    All files are written before the first table changes. A run that stops before leaves all
    old rows, a run that stops later leaves changes that :func:`finish_pending` completes, or
    :func:`undo_pending` takes back. Appended files are moved into the table's folder.
    """
    finish_pending(spark, db)
    changes = []
    for w in works:
        buckets_too = w.mode == "swap"
        check_layout(w.frame, w.table, w.bucket_by, buckets_too)
        changes.append(_planned(spark, w.table, w.mode))
    _note(spark, db, changes, False)
    for w, change in zip(works, changes):
        buckets = table_buckets(spark, w.table) if w.mode == "append" else w.bucket_by
        _fill(change, w.frame, buckets, w.sort_by)
        if w.describe:
            written = spark.read.schema(w.frame.schema).parquet(change.folder)
            change.properties.update(w.describe(written))
    _note(spark, db, changes, True)
    finish_pending(spark, db)


def finish_pending(spark: SparkSession, db: str) -> list[str]:
    """Complete the changes a stopped run has noted, or remove their files if not all of them
    were written; returns the tables that were changed."""
    ready, changes = pending(spark, db)
    for change in changes:
        if ready:
            _apply(spark, change)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {_passing(change)}")
            remove_folder(spark, change.folder)
    if changes:
        _note(spark, db, [], False)
    return [c.table for c in changes] if ready else []


def undo_pending(spark: SparkSession, db: str) -> list[str]:
    """Take back the changes a stopped run has noted; returns their tables. Properties that it
    has set stay."""
    _, changes = pending(spark, db)
    for change in changes:
        if change.mode == "swap":
            if _details(spark, change.table)["Location"] == change.folder:
                spark.sql(f"ALTER TABLE {change.table} SET LOCATION '{change.old}'")
            remove_folder(spark, change.folder)
        else:
            _take_back(spark, change)
        spark.sql(f"DROP TABLE IF EXISTS {_passing(change)}")
        spark.catalog.refreshTable(change.table)
    if changes:
        _note(spark, db, [], False)
    return [c.table for c in changes]


def _take_back(spark: SparkSession, change: Change) -> None:
    """Delete the files of an append, wherever a stopped run has left them."""
    system, present = _files(spark, change.old)
    for file in present:
        if change.written and change.written in file.getName():
            system.delete(file, False)
    remove_folder(spark, change.folder)


def create_empty(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    bucket_by: Bucketing | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Create a table without rows, and without a job."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = ""
    if bucket_by:
        keys = ", ".join(f"`{c}`" for c in bucket_by[1])
        order = f" SORTED BY ({', '.join(f'`{c}`' for c in sort_by)})" if sort_by else ""
        layout = f" CLUSTERED BY ({keys}){order} INTO {bucket_by[0]} BUCKETS"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{layout}")


def _location(spark: SparkSession, db: str) -> str:
    rows = spark.sql(f"DESCRIBE DATABASE {db}").collect()
    return next(r[1] for r in rows if r[0] == "Location").rstrip("/")


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _replaced(spark: SparkSession, table: str) -> list[str]:
    return [f for f in table_properties(spark, table).get(REPLACED, "").split(",") if f]


def clean_old(spark: SparkSession, table: str) -> list[str]:
    """Delete the files of replaced rows, when no reader needs them any more; returns the
    folders. The table's own folder is never among them."""
    own = _details(spark, table)["Location"]
    gone = [f for f in dict.fromkeys(_replaced(spark, table)) if f.rstrip("/") != own.rstrip("/")]
    for folder in gone:
        remove_folder(spark, folder)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{REPLACED}')")
    return gone


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all its files. Those of replaced rows go first: the oldest lie where a
    new table of that name would be created."""
    clean_old(spark, table)
    spark.sql(f"DROP TABLE {table}")


def create_tables(
    spark: SparkSession,
    db: str,
    schemas: Mapping[str, T.StructType],
    buckets: Mapping[str, Bucketing] | None = None,
) -> list[str]:
    """Create the tables that do not exist yet, empty; returns their names."""
    missing = [t for t in schemas if not spark.catalog.tableExists(f"{db}.{t}")]
    for name in missing:
        empty = spark.createDataFrame([], schemas[name])
        publish(empty, f"{db}.{name}", bucket_by=(buckets or {}).get(name))
    return missing


def truncate_table(spark: SparkSession, table: str) -> None:
    """Leave a table without rows."""
    existing = spark.table(table)
    publish(
        spark.createDataFrame([], existing.schema),
        table,
        bucket_by=table_buckets(spark, table),
    )
