"""Command line, with spark-submit or plain python.

    spark-submit starloom/job.py create   --db music [--buckets N] [--scale N]
    spark-submit starloom/job.py load     --db music --log PATH --catalogue PATH
    spark-submit starloom/job.py check    --db music
    spark-submit starloom/job.py report   --db music
    spark-submit starloom/job.py truncate --db music
    spark-submit starloom/job.py clean    --db music
    spark-submit starloom/job.py finish   --db music
    spark-submit starloom/job.py undo     --db music

``load`` builds, checks, repairs and publishes the star schema and ends with the report;
the others work on tables an earlier run left in the session's catalogue. ``clean`` deletes the
files of replaced rows. ``finish`` completes the changes that a stopped load has left, ``undo``
takes them back; the next ``load`` does the former by itself.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

if __name__ == "__main__":  # started as a file: the package lies in the folder above
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starloom.plans import schemas, star  # noqa: E402
from starloom.session import SETTINGS  # noqa: E402
from starloom.sinks import (  # noqa: E402
    clean_old,
    create_tables,
    finish_pending,
    truncate_table,
    undo_pending,
)
from starloom.sources import drop_tables, list_tables  # noqa: E402


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="starloom")
    commands = root.add_subparsers(dest="command", required=True)
    for name in ("create", "load", "check", "report", "truncate", "clean", "finish", "undo"):
        commands.add_parser(name).add_argument("--db", required=True)
    create, load = commands.choices["create"], commands.choices["load"]
    for command in (create, load):
        command.add_argument("--scale", type=int, default=0, help="decimal digits to keep")
        command.add_argument("--buckets", type=int, help="buckets of songplays and songs")
    load.add_argument("--log", required=True, help="folder of the event log (JSON lines)")
    load.add_argument("--catalogue", required=True, help="folder of the song catalogue (JSON)")
    load.add_argument("--log-paths", help="JSONPaths file that maps the log to its columns")
    load.add_argument("--append", action="store_true", help="add to the tables")
    load.add_argument(
        "--tolerant", action="store_true", help="set lines with an error and incomplete plays aside"
    )
    ids = load.add_mutually_exclusive_group()
    ids.add_argument("--ordered-ids", action="store_true", help="number the plays in a fixed order")
    ids.add_argument("--unordered-ids", action="store_true", help="number them as they lie (default)")
    load.add_argument("--keep-duplicates", action="store_true")
    load.add_argument(
        "--repair", nargs="+", default=["artists"], choices=sorted(star.REPAIRS),
        help="dimensions to remove rows with a repeated key from",
    )
    load.add_argument("--keep-sentinels", action="store_true")
    load.add_argument("--keep-staging", action="store_true")
    commands.choices["report"].add_argument("--mode", default="reference", choices=["reference", "unique"])
    return root


def create(spark: SparkSession, db: str, scale: int = 0, buckets: int | None = None) -> None:
    """Start over: drop the seven tables where any exist, and create them empty."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tables = schemas.all_tables(scale)
    if list_tables(spark, db):
        drop_tables(spark, db, list(tables))
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    create_tables(spark, db, tables, star.layout(buckets))


def show_checks(duplicates: dict[str, list]) -> None:
    for name, found in duplicates.items():
        print(f"{name}: {'no duplicates' if not found else [tuple(r) for r in found]}")


def show_report(spark: SparkSession, db: str, mode: str = "reference") -> None:
    plays, artists = spark.table(f"{db}.songplays"), spark.table(f"{db}.artists")
    for row in star.top_artists(plays, artists, mode=mode).collect():
        print(tuple(row))


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "create":
        create(spark, args.db, args.scale, args.buckets)
    elif args.command in ("truncate", "clean"):
        work = truncate_table if args.command == "truncate" else clean_old
        for name in [t for t in list_tables(spark, args.db) if t in schemas.all_tables()]:
            work(spark, f"{args.db}.{name}")
    elif args.command in ("finish", "undo"):
        work = finish_pending if args.command == "finish" else undo_pending
        print(f"{args.command}: {', '.join(work(spark, args.db)) or 'nothing'}")
    elif args.command == "check":
        tables = {name: spark.table(f"{args.db}.{name}") for name in star.STAR}
        show_checks({n: c.collect() for n, c in star.duplicate_checks(tables).items()})
    elif args.command == "report":
        show_report(spark, args.db, args.mode)
    else:
        done = star.run_star(
            spark,
            args.log,
            args.catalogue,
            args.db,
            log_paths_file=args.log_paths,
            scale=args.scale,
            buckets=args.buckets,
            load_mode="PERMISSIVE" if args.tolerant else "FAILFAST",
            remove_duplicates=not args.keep_duplicates,
            repair=args.repair,
            clean_sentinels=not args.keep_sentinels,
            drop_staging=not args.keep_staging,
            append=args.append,
            ordered_ids=args.ordered_ids,
        )
        show_checks(done.duplicates)
        for name, count in {**done.audits, **done.rejected}.items():
            print(f"{name}: {count} rows")
        print(f"repaired: {', '.join(done.repaired) or 'nothing'}")
        show_report(spark, args.db)


def main() -> None:
    args = parser().parse_args()
    builder = SparkSession.builder.appName(f"starloom-{args.command}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
