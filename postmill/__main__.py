"""Command line: ``python -m postmill ingest|judge|silver|models|reports|build``.

Each command is one Spark application. Tables carry over from one to the next only in
a catalog that outlives the session, such as a Hive metastore.
"""

from __future__ import annotations

import argparse
import logging

from postmill.plans.gold import TOP_TAGS
from postmill.plans.ingest import ingest
from postmill.plans.pipeline import (
    build_lakehouse,
    build_models,
    judge_posts,
    upsert_posts,
    write_reports,
)
from postmill.schemas import POSTS, USERS
from postmill.session import get_spark
from postmill.sinks import ensure_database
from postmill.sources import LAYOUTS

CONTRACTS = {"posts": POSTS, "users": USERS}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="postmill")
    root.add_argument("--warehouse-dir")
    root.add_argument("--format", default="parquet", dest="fmt")
    commands = root.add_subparsers(dest="command", required=True)

    one = commands.add_parser("ingest", help="one dump to a bronze table")
    one.add_argument("contract", choices=CONTRACTS)
    one.add_argument("path")
    one.add_argument("table", help="database.table")
    one.add_argument("--write-mode", default="overwrite", choices=("overwrite", "append"))
    one.add_argument("--quarantine-table")
    one.add_argument("--min-rows", type=int, default=1)
    one.add_argument("--batch", help="id of what is appended; a retry replaces it")

    whole = commands.add_parser("build", help="both dumps to gold tables and reports")
    whole.add_argument("posts")
    whole.add_argument("users")
    whole.add_argument("--bronze-db", default="bronze")
    whole.add_argument("--quarantine", action="store_true")

    judge = commands.add_parser("judge", help="bronze posts to valid and quarantined ones")
    judge.add_argument("posts_table", help="name or path")
    judge.add_argument("valid_table")
    judge.add_argument("quarantine_table")

    staged = commands.add_parser("silver", help="bronze posts into the silver table, by key")
    staged.add_argument("posts_table", help="name or path")
    staged.add_argument("table")
    staged.add_argument("--full-refresh", action="store_true")

    models = commands.add_parser("models", help="bronze tables to gold tables")
    models.add_argument("posts_table", help="name or path")
    models.add_argument("users_table", help="name or path")
    reports = commands.add_parser("reports", help="gold tables to report tables")

    for command in (one, whole):
        command.add_argument("--row-tag", default="row")
        command.add_argument("--layout", default="lines", choices=LAYOUTS)
    for command in (judge, staged, whole, models):
        command.add_argument("--types", help="CSV seed of post types: post_type_id, post_type")
    for command in (whole, models):
        command.add_argument("--top-tags", type=int, default=TOP_TAGS)
    for command in (whole, models, reports):
        command.add_argument("--gold-db", default="gold")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = get_spark(warehouse_dir=args.warehouse_dir)
    if args.command == "ingest":
        database, _, name = args.table.rpartition(".")
        if not database or not name:
            raise SystemExit("the table must be named database.table")
        ensure_database(spark, database)
        rows = ingest(
            spark,
            args.path,
            args.table,
            CONTRACTS[args.contract],
            args.row_tag,
            args.write_mode,
            args.layout,
            args.quarantine_table,
            args.min_rows,
            args.fmt,
            args.batch,
        )
        print(f"{args.table}: {rows} rows")
    elif args.command == "judge":
        judge_posts(
            spark, args.posts_table, args.valid_table, args.quarantine_table, args.fmt, args.types
        )
    elif args.command == "silver":
        upsert_posts(
            spark, args.posts_table, args.table, args.full_refresh, args.fmt, args.types
        )
    elif args.command == "models":
        ensure_database(spark, args.gold_db)
        build_models(
            spark,
            args.posts_table,
            args.users_table,
            args.gold_db,
            args.top_tags,
            args.fmt,
            args.types,
        )
    elif args.command == "reports":
        show(write_reports(spark, args.gold_db, args.fmt))
    else:
        built = build_lakehouse(
            spark,
            args.posts,
            args.users,
            args.bronze_db,
            args.gold_db,
            args.row_tag,
            args.layout,
            args.top_tags,
            args.quarantine,
            args.fmt,
            args.types,
        )
        for table, rows in built.rows.items():
            print(f"{table}: {rows} rows")
        show(built.reports)


def show(reports) -> None:
    for name, report in reports.items():
        print(name)
        report.show(max(1, report.count()), truncate=False)


if __name__ == "__main__":
    main()
