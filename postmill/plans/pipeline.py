"""The whole build: two dumps to bronze, silver views, gold tables and reports."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from postmill.operators.quality import (
    WARN,
    CheckFailed,
    RowRule,
    TableChecks,
    enforce,
    key_grain,
    rule_in_list,
    rule_not_in_future,
    rule_not_null,
    split_by_rules,
    validate_stage,
)
from postmill.plans import gold, reports, silver
from postmill.plans.ingest import ingest
from postmill.schemas import AUTHOR_STATUSES, POSTS, USERS
from postmill.session import pin_utc
from postmill.sinks import ensure_database, materialize_view, upsert_table, write_table
from postmill.sources import post_types, read_table

logger = logging.getLogger(__name__)

T = TypeVar("T")

# Reports are small next to the tables they read: a few at a time keep a cluster busy.
CONCURRENT_JOBS = 4

# What each model promises.
CHECKS = {
    "post_types": TableChecks(
        not_null=("post_type_id", "post_type"), unique=("post_type_id",)
    ),
    "stg_posts": TableChecks(
        not_null=("post_id", "post_type_id", "post_type"),
        unique=("post_id",),
        no_empty_arrays=("tags_array",),
    ),
    "stg_users": TableChecks(
        not_null=("user_id", "display_name", "reputation"), unique=("user_id",)
    ),
    "marts_top_tags": TableChecks(not_null=("tag", "post_count"), unique=("tag",)),
    "marts_posts_users": TableChecks(
        not_null=("post_id", "author_status", "post_type"),
        unique=("post_id",),
        accepted=(("author_status", tuple(AUTHOR_STATUSES)),),
    ),
}


@dataclass
class Build:
    """What a build produced: row counts and the report tables."""

    rows: dict[str, int] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)


def run_together(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Submit independent jobs at once, so that one fills the cluster while another drains.

    Waits for all of them; the first failure, in the order given, is raised.
    """
    with ThreadPoolExecutor(min(len(jobs), CONCURRENT_JOBS)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in started]


def build_lakehouse(
    spark: SparkSession,
    posts_path: str,
    users_path: str,
    bronze_db: str = "bronze",
    gold_db: str = "gold",
    row_tag: str = "row",
    layout: str = "lines",
    top_tags_limit: int = gold.TOP_TAGS,
    quarantine: bool = False,
    fmt: str = "parquet",
    types_seed: str | None = None,
) -> Build:
    """Run every job in order; a model that breaks a promise stops the build."""
    pin_utc(spark)
    for database in (bronze_db, gold_db):
        ensure_database(spark, database)
    build = Build()
    posts_table, users_table = f"{bronze_db}.posts", f"{bronze_db}.users"

    def load(path, table, schema):
        refused = f"{table}_quarantine" if quarantine else None
        return ingest(
            spark, path, table, schema, row_tag, layout=layout, quarantine_table=refused, fmt=fmt
        )

    posts_rows, users_rows = run_together(
        spark,
        lambda: load(posts_path, posts_table, POSTS),
        lambda: load(users_path, users_table, USERS),
    )
    build.rows = {posts_table: posts_rows, users_table: users_rows}
    build_models(spark, posts_table, users_table, gold_db, top_tags_limit, fmt, types_seed)
    build.reports = write_reports(spark, gold_db, fmt)
    return build


def build_models(
    spark: SparkSession,
    posts_table: str,
    users_table: str,
    gold_db: str = "gold",
    top_tags_limit: int = gold.TOP_TAGS,
    fmt: str = "parquet",
    types_seed: str | None = None,
) -> None:
    """Silver views and gold tables from the bronze tables.

    A bronze table is given by name, or by the path of its files. Each gold table is checked
    before it takes the place of the one before it.
    """
    posts, users = read_table(spark, posts_table, fmt), read_table(spark, users_table, fmt)
    types = post_types(spark, types_seed)
    enforce(types, CHECKS["post_types"], "post_types")

    stg_posts = materialize_view(silver.stg_posts(posts, types), "stg_posts")
    stg_users = materialize_view(silver.stg_users(users), "stg_users")
    run_together(
        spark,
        lambda: enforce(stg_posts, CHECKS["stg_posts"], "stg_posts"),
        lambda: enforce(stg_users, CHECKS["stg_users"], "stg_users"),
    )

    # The check above found every post_id once, so tags can be counted by row.
    ranking = gold.top_tags(stg_posts, top_tags_limit, unique_posts=True)
    wide = gold.posts_users(stg_posts, stg_users)

    def store(df, model, check=lambda table, built: None):
        table = f"{gold_db}.{model}"

        def judge(staging):
            enforce(spark.table(staging), CHECKS[model], table)
            check(table, spark.table(staging))

        write_table(df, table, fmt=fmt, before_swap=judge)
        logger.info("%s built", table)

    def same_grain(table, built):
        counted = key_grain(posts, built, "Id", "post_id").first()
        if not counted["same_grain"]:
            raise CheckFailed(
                f"{table}: {counted['result_rows']} rows from {counted['source_rows']} posts, or other posts"
            )

    run_together(
        spark,
        lambda: store(ranking, "marts_top_tags"),
        lambda: store(wide, "marts_posts_users", same_grain),
    )


def post_rules(types: list[int], as_of: Column | None = None) -> list[RowRule]:
    """What a post must satisfy: it has an id and a date that is not in the future.

    A type outside ``types`` is a warning only.
    """
    return [
        *rule_not_null(["Id", "CreationDate"]),
        rule_not_in_future("CreationDate", as_of),
        rule_in_list("PostTypeId", types, level=WARN),
    ]


def judge_posts(
    spark: SparkSession,
    posts_table: str,
    valid_table: str,
    quarantine_table: str,
    fmt: str = "parquet",
    types_seed: str | None = None,
    as_of: Column | None = None,
) -> None:
    """Split bronze posts by the row rules into two tables that together hold them all."""
    posts = read_table(spark, posts_table, fmt)
    types = [row["post_type_id"] for row in post_types(spark, types_seed).collect()]
    valid, refused = split_by_rules(posts, post_rules(types, as_of))
    # Refused rows first: a row is never in neither table.
    write_table(refused, quarantine_table, fmt=fmt)
    write_table(valid, valid_table, fmt=fmt)


def upsert_posts(
    spark: SparkSession,
    posts_table: str,
    table: str,
    full_refresh: bool = False,
    fmt: str = "parquet",
    types_seed: str | None = None,
) -> None:
    """Bring the silver table of posts up to date with bronze posts, by post id."""
    staged = silver.stg_posts(read_table(spark, posts_table, fmt), post_types(spark, types_seed))
    if messages := validate_stage(staged):
        raise CheckFailed(f"{table}: {', '.join(messages)}")
    upsert_table(staged, table, "post_id", full_refresh=full_refresh, fmt=fmt)


def write_reports(
    spark: SparkSession, gold_db: str = "gold", fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Store every report as a table; nothing is written when there is nothing to report.

    The wide table is read four times: for the headline figures, the years, the authors,
    and the counts by status and band. The other reports follow from what these stored.
    """
    gold, tags = spark.table(f"{gold_db}.marts_posts_users"), spark.table(f"{gold_db}.marts_top_tags")

    def store(name, report, check=None):
        write_table(report, f"{gold_db}.{name}", fmt=fmt, before_swap=check)

    def stored(name):
        return spark.table(f"{gold_db}.{name}")

    def store_all(tables):
        jobs = [lambda name=name, report=report: store(name, report) for name, report in tables.items()]
        run_together(spark, *jobs)

    # Refuses before any report is replaced.
    store("report_kpis", reports.gold_kpis(gold, tags), lambda staging: reports.require_reportable(spark.table(staging)))
    store_all(reports.base_reports(gold, tags))
    store_all(reports.derived_reports({name: stored(name) for name in reports.SOURCES}))
    return {name: stored(name) for name in reports.REPORTS}
