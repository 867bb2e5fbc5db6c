"""Managed table writes.

Every full overwrite of a file table goes to a folder of its own, a version, beside the
others of its table. Publishing it is one change of the catalog, ``ALTER TABLE .. SET
LOCATION``: no file is renamed or copied, a reader sees the old table or the new one,
never a missing or a mixed one, and a failed job leaves the table as it was. The version
before stays until the next overwrite, for readers that have begun. The partitions of such
a table are found in its folder and not kept in the catalog, so that they change with it.

When an overwrite changes the columns, the partitioning or the format, or meets a table that
was not written here, the table is made anew: a change of the catalog alone as well, but
of two steps, and should the driver die between them the next run completes it.

A format with its own transactions (``fmt="delta"``, when it is on the class path) is
overwritten directly and keeps its history. That branch has not been run: no such jar is
present.

A table has one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

WRITE_MODES = ("overwrite", "append")
TRANSACTIONAL = ("delta",)
KEPT_VERSIONS = 1  # beside the one in use

_STAGING = "__staging_"
_NEXT = "__next_"  # written and checked, about to be published
_PREVIOUS = "__previous_"
_VERSIONS = "__versions"


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Register a silver model as a view: nothing is computed or stored."""
    df.createOrReplaceTempView(name)
    return df


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    before_swap: Callable[[str], None] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    dealt: bool = False,
) -> None:
    """Write a managed table; ``overwrite`` also replaces its schema.

    ``before_swap`` gets the name of a table with the new data, once that is written and
    before it becomes visible: raising there leaves the table untouched, an append undone.
    Without it an append, and any write of a transactional format, goes straight in.

    ``bucket_by`` (a number, columns) deals a file table into sorted buckets: joins,
    groupings and uniqueness checks on these columns then shuffle nothing of it. With ``dealt``
    the rows of each bucket are in one task already and are not shuffled for the write.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    spark = df.sparkSession
    table = qualified(spark, table)
    direct = mode == "append" or fmt in TRANSACTIONAL
    if direct and before_swap is None:
        _direct(df, mode, fmt, partition_by, table)
        return
    if not direct:
        recover_table(spark, table)
    run = run_id()
    staging = table + _STAGING + run
    if direct:
        _writer(df, "overwrite", "parquet", partition_by).saveAsTable(staging)
    else:
        _store_version(df, table, staging, run, fmt, partition_by, bucket_by, dealt)
    try:
        if before_swap is not None:
            before_swap(staging)
        if direct:
            _direct(spark.table(staging), mode, fmt, partition_by, table)
    except Exception:
        location = None if direct else details(spark, staging)["Location"]
        spark.sql(f"DROP TABLE {staging}")
        if location is not None:
            _delete(spark, location)
        raise
    if direct:
        spark.sql(f"DROP TABLE {staging}")
    else:
        checked = table + _NEXT + run
        spark.sql(f"ALTER TABLE {staging} RENAME TO {checked}")
        _publish(spark, table, checked)


def run_id() -> str:
    """A number for what one run writes beside its target; later runs have larger ones."""
    return f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def qualified(spark: SparkSession, table: str) -> str:
    return table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"


def leftovers(spark: SparkSession, table: str, suffix: str) -> list[str]:
    """Tables that runs have left beside ``table``."""
    database, _, name = table.rpartition(".")
    found = spark.catalog.listTables(database or None)
    start = (name + suffix).lower()
    return sorted(f"{database}.{t.name}" if database else t.name for t in found if t.name.lower().startswith(start))


def recover_table(spark: SparkSession, table: str) -> None:
    """Put right what an earlier run left behind if it died while it published.

    Its staging table stays, as it can't be told from that of a run still at work.
    """
    for checked in leftovers(spark, table, _NEXT):
        _publish(spark, table, checked)
    # Left by a swap of two renames, as it was done before there were versions.
    previous = leftovers(spark, table, _PREVIOUS)
    if previous and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {previous.pop()} RENAME TO {table}")
    for old in previous:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """The number and columns of a table's buckets, None without."""
    told = details(spark, table)
    if "Num Buckets" not in told:
        return None
    return int(told["Num Buckets"]), [c.strip("` ") for c in told["Bucket Columns"].strip("[]").split(",")]


def details(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table: Provider, Location, Type and so on."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    begin = next((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed")), len(rows))
    return {r["col_name"]: r["data_type"] for r in rows[begin + 1 :] if r["col_name"]}


def untracked(spark: SparkSession) -> SparkSession:
    """A session for DDL: tables it makes find their partitions in their folder.

    A session of its own shares the catalog, and no other thread sees the setting.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    return own


def _versions_folder(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}{_VERSIONS}"


def _store_version(
    df: DataFrame,
    table: str,
    staging: str,
    run: str,
    fmt: str,
    partition_by: Sequence[str],
    bucket_by: tuple[int, Sequence[str]] | None,
    dealt: bool,
) -> None:
    """Write a version into its folder, with an external table over it."""
    spark = df.sparkSession
    location = f"{_versions_folder(spark, table)}/{run}"
    names = ", ".join(f"`{c}`" for c in partition_by)
    columns = StructType([StructField(f.name, f.dataType) for f in df.schema])
    ddl = f"CREATE TABLE {staging} ({columns.toDDL()}) USING {fmt}"
    if partition_by:
        ddl += f" PARTITIONED BY ({names})"
    if bucket_by:
        keys = ", ".join(f"`{c}`" for c in bucket_by[1])
        ddl += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {bucket_by[0]} BUCKETS"
    untracked(spark).sql(f"{ddl} LOCATION '{location}'")
    try:
        rows = df.select(*[f"`{c}`" for c in spark.table(staging).columns])
        if bucket_by:
            # One task for each bucket, or each task would write a file for all of them.
            rows = rows if dealt else rows.repartition(bucket_by[0], *bucket_by[1])
        else:
            rows = cluster_for(rows, partition_by)
        rows.write.insertInto(staging)
    except BaseException:
        spark.sql(f"DROP TABLE {staging}")
        _delete(spark, location)
        raise


def _shape(spark: SparkSession, table: str) -> tuple:
    """What of a table a change of its location cannot change."""
    told = details(spark, table)
    keys = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns", "Partition Provider")
    return (spark.table(table).schema.json(), partition_columns(spark, table), *[told.get(k) for k in keys])


def _publish(spark: SparkSession, table: str, checked: str) -> None:
    """Make the version under ``checked`` the content of ``table``; may be run again."""
    location = details(spark, checked)["Location"]
    before = None
    if spark.catalog.tableExists(table):
        known = details(spark, table)
        before = known["Location"]
        ours = f"/{table.rpartition('.')[2]}{_VERSIONS}/" in before
        if before != location and not (ours and _shape(spark, table) == _shape(spark, checked)):
            if ours:  # dropping a managed table deletes what is at its location
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}__none'")
            spark.sql(f"DROP TABLE {table}")
            before = before if ours else None
    if not spark.catalog.tableExists(table):
        untracked(spark).sql(f"CREATE TABLE {table} LIKE {checked}")
    if details(spark, table)["Location"] != location:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE {checked}")
    _drop_versions(spark, table, location, before)


def _drop_versions(spark: SparkSession, table: str, location: str, before: str | None) -> None:
    """Delete versions older than the one in use, but for the last of them."""
    names = sorted(_folders(spark, _versions_folder(spark, table)))
    current = location.rstrip("/").rpartition("/")[2]
    older = [n for n in names if n < current]
    for name in older[: max(0, len(older) - KEPT_VERSIONS)]:
        _delete(spark, f"{_versions_folder(spark, table)}/{name}")


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _folders(spark: SparkSession, path: str) -> list[str]:
    files, path = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []


def _delete(spark: SparkSession, path: str) -> None:
    files, path = _file_system(spark, path)
    files.delete(path, True)


def _direct(df: DataFrame, mode: str, fmt: str, partition_by: Sequence[str], table: str) -> None:
    writer = _writer(df, mode, fmt, partition_by)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(table)


def cluster_for(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, so that it gets few files.

    AQE sizes the tasks of a rebalance: a large partition is split over several.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _writer(df: DataFrame, mode: str, fmt: str, partition_by: Sequence[str]):
    writer = cluster_for(df, partition_by).write.mode(mode).format(fmt)
    return writer.partitionBy(*partition_by) if partition_by else writer
