"""Keyed upsert into a managed table.

On a table format with row-level changes this is one ``MERGE``. On plain files rows
cannot be changed in place, so the merged rows are written anew: only the touched
partitions when the table is partitioned by one column and no row changes partition,
otherwise the whole table. Either way a rerun with the same source changes nothing.

A whole rewrite is published at once, see :mod:`postmill.sinks.tables`. Partitions are put in
place one after the other. Their merged rows are stored first, with a journal of the files
that they were merged from. Should the driver die in between, the next upsert finishes the work, but
only on the very table that the journal describes: if anything else has been written to it
since, the rewrite is dropped with a warning, and what the journal knows nothing of stays.
"""

from __future__ import annotations

import logging
import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators.merge import merge_rows
from postmill.operators.quality import fingerprint
from postmill.sinks.tables import (
    TRANSACTIONAL,
    bucketing,
    cluster_for,
    details,
    leftovers,
    partition_columns,
    qualified,
    recover_table,
    run_id,
    write_table,
)

logger = logging.getLogger(__name__)

_INCOMING = "__incoming_"
_JOURNAL = "__journal_"
_REWRITE = "__rewrite_"


def upsert_table(
    source: DataFrame,
    table: str,
    key: str | Sequence[str],
    full_refresh: bool = False,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Update every row whose key is in ``source``, insert the rest of it.

    A missing table, or ``full_refresh``, is written from the source as it is. Rows only
    in the target stay. All of the source is applied; none is filtered by date or state,
    so rows sent again late are not missed. Duplicate or NULL keys in the source are
    refused, on every path and before anything is changed: it would not be clear which row
    wins, and a NULL key would be inserted again by each rerun. ``fmt`` and
    ``partition_by`` apply when the table is written whole, as do ``buckets``, a number of
    buckets by key: then an upsert shuffles the source to them and nothing of the table.

    On plain files a table without partitions is rewritten whole for any source. For a
    large table use a transactional format; that branch has not been run here, as no such
    format is on the class path. A table has one writer at a time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark = source.sparkSession
    table = qualified(spark, table)
    recover_upsert(spark, table)
    if full_refresh or not spark.catalog.tableExists(table):
        write_table(
            source, table, fmt=fmt, partition_by=partition_by, bucket_by=(buckets, keys) if buckets else None,
            before_swap=lambda staging: _check_keys(spark.table(staging), keys),
        )
        return
    target = spark.table(table)
    _require_same_columns(target, source)
    provider = table_format(spark, table)
    incoming = table + _INCOMING + run_id()
    # Stored once: it is read several times below, and may itself read the target. The
    # planner knows the size of a stored table, so no join needs a hint.
    source.select(*target.columns).write.format("parquet").saveAsTable(incoming)
    try:
        stored = spark.table(incoming)
        if _check_keys(stored, keys):
            if provider in TRANSACTIONAL:
                _merge_in_place(stored, table, keys)
            else:
                _rewrite(spark, table, stored, keys, provider)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {incoming}")


def recover_upsert(spark: SparkSession, table: str) -> None:
    """Finish what an earlier upsert had merged but not put in place when it died.

    What was merged from another state of the table than the present one is dropped.
    """
    recover_table(spark, table)
    rewrites, journals = leftovers(spark, table, _REWRITE), leftovers(spark, table, _JOURNAL)
    for rewrite in rewrites:
        journal = rewrite.replace(_REWRITE, _JOURNAL)
        if journal in journals and _merged_from(spark, table, journal, rewrite):
            _put_partitions(spark, table, rewrite)
        else:
            logger.warning("%s has changed since %s was merged from it: the rewrite is dropped", table, rewrite)
            spark.sql(f"DROP TABLE {rewrite}")
    for journal in journals:
        spark.sql(f"DROP TABLE IF EXISTS {journal}")


def _identity(spark: SparkSession, table: str) -> tuple[str, str]:
    return details(spark, table)["Location"], spark.table(table).schema.json()


def _files_by_folder(spark: SparkSession, table: str) -> DataFrame:
    """(folder, n_rows, print): number of files and a fingerprint of their names and sizes."""
    location = details(spark, table)["Location"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    parts = F.split("_metadata.file_path", "/")
    name, size = F.element_at(parts, -1), F.col("_metadata.file_size")
    names = files.select(F.element_at(parts, -2).alias("folder"), F.xxhash64(name, size).alias("file"))
    return names.groupBy("folder").agg(*fingerprint(F.col("file")))


def _rows_by_folder(spark: SparkSession, table: str) -> DataFrame:
    """The same for rows and their values, wherever they are stored."""
    rows = spark.table(table)
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder")
    values = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(rows.columns)])
    return rows.select(folder, values.alias("row")).groupBy("folder").agg(*fingerprint(F.col("row")))


def _merged_from(spark: SparkSession, table: str, journal: str, rewrite: str) -> bool:
    """Whether ``table`` is what the journal describes, but for partitions that the rewrite has already replaced.

    Such a partition holds the rows of the rewrite, or nothing if the commit was cut short.
    """
    if not spark.catalog.tableExists(table):
        return False
    noted = spark.table(journal)
    location, schema = _identity(spark, table)
    if noted.where((F.col("location") == location) & (F.col("schema") == schema)).isEmpty():
        return False
    base = noted.where(F.col("folder").isNotNull()).select("folder", F.col("n_rows").alias("n"), F.col("print").alias("p"))
    now = _files_by_folder(spark, table).select(F.col("folder").alias("folder_"), F.col("n_rows").alias("n_"), F.col("print").alias("p_"))
    same = F.col("n").eqNullSafe(F.col("n_")) & F.col("p").eqNullSafe(F.col("p_"))
    changed = base.join(now, F.col("folder") == F.col("folder_"), "full").where(~same)
    changed = changed.select(F.coalesce("folder", "folder_").alias("folder"), F.col("n_").isNotNull().alias("there"))
    ours = _rows_by_folder(spark, rewrite).select("folder", F.col("n_rows").alias("n"), F.col("print").alias("p"))
    held = _rows_by_folder(spark, table).select(F.col("folder").alias("folder_"), F.col("n_rows").alias("n_"), F.col("print").alias("p_"))
    judged = changed.join(ours, "folder", "left").join(held, F.col("folder") == F.col("folder_"), "left")
    explained = F.col("n").isNotNull() & (~F.col("there") | same)
    return judged.where(~explained).isEmpty()


def _write_journal(spark: SparkSession, table: str, journal: str) -> None:
    location, schema = _identity(spark, table)
    identity = spark.range(1).select(F.lit(location).alias("location"), F.lit(schema).alias("schema"))
    folders = _files_by_folder(spark, table)
    identity.unionByName(folders, allowMissingColumns=True).write.format("parquet").saveAsTable(journal)


def table_format(spark: SparkSession, table: str) -> str:
    return details(spark, table).get("Provider", "parquet").lower()


def _rewrite(
    spark: SparkSession, table: str, incoming: DataFrame, keys: list[str], fmt: str
) -> None:
    target = spark.table(table)
    partitioned = partition_columns(spark, table)
    buckets = bucketing(spark, table)
    if buckets and buckets[1] == keys and not partitioned:
        # Both sides meet in the target's buckets, and so does what is written.
        merged = merge_rows(target, incoming, keys, in_place=True)
        write_table(merged, table, fmt=fmt, bucket_by=buckets, dealt=True)
        return
    if buckets or not _stays_in_partition(target, incoming, keys, partitioned):
        write_table(merge_rows(target, incoming, keys), table, fmt=fmt, partition_by=partitioned, bucket_by=buckets)
        return
    touched = incoming.select(partitioned[0]).distinct()
    merged = merge_rows(target.join(touched, partitioned[0], "left_semi"), incoming, keys)
    # Stored before anything is replaced: should the driver die while partitions are put in
    # place, the next run finds the rows and puts them all in place again.
    run = run_id()
    journal, rewrite = table + _JOURNAL + run, table + _REWRITE + run
    _write_journal(spark, table, journal)
    rows = cluster_for(merged.select(*target.columns), partitioned)
    rows.write.format(fmt).partitionBy(*partitioned).saveAsTable(rewrite)
    _put_partitions(spark, table, rewrite)
    spark.sql(f"DROP TABLE {journal}")


def _put_partitions(spark: SparkSession, table: str, rewrite: str) -> None:
    """Replace the partitions of ``table`` that ``rewrite`` holds, leaving the others alone."""
    # Spark takes this mode from the session, not from the writer. A session of its own
    # shares the catalog, and no other thread sees the setting.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = own.table(rewrite)
    cluster_for(rows, partition_columns(spark, table)).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE {rewrite}")


def _stays_in_partition(
    target: DataFrame, incoming: DataFrame, keys: list[str], partitioned: list[str]
) -> bool:
    """Whether replacing only the partitions that the source names is right.

    It is when there is one partition column and every matched row already sits in the
    partition its new version goes to, verified on the key and partition columns alone.
    """
    if len(partitioned) != 1:
        return False
    column = partitioned[0]
    if not incoming.where(F.col(column).isNull()).isEmpty():
        return False
    if column in keys:
        return True
    moves_to = incoming.select(*keys, F.col(column).alias("__to"))
    moved = (
        target.select(*keys, column)
        .join(moves_to, keys)
        .where(~F.col(column).eqNullSafe(F.col("__to")))
    )
    return moved.isEmpty()


def _check_keys(source: DataFrame, keys: list[str]) -> int:
    """Number of source rows; raises on a duplicate or NULL key."""
    n = F.col("n")
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    some_null = reduce(operator.or_, [F.col(k).isNull() for k in keys])
    zero = F.lit(0)
    seen = per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("n_rows"),
        F.coalesce(F.sum(F.when(some_null, n)), zero).alias("null_keys"),
        F.count_if((n > 1) & ~some_null).alias("duplicate_keys"),
    ).first()
    if seen["null_keys"] or seen["duplicate_keys"]:
        raise ValueError(
            f"cannot upsert on {', '.join(keys)}: the source has "
            f"{seen['duplicate_keys']} duplicate keys and {seen['null_keys']} NULL keys"
        )
    return seen["n_rows"]


def _require_same_columns(target: DataFrame, source: DataFrame) -> None:
    def columns(df: DataFrame) -> dict[str, str]:
        return {f.name.lower(): f.dataType.simpleString() for f in df.schema}

    if columns(target) != columns(source):
        differ = set(columns(target).items()) ^ set(columns(source).items())
        raise ValueError(f"source and target columns differ: {sorted(differ)}")


def _merge_in_place(source: DataFrame, table: str, keys: list[str]) -> None:
    same_key = " AND ".join(f"source.{k} = {table}.{k}" for k in keys)
    (
        source.alias("source")
        .mergeInto(table, F.expr(same_key))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
