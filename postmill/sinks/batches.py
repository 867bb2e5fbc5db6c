"""Appends that happen exactly once.

Every row of such a table carries the id of its batch, as its partition column, so the id
costs nothing in the files. A batch is written by replacing its partition: a retry after a
failure, at whatever point, replaces what the attempt before has left and adds nothing.

A ledger beside the table has a line for each batch that is complete in every table it went to.
It is written last; a reader that wants complete batches only joins with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.sinks.tables import partition_columns, qualified, recover_table, write_table

BATCH = "batch_id"
_LEDGER = "_batches"


def append_batch(df: DataFrame, table: str, batch: str, fmt: str = "parquet") -> None:
    """Append the rows of a batch, in place of those that the same batch has already there.

    A table that has rows without a batch, from an overwrite or a plain append, is written
    anew once; such rows have no id. ``df`` must have the columns
    of the table, in any order. An empty batch removes what it had.
    """
    if not batch:
        raise ValueError("a batch needs an id")
    if BATCH in df.columns:
        raise ValueError(f"the rows have a column named {BATCH} already")
    spark = df.sparkSession
    table = qualified(spark, table)
    recover_table(spark, table)
    rows = df.withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(table):
        write_table(rows, table, fmt=fmt, partition_by=[BATCH])
        return
    if BATCH not in spark.table(table).columns:
        write_table(spark.table(table).withColumn(BATCH, F.lit(None).cast("string")), table, fmt=fmt, partition_by=[BATCH])
    if partition_columns(spark, table) != [BATCH]:
        raise ValueError(f"{table} is not partitioned by {BATCH}")
    target = spark.table(table)
    if {f.name.lower(): f.dataType for f in target.schema} != {f.name.lower(): f.dataType for f in rows.schema}:
        raise ValueError(f"{table} has other columns than the batch")
    columns = [c for c in target.columns if c != BATCH]
    literal = batch.replace("\\", "\\\\").replace("'", "\\'")
    # Replaces one named partition, also by nothing: the mode that goes by the rows would leave an
    # old attempt where the new one is empty.
    named = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = '{literal}') SELECT {named} FROM {{rows}}", rows=df)


def note_batch(spark: SparkSession, table: str, batch: str, **counts: int) -> None:
    """Enter a complete batch into the ledger of ``table``, in place of its line, if it has one."""
    numbers = [F.lit(n).cast("long").alias(name) for name, n in counts.items()]
    append_batch(spark.range(1).select(*numbers, F.current_timestamp().alias("finished_at")), ledger(table), batch)


def ledger(table: str) -> str:
    """The name of the ledger of a table."""
    return table + _LEDGER
