"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Send texts to Python in batches of ``rows`` at most, unless the session asks for fewer.

    Two batches are in memory at a time; with Spark's 10,000 rows those of whole documents
    take a good part of a small executor.
    """
    if int(spark.conf.get(BATCH_ROWS)) > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a temporary one, on one machine only."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="postmill-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, without its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like ``checkpoint``, as compressed Parquet: for wide rows."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashable(df: DataFrame) -> list[str]:
    """Columns that xxhash64 takes: all but maps and what holds them."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def tie_break(df: DataFrame) -> Column:
    """One number from all columns: rows that share it are equal, so their order is of no account."""
    return F.xxhash64(*[F.col(f"`{name}`") for name in hashable(df)])


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of all columns; those that no hash takes count by their JSON."""
    plain = set(hashable(df))
    columns = [F.col(f"`{name}`") if name in plain else F.to_json(F.struct(F.col(f"`{name}`").alias("c"))) for name in df.columns]
    return F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *reversed(columns))


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, out of reach of clashing names."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
