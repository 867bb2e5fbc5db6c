"""Bronze: a dump becomes a typed table, in one pass over the source."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.operators import clean_columns
from postmill.operators.quality import CheckFailed, schema_problems
from postmill.sinks import append_batch, write_table
from postmill.sinks.batches import note_batch
from postmill.sinks.tables import run_id
from postmill.sources import REASON, load_rows, split_rejects

logger = logging.getLogger(__name__)


class TooFewRows(ValueError):
    """The source gave fewer rows than expected, most likely a wrong row tag or path."""


def ingest(
    spark: SparkSession,
    path: str,
    table: str,
    schema: StructType,
    row_tag: str = "row",
    write_mode: str = "overwrite",
    layout: str = "lines",
    quarantine_table: str | None = None,
    min_rows: int = 1,
    fmt: str = "parquet",
    batch: str | None = None,
) -> int:
    """Ingest a dump and return the number of rows written to ``table``.

    Without ``quarantine_table`` a row that does not fit the schema fails the job. With
    it such rows go there as text with the reason and the file. The source is read once:
    the judged rows are stored beside the table, and both tables are cut from them. The
    refused rows are published first, so a row is never in neither table.

    Fewer than ``min_rows`` rows is an error, and so is a table that does not have the
    columns of ``schema``. Both are found before anything is published, so an overwrite
    leaves the old table as it was and an append adds nothing.

    A plain append that fails and is run again may leave refused rows twice. With ``batch``, an
    id of what is appended, it does not: both tables carry the id beside the contract's columns, a
    retry replaces what the same batch left in either, and a line in ``<table>_batches`` says
    that it is complete. The judged rows are stored first and checked there, so each row
    is written twice in all.
    """
    if batch is not None and write_mode != "append":
        raise ValueError("only an append is made of batches")
    logger.info("reading %s", path)

    def enough(n: int) -> None:
        if n < min_rows:
            raise TooFewRows(f"{path}: {n} rows, expected {min_rows}")

    def fits(stored: str) -> None:
        if problems := schema_problems(spark.table(stored), schema):
            raise CheckFailed(f"{table}: {', '.join(problems)}")

    if quarantine_table is None and batch is None:
        rows = load_rows(spark, path, schema, row_tag, layout, "fail")
        written = Observation()
        good = rows.observe(written, F.count(F.lit(1)).alias("good"))

        def check(staging: str) -> None:
            enough(written.get["good"])
            fits(staging)

        write_table(clean_columns(good), table, write_mode, fmt, before_swap=check)
        count = written.get["good"]
    else:
        rows = load_rows(spark, path, schema, row_tag, layout, "quarantine" if quarantine_table else "fail")
        judged = f"{table}__judged_{run_id()}"
        rows.write.format("parquet").saveAsTable(judged)
        try:
            good, refused, seen = _judged(spark.table(judged))
            enough(seen["good"])
            if batch is not None:
                if quarantine_table is not None:
                    append_batch(refused, quarantine_table, batch, fmt)
                append_batch(_fitting(clean_columns(good), schema, table), table, batch, fmt)
                note_batch(spark, table, batch, n_rows=seen["good"], n_refused=seen["refused"])
            else:
                if seen["refused"] or write_mode == "overwrite":
                    write_table(refused, quarantine_table, write_mode, fmt)
                write_table(clean_columns(good), table, write_mode, fmt, before_swap=fits)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {judged}")
        count = seen["good"]
        if quarantine_table is not None:
            logger.info("%s rows quarantined in %s", seen["refused"], quarantine_table)
    logger.info("%s rows written to %s", count, table)
    return count


def _judged(rows: DataFrame) -> tuple[DataFrame, DataFrame | None, Row]:
    """Good rows, refused ones if they were kept, and how many there are of either.

    Counted on the stored rows: those are what the tables are made of.
    """
    if REASON not in rows.columns:
        return rows, None, rows.agg(F.count(F.lit(1)).alias("good"), F.lit(0).alias("refused")).first()
    good, refused = split_rejects(rows)
    seen = rows.agg(
        F.count_if(F.col(REASON).isNull()).alias("good"),
        F.count_if(F.col(REASON).isNotNull()).alias("refused"),
    ).first()
    return good, refused, seen


def _fitting(rows: DataFrame, schema: StructType, table: str) -> DataFrame:
    if problems := schema_problems(rows, schema):
        raise CheckFailed(f"{table}: {', '.join(problems)}")
    return rows
