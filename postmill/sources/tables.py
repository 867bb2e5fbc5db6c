"""Table scans and small lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from postmill.schemas import POST_TYPES


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a catalog table, or the files under a path (anything holding a ``/``)."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_seed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Read a lookup seed from CSV with a header line; no type inference."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def lookup_table(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType
) -> DataFrame:
    """A small in-memory table whose size Catalyst knows exactly.

    Sent as Arrow it becomes a local relation. A list of Python rows would become
    an RDD of unknown size, which the planner would never broadcast by itself.
    """
    arrow_schema = to_arrow_schema(schema)
    columns = [
        pa.array([row[i] for row in rows], type=field.type)
        for i, field in enumerate(arrow_schema)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow_schema))


def post_types(spark: SparkSession, seed: str | None = None) -> DataFrame:
    """The post type labels as a table: the fixed ones, or those of a CSV seed."""
    schema = StructType(
        [
            StructField("post_type_id", IntegerType()),
            StructField("post_type", StringType()),
        ]
    )
    return lookup_table(spark, POST_TYPES, schema) if seed is None else read_seed(spark, seed, schema)
