"""Counting and top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per key value. Counts are combined before the shuffle, so hot keys are fine."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows in a total order; each task keeps ``n`` rows, nothing is sorted whole."""
    return df.orderBy(*order).limit(n)
