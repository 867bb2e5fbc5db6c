"""Column naming and ordering."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.schemas import ATTRIBUTE_PREFIX


def clean_columns(df: DataFrame) -> DataFrame:
    """Drop leading underscores from every column name; inner ones stay.

    Two columns that would get the same name are refused, not merged.
    """
    renamed = {name: name.lstrip(ATTRIBUTE_PREFIX) for name in df.columns}
    seen: dict[str, str] = {}
    for name, clean in renamed.items():
        other = seen.setdefault(clean.lower(), name)
        if not clean or other != name:
            raise ValueError(f"column {name!r} cannot become {clean!r}")
    return df.select([F.col(f"`{name}`").alias(clean) for name, clean in renamed.items()])


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select exactly these columns, in this order: new name to source name or expression."""
    return df.select(
        [
            (F.col(source) if isinstance(source, str) else source).alias(name)
            for name, source in columns.items()
        ]
    )
