"""Left joins of a fact table with a lookup or a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.schemas import UNKNOWN_LABEL


def label_lookup(
    df: DataFrame,
    lookup: DataFrame,
    code: str,
    lookup_code: str,
    label: str,
    default: str = UNKNOWN_LABEL,
    salts: int = 1,
) -> DataFrame:
    """Add ``label`` for a code; every row stays and an unmapped code gets ``default``.

    No broadcast hint: the planner broadcasts the lookup when its known size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, by the code. For a
    lookup too large to broadcast, with a code that many rows have, ask for ``salts``: rows
    are then dealt by code and salt, so that such a code meets in so many tasks, and the lookup
    is copied once for each salt. The planner's size of the lookup leaves out the copies, so
    with salts the join is hinted to sort and merge and the copies never pass through the
    driver. The lookup code must be unique.
    """
    named = lookup.select(
        F.col(lookup_code).alias("__code"), F.col(label).alias("__label")
    )
    same = df[code] == named["__code"]
    if salts > 1:
        named = named.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
        df = df.withColumn("__salt", F.pmod(F.xxhash64(*_hashable(df)), F.lit(salts)).cast("int"))
        same = (df[code] == named["__code"]) & (df["__salt"] == named["__copy"])
    joined = df.join(named, same, "left")
    return joined.withColumn(label, F.coalesce("__label", F.lit(default))).drop(
        "__code", "__label", "__copy", "__salt"
    )


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def left_join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: Column,
    dimension_key: Column,
    spread_by: Column,
) -> DataFrame:
    """Left equi-join that keeps every fact row, whatever its key and the key's type.

    ``spread_by`` identifies a fact row. Rows with a NULL key match nothing, and hashed by
    the key alone all of them, perhaps a third of the table, would meet in one task. So
    there is a second equality, between hashes: that of the key on both sides, but for a
    NULL key that of ``spread_by``. It spreads such rows and changes no match.

    A hot key that does match is split over tasks by the AQE skew join. A dimension
    small enough by its known size is broadcast, and then nothing is shuffled. The
    dimension key must be unique, or rows fan out.
    """
    both = fact.select(fact_key.alias("key")).union(dimension.select(dimension_key.alias("key")))
    wider = both.schema["key"].dataType
    left, right = fact_key.cast(wider), dimension_key.cast(wider)
    spread = F.when(left.isNull(), F.xxhash64(spread_by)).otherwise(F.xxhash64(left))
    return fact.join(dimension, (left == right) & (spread == F.xxhash64(right)), "left")


def unresolved_rows(
    fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str
) -> DataFrame:
    """Fact rows that name a dimension row which does not exist."""
    keys = dimension.select(F.col(dimension_key).alias("__key"))
    named = fact.where(F.col(fact_key).isNotNull())
    return named.join(keys, named[fact_key] == keys["__key"], "left_anti")
