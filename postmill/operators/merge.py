"""Keyed merge of a source into a target, as a DataFrame."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], in_place: bool = False
) -> DataFrame:
    """Update all on match, insert all otherwise; rows only in the target stay.

    As in a MERGE, every target row of a key is updated, should there be several, and a NULL
    key matches nothing. Source keys must be unique. No hints: with a source of known small
    size the planner broadcasts it, and then the target is not shuffled for the update.

    ``in_place`` is for a target that is bucketed by the keys: one full join, which reads it
    once, shuffles the source to its buckets and leaves the rows of each bucket together.
    """
    new = source.select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(c).alias(c) for c in target.columns]).alias("__new"),
    )
    same = reduce(operator.and_, [target[k] == new[f"__key_{i}"] for i, k in enumerate(keys)])

    def updated(matched: DataFrame) -> DataFrame:
        columns = [F.when(F.col("__new").isNotNull(), F.col(f"__new.`{c}`")).otherwise(target[c]).alias(c) for c in target.columns]
        return matched.select(*columns)

    if in_place:
        return updated(target.join(new, same, "full"))
    matched = updated(target.join(new, same, "left"))
    # Target keys that the source has: from a small source found without a shuffle, and few.
    known = target.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).join(
        new.select(*[f"__key_{i}" for i in range(len(keys))]), [f"__key_{i}" for i in range(len(keys))], "left_semi"
    )
    absent = reduce(operator.and_, [source[k] == known[f"__key_{i}"] for i, k in enumerate(keys)])
    return matched.unionByName(source.join(known, absent, "left_anti").select(*target.columns))
