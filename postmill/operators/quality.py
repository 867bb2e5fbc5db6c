"""Data-quality checks.

A check returns its violations as a DataFrame, empty when the data is fine, so it runs
on the executors whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ERROR = "error"
WARN = "warn"

ERRORS = "_errors"
WARNINGS = "_warnings"


# --- checks on one column -------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, and how often. NULL is not a value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list. NULL passes; ``not_null`` is for that."""
    return df.where(~F.col(column).isin(list(values)))


def no_empty_arrays(df: DataFrame, column: str) -> DataFrame:
    """Rows with an array that is there but holds nothing. A NULL array is fine."""
    return df.where(_empty_array(column))


def _empty_array(column: str) -> Column:
    return F.array_size(column) == 0


# --- row rules ------------------------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A named condition that holds for a bad row, and how bad that is."""

    name: str
    failed: Column
    level: str = ERROR

    def __post_init__(self) -> None:
        if self.level not in (ERROR, WARN):
            raise ValueError(f"level must be {ERROR!r} or {WARN!r}, not {self.level!r}")


def rule_not_null(columns: Iterable[str], level: str = ERROR) -> list[RowRule]:
    """One rule per column."""
    return [RowRule(f"{name}_is_null", F.col(name).isNull(), level) for name in columns]


def rule_not_in_future(
    column: str, as_of: Column | None = None, name: str | None = None, level: str = ERROR
) -> RowRule:
    """``as_of`` defaults to the start of the query."""
    limit = F.current_timestamp() if as_of is None else as_of
    return RowRule(name or f"{column}_in_future", F.col(column) > limit, level)


def rule_in_list(
    column: str, values: Sequence, name: str | None = None, level: str = ERROR
) -> RowRule:
    """NULL passes."""
    failed = ~F.col(column).isin(list(values))
    return RowRule(name or f"{column}_not_in_list", failed, level)


def apply_rules(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Add the names of the failed rules, by level, to every row."""

    def failed(level: str) -> Column:
        names = [F.when(r.failed, F.lit(r.name)) for r in rules if r.level == level]
        if not names:
            return F.array().cast("array<string>")
        return F.array_compact(F.array(*names))

    return df.withColumns({ERRORS: failed(ERROR), WARNINGS: failed(WARN)})


def split_by_rules(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): together they are the input, and no row is in both.

    A row that fails an error rule is quarantined, with everything it failed. A row
    with warnings only stays valid and keeps them. Both are filters over one scan and
    shuffle nothing.
    """
    judged = apply_rules(df, rules)
    faulty = F.size(ERRORS) > 0
    return judged.where(~faulty).drop(ERRORS), judged.where(faulty)


# --- checks across a table ------------------------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    """What a table promises about its columns."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple], ...] = ()
    no_empty_arrays: tuple[str, ...] = ()


def count_violations(df: DataFrame, checks: TableChecks) -> DataFrame:
    """Rows (check, column_name, violations), one per promise.

    Everything that can be judged row by row is counted in a single pass. Each
    uniqueness check adds one pass over its own column.
    """
    failures = {
        **{("not_null", c): F.col(c).isNull() for c in checks.not_null},
        **{
            ("accepted_values", c): ~F.col(c).isin(list(values))
            for c, values in checks.accepted
        },
        **{("no_empty_arrays", c): _empty_array(c) for c in checks.no_empty_arrays},
    }
    parts = []
    if failures:
        counted = df.agg(
            *[F.count_if(bad).alias(f"n{i}") for i, bad in enumerate(failures.values())]
        )
        rows = [
            _violation_row(check, column, F.col(f"n{i}"))
            for i, (check, column) in enumerate(failures)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    for column in checks.unique:
        repeated = unique(df, column).agg(F.count(F.lit(1)).alias("n"))
        row = _violation_row("unique", column, F.col("n"))
        parts.append(repeated.select(F.inline(F.array(row))))
    if not parts:
        raise ValueError("no checks given")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _violation_row(check: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column_name"),
        violations.alias("violations"),
    )


def stage_summary(df: DataFrame, label: str = "post_type", tags: str = "tags_array") -> DataFrame:
    """One row: rows, rows without a label, rows with an empty tag array."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label).isNull()).alias("null_labels"),
        F.count_if(_empty_array(tags)).alias("empty_arrays"),
    )


def validate_stage(
    df: DataFrame,
    required: Sequence[str] = ("post_id", "tags_array", "post_type"),
) -> list[str]:
    """Messages about a staging table; none when it is fine."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        return [f"missing columns: {', '.join(missing)}"]
    counts = stage_summary(df).first()
    messages = []
    if counts["null_labels"]:
        messages.append(f"{counts['null_labels']} rows have no post type label")
    if counts["empty_arrays"]:
        messages.append(f"{counts['empty_arrays']} rows have an empty tag array")
    return messages


def fingerprint(value: Column) -> list[Column]:
    """Aggregates that tell multisets of 64-bit values apart, whatever the order: number and print.

    The print holds the sum of the values, with room for all of them, and their exclusive or. NULL
    counts as a value of its own.
    """
    known = F.coalesce(value, F.lit(0x5BF03635))
    total = F.sum(known.cast("decimal(20, 0)")).cast("string")
    return [F.count(F.lit(1)).alias("n_rows"), F.concat_ws("/", total, F.bit_xor(known).cast("string")).alias("print")]


def grain(source: DataFrame, result: DataFrame) -> DataFrame:
    """One row comparing row counts: a join that fans out makes them differ."""
    counted = source.agg(F.count(F.lit(1)).alias("source_rows"))
    return counted.select(
        "source_rows",
        result.agg(F.count(F.lit(1))).scalar().alias("result_rows"),
    ).withColumn("same_grain", F.col("source_rows") == F.col("result_rows"))


def key_grain(source: DataFrame, result: DataFrame, source_key: str, result_key: str) -> DataFrame:
    """One row comparing keys as multisets: equal counts hide a lost row beside an invented one.

    One pass over each key, and nothing is shuffled but one partial result for each task.
    """

    def keys(df: DataFrame, key: str, name: str) -> DataFrame:
        number, print_ = fingerprint(F.xxhash64(F.col(key).cast("string")))
        return df.agg(F.struct(number, print_).alias(name))

    counted = keys(source, source_key, "s").select("s", keys(result, result_key, "r").scalar().alias("r"))
    return counted.select(
        F.col("s.n_rows").alias("source_rows"),
        F.col("r.n_rows").alias("result_rows"),
        (F.col("s") == F.col("r")).alias("same_grain"),
    )


def schema_problems(df: DataFrame, contract: StructType) -> list[str]:
    """How a DataFrame differs from a contract in names, order, types; none when equal."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in contract]
    if have == want:
        return []
    problems = [f"missing: {n} {t}" for n, t in want if (n, t) not in have]
    problems += [f"unexpected: {n} {t}" for n, t in have if (n, t) not in want]
    return problems or ["columns are in another order"]


class CheckFailed(ValueError):
    """A table broke one of its promises."""


def enforce(df: DataFrame, checks: TableChecks, table: str) -> None:
    """Raise when a promise is broken, naming every one that is."""
    broken = count_violations(df, checks).where(F.col("violations") > 0).collect()
    if broken:
        listed = ", ".join(
            f"{row['check']}({row['column_name']}): {row['violations']}" for row in broken
        )
        raise CheckFailed(f"{table}: {listed}")
