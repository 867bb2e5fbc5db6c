from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.operators import quality, unresolved_rows
from postmill.schemas import USERS

NOW = datetime(2024, 1, 15)
ROWS = [
    (1, "a", ["x"], datetime(2024, 1, 1)),
    (2, "b", [], datetime(2024, 2, 1)),
    (2, None, None, None),
    (None, "z", ["y"], datetime(2024, 1, 2)),
    (None, "a", ["y"], datetime(2024, 1, 2)),
]
SCHEMA = "id long, kind string, tags array<string>, at timestamp"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_column_checks(table):
    assert quality.not_null(table, "id").count() == 2
    assert [tuple(r) for r in quality.unique(table, "id").collect()] == [(2, 2)]
    assert [r["kind"] for r in quality.accepted_values(table, "kind", ["a", "b"]).collect()] == ["z"]
    assert [r["kind"] for r in quality.no_empty_arrays(table, "tags").collect()] == ["b"]


def test_counts_of_all_promises(table):
    checks = quality.TableChecks(
        not_null=("id", "kind"),
        unique=("id",),
        accepted=(("kind", ("a", "b")),),
        no_empty_arrays=("tags",),
    )
    got = {(r[0], r[1]): r[2] for r in quality.count_violations(table, checks).collect()}
    assert got == {
        ("not_null", "id"): 2, ("not_null", "kind"): 1, ("unique", "id"): 1,
        ("accepted_values", "kind"): 1, ("no_empty_arrays", "tags"): 1,
    }
    with pytest.raises(quality.CheckFailed, match=r"t: .*not_null\(id\): 2"):
        quality.enforce(table, checks, "t")
    quality.enforce(table.where("id = 1"), checks, "t")


def rules():
    return [
        *quality.rule_not_null(["id", "at"]),
        quality.rule_not_in_future("at", F.lit(NOW)),
        quality.rule_in_list("kind", ["a", "b"], level=quality.WARN),
    ]


def test_row_rules(table):
    valid, refused = quality.split_by_rules(table, rules())
    assert [(r["id"], r["kind"]) for r in valid.collect()] == [(1, "a")]
    assert quality.ERRORS not in valid.columns
    got = {(r["id"], r["kind"]): (r[quality.ERRORS], r[quality.WARNINGS]) for r in refused.collect()}
    assert got == {
        (2, "b"): (["at_in_future"], []),
        (2, None): (["at_is_null"], []),
        (None, "z"): (["id_is_null"], ["kind_not_in_list"]),
        (None, "a"): (["id_is_null"], []),
    }


def test_the_default_is_now(spark):
    df = spark.createDataFrame([(datetime(2000, 1, 1),), (datetime(2999, 1, 1),)], "at timestamp")
    valid, refused = quality.split_by_rules(df, [quality.rule_not_in_future("at")])
    assert valid.count() == refused.count() == 1


def test_an_unknown_level_is_refused():
    with pytest.raises(ValueError):
        quality.RowRule("r", F.lit(True), "fatal")


row = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from("abz")),
    st.one_of(st.none(), st.lists(st.sampled_from(["x"]), max_size=1)),
    st.one_of(st.none(), st.sampled_from([datetime(2024, 1, 1), datetime(2024, 2, 1)])),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=12))
def test_the_split_loses_and_repeats_nothing(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    valid, refused = quality.split_by_rules(df, rules())
    both = valid.select(*df.columns).unionAll(refused.select(*df.columns))
    def listed(frame):
        return sorted(map(repr, map(tuple, frame.collect())))

    assert listed(both) == listed(df)
    judged = [r for r in rows if r[0] is None or r[3] is None or r[3] > NOW]
    assert refused.count() == len(judged)


def test_stage_validation(spark):
    rows = [(1, "Question", ["a"]), (2, None, []), (3, "Answer", None)]
    df = spark.createDataFrame(rows, "post_id long, post_type string, tags_array array<string>")
    assert tuple(quality.stage_summary(df).first()) == (3, 1, 1)
    assert len(quality.validate_stage(df)) == 2
    assert quality.validate_stage(df.where("post_id <> 2")) == []
    assert quality.validate_stage(df.drop("post_type")) == ["missing columns: post_type"]


def test_grain(spark):
    assert tuple(quality.grain(spark.range(3), spark.range(3)).first()) == (3, 3, True)
    assert tuple(quality.grain(spark.range(3), spark.range(4)).first()) == (3, 4, False)


def test_grain_of_keys(spark):
    """Equal numbers of rows with one post lost and another invented, or one twice, are told apart."""

    def grain(*ids):
        result = spark.createDataFrame([(i,) for i in ids], "post_id int")
        return tuple(quality.key_grain(spark.range(4), result, "id", "post_id").first())

    assert grain(3, 1, 0, 2) == (4, 4, True)
    assert grain(0, 1, 2, 9) == grain(0, 1, 2, 2) == grain(0, 1, 2, None) == (4, 4, False)
    assert grain(0, 1, 2) == (4, 3, False) and grain(0, 1, 2, 3, 3, 3) == (4, 6, False)
    empty = spark.range(0)
    assert tuple(quality.key_grain(empty, empty, "id", "id").first()) == (0, 0, True)


def test_schema_problems(spark):
    users = spark.createDataFrame([], USERS)
    assert quality.schema_problems(users, USERS) == []
    assert quality.schema_problems(users.drop("Id"), USERS) == ["missing: Id bigint"]
    turned = users.select(*reversed(users.columns))
    assert quality.schema_problems(turned, USERS) == ["columns are in another order"]
    retyped = users.withColumn("Views", F.col("Views").cast("int"))
    assert quality.schema_problems(retyped, USERS) == ["missing: Views bigint", "unexpected: Views int"]


def test_unresolved_rows(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id long, owner long")
    dim = spark.createDataFrame([(5,)], "user_id long")
    assert [r["id"] for r in unresolved_rows(fact, dim, "owner", "user_id").collect()] == [2]
