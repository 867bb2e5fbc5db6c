import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.functions import (
    author_status,
    blank_to_null,
    drop_blank,
    score_band,
    split_literal,
    tag_list,
)

SLOW_STEPS = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize("delimiter", ["|", ".", "a", " ", "||", "\\", "^$", r"x\Ey", "[", "-"])
def test_the_delimiter_is_literal(spark, delimiter):
    text = delimiter.join(["one", "two", "", "six"])
    (got,) = values(spark, [(text,)], "t string", split_literal(F.col("t"), delimiter))
    assert got == text.split(delimiter)


def test_an_empty_delimiter_is_refused():
    with pytest.raises(ValueError):
        split_literal(F.lit("x"), "")


def test_tag_list_cases(spark):
    rows = [("|a|b|",), ("a|b",), ("|a|a|",), ("",), ("||",), (None,)]
    got = values(spark, rows, "t string", tag_list(F.col("t")))
    assert got == [["a", "b"], ["a", "b"], ["a", "a"], [], [], None]


@SLOW_STEPS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab|\\.é ", max_size=12)), min_size=1))
def test_tag_list_agrees_with_python(spark, texts):
    rows = [(t,) for t in texts]
    df = spark.createDataFrame(rows, "t string").select(
        tag_list(F.col("t")).alias("by_remove"),
        drop_blank(split_literal(F.col("t"), "|")).alias("by_filter"),
    )
    want = [None if t is None else [x for x in t.split("|") if x] for t in texts]
    got = df.collect()
    assert [r["by_remove"] for r in got] == want
    assert [r["by_filter"] for r in got] == want


def test_blank_to_null_does_not_trim(spark):
    assert values(spark, [("",), (" ",), ("x",), (None,)], "t string", blank_to_null(F.col("t"))) == [
        None, " ", "x", None,
    ]


def test_author_status_order(spark):
    rows = [(None, None), (None, 1), (1, None), (1, 1)]
    got = values(spark, rows, "o long, u long", author_status(F.col("o"), F.col("u")))
    assert got == ["anonymous", "anonymous", "unresolved", "resolved"]


def test_score_band_edges(spark):
    rows = [(s,) for s in (-1, 0, 1, 4, 5, 19, 20, None)]
    got = values(spark, rows, "s long", score_band(F.col("s")))
    assert got == ["negative", "zero", "1-4", "1-4", "5-19", "5-19", "20+", "20+"]
    assert values(spark, [(None,)], "s long", score_band(F.col("s"), "none")) == ["none"]
