"""Every registered query against its SQL, run by another engine on the same tables."""

import duckdb
import pytest

import __spark_entry__ as driver

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# The optional corpus operators have tests of their own.
NAMES = sorted(set(driver.queries()) - set(driver.LLM_QUERIES))


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from '{driver.SMOKE_DIR}/{name}.parquet'"
        )
    return connection


def comparable(rows, columns, order):
    picked = [columns.index(name) for name in order]
    return sorted((tuple(row[i] for i in picked) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    result = driver.queries()[name](spark, driver.SMOKE_DIR)
    found = oracle.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    order = sorted(result.columns)
    assert sorted(columns) == order
    want = comparable(found.fetchall(), columns, order)
    assert comparable(map(tuple, result.collect()), result.columns, order) == want
    assert want, "an empty comparison proves nothing"


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["tag", "post_count"] and result.count() > 0
