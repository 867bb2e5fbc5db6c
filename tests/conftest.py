from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tests.dumps import POSTS_XML, USERS_XML  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("postmill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def database(spark, request):
    """A database of its own for each test."""
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="session")
def dumps(tmp_path_factory):
    """Paths of the two sample dumps."""
    folder = tmp_path_factory.mktemp("dumps")
    paths = {"posts": folder / "Posts.xml", "users": folder / "Users.xml"}
    paths["posts"].write_text(POSTS_XML, encoding="utf-8")
    paths["users"].write_text(USERS_XML, encoding="utf-8")
    return {name: str(path) for name, path in paths.items()}
