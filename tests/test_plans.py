"""The physical plans: what is pushed down, what is shuffled, what happens to hot keys."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from postmill.operators import label_lookup, left_join_dimension, merge_rows, quality
from postmill.plans import gold, reports, silver
from postmill.schemas import POSTS, USERS
from postmill.sinks import upsert, upsert_table, write_table
from postmill.sources import lookup_table, post_types


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    """Stored posts and users: a third of the posts has no owner, a third one owner."""
    folder = tmp_path_factory.mktemp("bronze")
    n = 30_000
    owner = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(
        F.col("id") % 1000
    )
    given = {
        "Id": F.col("id"),
        "OwnerUserId": owner,
        "PostTypeId": F.col("id") % 2 + 1,
        "Score": F.col("id") % 30 - 3,
        "Tags": F.concat(F.lit("|hot|t"), (F.col("id") % 50).cast("string"), F.lit("|")),
        "Body": F.repeat(F.sha2(F.col("id").cast("string"), 256), 4),
        "CreationDate": F.timestamp_seconds(F.col("id") * 1000),
    }

    def shaped(df, schema, given):
        return df.select(
            [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        )

    shaped(spark.range(0, n, 1, 8), POSTS, given).write.parquet(f"{folder}/posts")
    users = {"Id": F.col("id"), "DisplayName": F.concat(F.lit("u"), F.col("id").cast("string"))}
    shaped(spark.range(0, 900, 1, 4), USERS, users).write.parquet(f"{folder}/users")
    return spark.read.parquet(f"{folder}/posts"), spark.read.parquet(f"{folder}/users")


@pytest.fixture(scope="module")
def staged(spark, bronze):
    return silver.stg_posts(bronze[0], post_types(spark)), silver.stg_users(bronze[1])


def test_only_needed_columns_are_read(spark, bronze, staged):
    plan = plan_of(gold.top_tags(staged[0]))
    assert "ReadSchema: struct<Id:bigint,PostTypeId:bigint,Tags:string>" in plan
    wide = gold.posts_users(*staged)
    plan = plan_of(reports.author_status_counts(wide))
    assert "Body" not in plan and "ReadSchema: struct<Id:bigint,OwnerUserId:bigint" in plan


def test_filters_reach_the_scan(staged):
    plan = plan_of(staged[0].where("score > 3 and owner_user_id is not null").select("post_id"))
    assert "IsNotNull(OwnerUserId)" in plan and "GreaterThan(Score,3)" in plan


def test_the_label_table_is_broadcast(staged):
    plan = plan_of(staged[0])
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_top_n_never_sorts_everything(staged):
    plan = plan_of(gold.top_tags(staged[0]))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_counting_by_row_shuffles_tags_only(staged):
    exact = plan_of(gold.tag_counts(staged[0]))
    by_row = plan_of(gold.tag_counts(staged[0], unique_posts=True))
    assert exact.count("Exchange hashpartitioning") == 2
    assert by_row.count("Exchange hashpartitioning") == 1
    assert "partial_count" in by_row
    got, want = gold.tag_counts(staged[0], True), gold.tag_counts(staged[0])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_score_bands_need_one_small_shuffle(staged):
    plan = plan_of(reports.score_bands(staged[0]))
    assert plan.count("Exchange SinglePartition") == 1
    assert "Exchange hashpartitioning" not in plan and "partial_count" in plan


def test_no_registered_query_has_a_cross_join(spark):
    for name, query in driver.queries().items() - driver.LLM_QUERIES.items():
        plan = plan_of(query(spark, driver.SMOKE_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def wide_rows(df):
    columns = ["post_id", "owner_user_id", "user_id", "display_name", "author_status"]
    return sorted(map(tuple, df.select(*columns).collect()))


def test_hot_and_missing_owners_are_split(spark, staged):
    """Beyond the broadcast limit: no task gets all posts of one owner or of none."""
    wanted = wide_rows(gold.posts_users(*staged))
    posts, users = staged
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        labelled = posts.hint("merge")
        wide = gold.posts_users(labelled, users)
        assert wide_rows(wide) == wanted
        tasks = wide.select("post_id", "owner_user_id", "user_id", "display_name",
                            F.spark_partition_id().alias("task"))
        rows = tasks.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
        assert "SortMergeJoin(skew=true)" in final_plan(tasks)
        anonymous = (
            tasks.where("owner_user_id is null").groupBy("task").agg(F.count(F.lit(1)).alias("n"))
        )
        sizes = [r["n"] for r in anonymous.collect()]
        assert len(sizes) >= 16 and max(sizes) < 10_000 / 4
        assert sum(r["n"] for r in rows.collect()) == 30_000


def final_plan(df):
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def test_a_small_source_does_not_shuffle_the_target(spark, bronze):
    """The planner knows its size; without a broadcast both sides are shuffled."""
    target = bronze[0].select("Id", "Score")
    source = lookup_table(spark, [(1, 5), (-9, 6)], target.schema)
    small = plan_of(merge_rows(target, source, ["Id"]))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        large = plan_of(merge_rows(target, source, ["Id"]))
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_the_spread_key_does_not_change_a_small_join(spark, staged):
    posts, users = staged
    p, u = posts.alias("p"), users.alias("u")
    joined = left_join_dimension(
        p, u, F.col("p.owner_user_id"), F.col("u.user_id"), F.col("p.post_id")
    )
    plain = p.join(u, F.col("p.owner_user_id") == F.col("u.user_id"), "left")
    assert joined.select("p.post_id", "u.user_id").exceptAll(
        plain.select("p.post_id", "u.user_id")
    ).isEmpty()
    assert "BroadcastHashJoin" in plan_of(joined)


# --- one distribution from write to check to upsert -----------------------------------


def exchanged(df) -> list[str]:
    """What each exchange of the plan that ran deals by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line]


@pytest.fixture
def no_broadcast(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield


def test_a_bucketed_table_is_checked_joined_and_upserted_in_its_buckets(spark, database, no_broadcast, monkeypatch):
    table, owners = f"{database}.posts", f"{database}.users"
    posts = spark.range(2000).selectExpr("id as post_id", "id % 50 as owner", "'x' as v")
    upsert_table(posts, table, "post_id", buckets=8)
    write_table(spark.range(50).selectExpr("id as owner", "'n' as name"), owners, bucket_by=(8, ["owner"]))
    write_table(posts, f"{database}.by_owner", bucket_by=(8, ["owner"]))
    assert len(spark.table(table).inputFiles()) == 8

    repeated = quality.unique(spark.table(table), "post_id")
    assert repeated.collect() == [] and exchanged(repeated) == []
    joined = spark.table(f"{database}.by_owner").join(spark.table(owners), "owner", "left")
    assert joined.count() == 2000 and exchanged(joined) == []

    merges, real = [], upsert.merge_rows

    def seen(*args, **kwargs):
        merged = real(*args, **kwargs)
        merges.append(exchanged(merged))
        return merged

    monkeypatch.setattr(upsert, "merge_rows", seen)
    sent = spark.range(1990, 2010).selectExpr("id as post_id", "1L as owner", "'new' as v")
    for _ in range(2):
        upsert_table(sent, table, "post_id")
        found = spark.table(table)
        assert found.agg(F.count("*"), F.count_if(F.col("v") == "new"), F.count_distinct("post_id")).first() == (2010, 20, 2010)
        assert len(found.inputFiles()) == 8
    # The one exchange is that of the source, of 20 rows.
    assert [len(m) for m in merges] == [1, 1] and all(m[0].startswith("__key_0") for m in merges)


def test_a_hot_code_of_a_large_lookup_is_spread(spark, no_broadcast):
    """One code on nine rows of ten, and a lookup that is not broadcast."""
    facts = spark.range(20_000).selectExpr("id", "if(id % 10 < 9, 7L, id % 97) as code", "cast(null as map<string, int>) as m")
    lookup = spark.range(90).selectExpr("id as code", "concat('label ', id) as label")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="16"):
        largest = {}
        for salts in (1, 64):
            labelled = label_lookup(facts, lookup, "code", "code", "label", salts=salts)
            rows = labelled.select("id", "code", "label", F.spark_partition_id().alias("p"))
            largest[salts] = rows.groupBy("p").count().agg(F.max("count")).first()[0]
            assert rows.select("id").distinct().count() == rows.count() == 20_000
            assert rows.where("label <> if(code < 90, concat('label ', code), 'Unknown')").isEmpty()
        assert largest[1] >= 18_000 and largest[64] < 5_000


def test_the_copies_of_a_salted_lookup_are_not_broadcast(spark, tmp_path):
    """A lookup that is under the threshold without its copies, as the planner counts it."""
    once = spark.range(400).selectExpr(
        "id as l_orderkey",
        "cast(id % 3 as int) as l_linenumber",
        "if(id % 10 < 7, 15L, if(id % 10 = 7, null, id % 40)) as l_partkey",
    )
    once.union(once).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(30).selectExpr("id as p_partkey", "if(id % 7 = 0, null, concat('part ', id)) as p_name").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 1_000_000
    labelled = driver.salted_labels(spark, str(tmp_path))
    rows = sorted(map(tuple, labelled.collect()), key=str)
    assert "Broadcast" not in plan_of(labelled) and "SortMergeJoin" in plan_of(labelled)

    def part_of(i):
        return 15 if i % 10 < 7 else None if i % 10 == 7 else i % 40

    def name_of(key):
        return f"part {key}" if key is not None and 10 < key < 30 and key % 7 else "Unknown"

    assert rows == sorted([(i, i % 3, part_of(i), name_of(part_of(i))) for i in range(400)] * 2, key=str)
