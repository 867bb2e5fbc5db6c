import pytest

from pyspark.sql import functions as F

from postmill.operators.quality import ERRORS, CheckFailed
from postmill.plans import gold as gold_plans
from postmill.plans import pipeline
from postmill.plans.pipeline import (
    CHECKS,
    build_lakehouse,
    build_models,
    judge_posts,
    upsert_posts,
    write_reports,
)
from postmill.schemas import POSTS, USERS
from tests.dumps import POSTS_XML, USERS_XML


@pytest.fixture
def databases(spark, database):
    gold = database + "_gold"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {gold}")
    yield database, gold
    spark.sql(f"DROP DATABASE {gold} CASCADE")


def build(spark, dumps, databases, **kwargs):
    return build_lakehouse(
        spark, dumps["posts"], dumps["users"], bronze_db=databases[0], gold_db=databases[1], **kwargs
    )


def test_the_promises_number_twenty():
    single = [c.not_null + c.unique + c.accepted + c.no_empty_arrays for c in CHECKS.values()]
    assert sum(map(len, single)) == 20


def test_the_whole_build(spark, dumps, databases):
    bronze, gold = databases
    for quarantine in (False, True):
        built = build(spark, dumps, databases, quarantine=quarantine)
        assert built.rows == {f"{bronze}.posts": 7, f"{bronze}.users": 6}
        assert spark.table(f"{gold}.marts_posts_users").count() == 7
        assert spark.table(f"{gold}.marts_top_tags").count() == 6
    kpis = built.reports["report_kpis"].first()
    assert (kpis["posts"], kpis["questions"], kpis["answers"], kpis["authors"]) == (7, 4, 2, 4)
    assert (kpis["first_post"], kpis["last_post"], kpis["tags_ranked"]) == (
        "2019-03-14", "2022-01-09", 6,
    )
    assert tuple(built.reports["report_posts_by_year"].first()) == (2019, 1, 1, 2)
    assert built.reports["report_unanswered"].first()[0] == 2
    bands = {r["band"]: r["posts"] for r in built.reports["report_score_bands"].collect()}
    assert bands == {"negative": 1, "zero": 1, "1-4": 2, "5-19": 2, "20+": 1}
    authors = [tuple(r) for r in built.reports["report_top_authors"].collect()]
    assert authors == [("paula", 2, 1840), ("quentin", 2, 96), ("system", 1, 1)]
    names = {t.name for t in spark.catalog.listTables(gold) if not t.isTemporary}
    assert not any("__" in name for name in names) and len(names) == 11
    # The silver models can be queried by name.
    assert spark.sql("select count(*) from stg_posts").first()[0] == 7
    assert spark.sql("select count(*) from stg_users where location is null").first()[0] == 3


def rewritten(tmp_path, text, name):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_a_repeated_user_stops_the_build(spark, dumps, databases, tmp_path):
    again = USERS_XML.replace('<row Id="52"', '<row Id="5"')
    paths = {**dumps, "users": rewritten(tmp_path, again, "u.xml")}
    with pytest.raises(CheckFailed, match=r"stg_users: unique\(user_id\): 1"):
        build(spark, paths, databases)
    assert not spark.catalog.tableExists(f"{databases[1]}.marts_posts_users")


def test_blank_tags_stop_the_build(spark, dumps, databases, tmp_path):
    blank = POSTS_XML.replace('Tags="|rye|"', 'Tags=""')
    paths = {**dumps, "posts": rewritten(tmp_path, blank, "p.xml")}
    with pytest.raises(CheckFailed, match=r"no_empty_arrays\(tags_array\): 1"):
        build(spark, paths, databases)


def test_a_broken_gold_table_never_replaces_a_good_one(spark, dumps, databases, monkeypatch):
    bronze, gold = databases
    build(spark, dumps, databases)
    real = gold_plans.top_tags
    monkeypatch.setattr(gold_plans, "top_tags", lambda *a, **k: real(*a, **k).unionAll(real(*a, **k)))
    with pytest.raises(CheckFailed, match=r"unique\(tag\)"):
        build_models(spark, f"{bronze}.posts", f"{bronze}.users", gold)
    assert spark.table(f"{gold}.marts_top_tags").count() == 6


def test_models_from_paths_and_a_seed(spark, dumps, databases, tmp_path):
    bronze, gold = databases
    build(spark, dumps, databases)
    for name in ("posts", "users"):
        spark.table(f"{bronze}.{name}").write.parquet(str(tmp_path / name))
    seed = rewritten(tmp_path, "post_type_id,post_type\n1,Recipe\n2,Answer\n", "types.csv")
    build_models(spark, str(tmp_path / "posts"), str(tmp_path / "users"), gold, types_seed=seed)
    rows = spark.table(f"{gold}.marts_posts_users").groupBy("post_type").count().collect()
    assert {tuple(r) for r in rows} == {("Recipe", 4), ("Answer", 2), ("Unknown", 1)}


def test_posts_are_judged_by_rules(spark, dumps, databases):
    bronze, _ = databases
    build(spark, dumps, databases)
    as_of = F.lit("2021-12-31").cast("timestamp")
    judge_posts(spark, f"{bronze}.posts", f"{bronze}.valid", f"{bronze}.refused", as_of=as_of)
    valid, refused = spark.table(f"{bronze}.valid"), spark.table(f"{bronze}.refused")
    assert sorted(r["Id"] for r in valid.collect()) == [11, 12, 15, 16, 17, 21]
    assert [(r["Id"], r[ERRORS]) for r in refused.collect()] == [(22, ["CreationDate_in_future"])]


def test_silver_posts_are_brought_up_to_date(spark, dumps, databases, tmp_path):
    bronze, _ = databases
    build(spark, dumps, databases)
    table = f"{bronze}.stg_posts"
    upsert_posts(spark, f"{bronze}.posts", table)
    changed = spark.table(f"{bronze}.posts").where("Id = 12").selectExpr(
        *["99L as Score" if c == "Score" else c for c in POSTS.names]
    )
    changed.write.parquet(str(tmp_path / "late"))
    for _ in range(2):
        upsert_posts(spark, str(tmp_path / "late"), table)
        assert spark.table(table).count() == 7
        assert spark.table(table).where("post_id = 12").first()["score"] == 99


def test_reports_read_the_wide_table_four_times(spark, dumps, databases, monkeypatch):
    _, gold = databases
    build(spark, dumps, databases)
    written = []
    real = pipeline.write_table

    def noted(df, table, *args, **kwargs):
        written.append(df._jdf.queryExecution().analyzed().toString().count("marts_posts_users"))
        real(df, table, *args, **kwargs)

    monkeypatch.setattr(pipeline, "write_table", noted)
    write_reports(spark, gold)
    assert sum(n > 0 for n in written) == 4


def test_empty_gold_leaves_no_report(spark, databases):
    bronze, gold = databases
    spark.createDataFrame([], POSTS).write.saveAsTable(f"{bronze}.posts")
    spark.createDataFrame([], USERS).write.saveAsTable(f"{bronze}.users")
    build_models(spark, f"{bronze}.posts", f"{bronze}.users", gold)
    with pytest.raises(ValueError, match="empty"):
        write_reports(spark, gold)
    names = {t.name for t in spark.catalog.listTables(gold) if not t.isTemporary}
    assert names == {"marts_top_tags", "marts_posts_users"}
