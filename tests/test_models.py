"""Silver and gold on the sample dumps, and the cases the samples lack."""

import pytest
from pyspark.sql import functions as F

from postmill.operators import clean_columns, label_lookup, left_join_dimension, project
from postmill.plans import gold, reports, silver
from postmill.schemas import POST_TYPES, POSTS, USERS
from postmill.sources import load_rows, lookup_table, post_types, read_seed, read_table


@pytest.fixture(scope="module")
def staged(spark, dumps):
    posts = clean_columns(load_rows(spark, dumps["posts"], POSTS))
    users = clean_columns(load_rows(spark, dumps["users"], USERS))
    return silver.stg_posts(posts, post_types(spark)), silver.stg_users(users)


def bronze_posts(spark, rows):
    """Posts from partial rows; what is not given is NULL."""
    names = POSTS.names
    full = [tuple(row.get(name) for name in names) for row in rows]
    return spark.createDataFrame(full, POSTS)


def bronze_users(spark, rows):
    full = [tuple(row.get(name) for name in USERS.names) for row in rows]
    return spark.createDataFrame(full, USERS)


# --- columns --------------------------------------------------------------------------


def test_clean_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["_Id", "__Two_Parts", "Plain"])
    once = clean_columns(df)
    assert once.columns == ["Id", "Two_Parts", "Plain"]
    assert clean_columns(once).columns == once.columns
    assert once.collect() == [(1, 2, 3)]


@pytest.mark.parametrize("names", [["_Id", "Id"], ["_Id", "__ID"], ["__", "a"]])
def test_clean_columns_refuses_a_clash(spark, names):
    with pytest.raises(ValueError):
        clean_columns(spark.createDataFrame([(1, 2)], names))


def test_project_fixes_the_order(spark):
    df = spark.createDataFrame([(1, "x")], ["a", "b"])
    got = project(df, {"second": "b", "first": F.col("a") + 1})
    assert got.columns == ["second", "first"] and got.collect() == [("x", 2)]


# --- seeds ----------------------------------------------------------------------------


def test_post_types(spark):
    rows = post_types(spark).collect()
    assert [tuple(r) for r in rows] == POST_TYPES and len(rows) == 15
    assert {11, 16}.isdisjoint(r["post_type_id"] for r in rows)


def test_seed_from_csv(spark, tmp_path):
    path = tmp_path / "types.csv"
    path.write_text("post_type_id,post_type\n1,Question\n2,\"Answer, too\"\n")
    seed = read_seed(spark, str(path), "post_type_id INT, post_type STRING")
    assert sorted(map(tuple, seed.collect())) == [(1, "Question"), (2, "Answer, too")]


def test_read_table_by_name_and_by_path(spark, database, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spark.range(4).write.saveAsTable(f"{database}.t")
    assert read_table(spark, str(tmp_path / "t")).count() == 3
    assert read_table(spark, f"{database}.t").count() == 4


def test_post_types_from_a_seed(spark, tmp_path):
    path = tmp_path / "types.csv"
    path.write_text("post_type_id,post_type\n1,Recipe\n")
    assert [tuple(r) for r in post_types(spark, str(path)).collect()] == [(1, "Recipe")]


# --- silver ---------------------------------------------------------------------------


def test_stg_users(staged):
    _, users = staged
    rows = {r["user_id"]: r for r in users.collect()}
    assert len(users.columns) == 11 and len(rows) == 6 and "about_me" not in users.columns
    assert {i for i, r in rows.items() if r["website_url"] is None} == {-1, 31, 40}
    assert {i for i, r in rows.items() if r["location"] is None} == {31, 40, 52}


def test_stg_posts(staged):
    posts, _ = staged
    rows = {r["post_id"]: r for r in posts.collect()}
    assert len(posts.columns) == 23
    assert {i: r["tags_array"] and len(r["tags_array"]) for i, r in rows.items()} == {
        11: 2, 12: 3, 15: None, 16: 1, 17: None, 21: None, 22: 3,
    }
    assert rows[22]["tags_array"] == ["yeast", "rye", "sourdough"]
    assert [rows[i]["post_type"] for i in (11, 12, 15, 16, 17, 21)] == [
        "Question", "Question", "Answer", "Question", "Answer", "Tag wiki",
    ]


def test_unmapped_types_and_blank_tags(spark):
    posts = bronze_posts(
        spark,
        [
            {"Id": 1, "PostTypeId": 11, "Tags": ""},
            {"Id": 2, "PostTypeId": None, "Tags": "||"},
            {"Id": 3, "PostTypeId": 17, "Tags": "|a|a|"},
        ],
    )
    rows = {r["post_id"]: r for r in silver.stg_posts(posts, post_types(spark)).collect()}
    assert [rows[i]["post_type"] for i in (1, 2, 3)] == [
        "Unknown", "Unknown", "CollectiveCollection",
    ]
    assert [rows[i]["tags_array"] for i in (1, 2, 3)] == [[], [], ["a", "a"]]


def test_label_lookup_keeps_every_row(spark):
    labels = lookup_table(spark, [("x", "Ex")], spark.createDataFrame([], "k string, name string").schema)
    df = spark.createDataFrame([("x",), ("y",), (None,), ("x",)], "code string")
    got = label_lookup(df, labels, "code", "k", "name", default="?")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("x", "Ex"), ("x", "Ex"), ("y", "?"), (None, "?")], key=str
    )


# --- gold -----------------------------------------------------------------------------


@pytest.mark.parametrize("unique_posts", [False, True])
def test_top_tags(staged, unique_posts):
    posts, _ = staged
    rows = [tuple(r) for r in gold.top_tags(posts, unique_posts=unique_posts).collect()]
    assert len(rows) == 6
    assert rows[:3] == [("yeast", 3), ("rye", 2), ("bread", 1)]
    assert [t for t, n in rows if n == 1] == sorted(t for t, n in rows if n == 1)
    assert [tuple(r) for r in gold.top_tags(posts, 2).collect()] == rows[:2]


def test_top_tags_count_a_post_once(spark):
    rows = [(1, ["a", "a", "b"]), (1, ["a"]), (2, ["a"]), (3, None), (4, []), (None, ["b"])]
    stg = spark.createDataFrame(rows, "post_id long, tags_array array<string>")
    assert [tuple(r) for r in gold.top_tags(stg).collect()] == [("a", 2), ("b", 1)]
    once = stg.where("post_id = 2 or size(tags_array) = 3 or post_id is null")
    assert gold.top_tags(once, unique_posts=True).collect() == gold.top_tags(once).collect()


def test_posts_users(staged):
    wide = gold.posts_users(*staged)
    rows = {r["post_id"]: r for r in wide.collect()}
    assert len(wide.columns) == 22 and wide.count() == 7
    status = {i: r["author_status"] for i, r in rows.items()}
    assert status == {
        11: "resolved", 12: "resolved", 15: "resolved", 16: "unresolved", 17: "anonymous",
        21: "resolved", 22: "resolved",
    }
    assert rows[11]["display_name"] == "paula" and rows[11]["user_location"] == "Oslo, NO"
    assert rows[16]["owner_user_id"] == 77 and rows[16]["user_id"] is None


def test_posts_without_owner_never_match(spark):
    """Not even when the hash that spreads them equals a user id."""
    hashed = spark.range(1).select(F.xxhash64(F.lit(77).cast("long"))).first()[0]
    posts = bronze_posts(
        spark,
        [
            {"Id": 77, "PostTypeId": 1, "OwnerUserId": None},
            {"Id": 78, "PostTypeId": 1, "OwnerUserId": hashed},
            {"Id": 79, "PostTypeId": 1, "OwnerUserId": -1},
        ],
    )
    users = bronze_users(spark, [{"Id": hashed, "DisplayName": "h"}, {"Id": -1}, {"Id": None}])
    wide = gold.posts_users(silver.stg_posts(posts, post_types(spark)), silver.stg_users(users))
    assert {r["post_id"]: r["author_status"] for r in wide.collect()} == {
        77: "anonymous", 78: "resolved", 79: "resolved",
    }


def test_left_join_dimension_with_text_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id long, k string").alias("f")
    dim = spark.createDataFrame([("a", 10)], "k string, v long").alias("d")
    joined = left_join_dimension(fact, dim, F.col("f.k"), F.col("d.k"), F.col("f.id"))
    assert sorted(map(tuple, joined.select("id", "v").collect()), key=lambda r: r[0]) == [
        (1, 10), (2, None), (3, None),
    ]


@pytest.mark.parametrize("kind", ["int", "long", "decimal(10,0)", "date", "string"])
def test_left_join_dimension_with_null_keys_of_any_type(spark, kind):
    value = "date_add(date'2020-01-01', cast(id as int))" if kind == "date" else f"cast(id as {kind})"
    facts = spark.range(6).selectExpr("id", f"case when id % 3 > 0 then {value} end as k").alias("f")
    dim = spark.range(5).selectExpr(f"{value} as k", "id * 10 as v").unionByName(
        spark.range(1).selectExpr(f"cast(null as {kind}) as k", "99L as v")
    ).alias("d")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_join_dimension(facts, dim, F.col("f.k"), F.col("d.k"), F.col("f.id"))
        got = sorted(map(tuple, joined.select("id", "v").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(0, None), (1, 10), (2, 20), (3, None), (4, 40), (5, None)]


def test_left_join_dimension_with_keys_of_two_types(spark):
    facts = spark.createDataFrame([(1, 7), (2, None)], "id long, k int").alias("f")
    dim = spark.createDataFrame([(7, 1), (1 << 40, 2)], "k long, v int").alias("d")
    joined = left_join_dimension(facts, dim, F.col("f.k"), F.col("d.k"), F.col("f.id"))
    assert sorted(map(tuple, joined.select("id", "v").collect())) == [(1, 1), (2, None)]


# --- reports --------------------------------------------------------------------------

GOLD_SCHEMA = """post_id long, post_type string, score long, view_count long, answer_count long,
 post_creation_date timestamp, owner_user_id long, user_id long, display_name string,
 reputation long, author_status string"""
GOLD_ROWS = [
    (61, "Question", 4, 30, 1, "2015-02-03", 7, 7, "ines", 310, "resolved"),
    (62, "Answer", 11, None, None, "2015-08-21", 9, 9, "juro", 120, "resolved"),
    (63, "Question", 0, 17, 0, "2016-12-31", None, None, None, None, "anonymous"),
    (64, "Answer", -1, None, None, "2017-01-01", 7, 7, "ines", 310, "resolved"),
    (65, "Question", 8, 45, 2, "2017-05-06", 12, None, None, None, "unresolved"),
    (66, "Tag wiki", 0, None, None, "2018-03-03", 15, 15, "kaya", 5, "resolved"),
    (67, "Question", 2, 3, None, "2016-07-07", 9, 9, "juro", 120, "resolved"),
]
TAG_ROWS = [("kneading", 9), ("baking", 5), ("proofing", 5)]


def gold_table(spark, rows):
    texts = GOLD_SCHEMA.replace("post_creation_date timestamp", "post_creation_date string")
    df = spark.createDataFrame(rows, texts)
    return df.withColumn("post_creation_date", F.col("post_creation_date").cast("timestamp"))


@pytest.fixture(scope="module")
def gold_tables(spark):
    return gold_table(spark, GOLD_ROWS), spark.createDataFrame(TAG_ROWS, "tag string, post_count long")


def test_kpis(gold_tables):
    kpis = reports.gold_kpis(*gold_tables).first().asDict()
    assert kpis["answered_pct"] == pytest.approx(50)
    assert kpis["answers_per_question"] == pytest.approx(0.5)
    del kpis["answered_pct"], kpis["answers_per_question"]
    assert kpis == {
        "posts": 7, "questions": 4, "answers": 2, "authors": 4,
        "first_post": "2015-02-03", "last_post": "2018-03-03",
        "first_year": "2015", "last_year": "2018",
        "unanswered": 2, "answered": 2, "tags_ranked": 3,
    }


def test_years_and_peak(gold_tables):
    by_year = reports.posts_by_year(gold_tables[0])
    assert [tuple(r) for r in by_year.collect()] == [
        (2015, 1, 1, 2), (2016, 2, 0, 2), (2017, 1, 1, 2), (2018, 0, 0, 1),
    ]
    assert tuple(reports.peak_year(by_year).first()) == (2015, 1, 1, 2)


def test_posts_without_a_date_come_last(spark):
    rows = [*GOLD_ROWS, (68, "Answer", 1, 1, 1, None, None, None, None, None, "anonymous")]
    by_year = reports.posts_by_year(gold_table(spark, rows))
    assert [r["year"] for r in by_year.collect()] == [2015, 2016, 2017, 2018, None]


def test_score_bands_are_zero_filled(gold_tables):
    rows = [(r["band"], r["posts"]) for r in reports.score_bands(gold_tables[0]).collect()]
    assert rows == [("negative", 1), ("zero", 2), ("1-4", 2), ("5-19", 2), ("20+", 0)]
    empty = reports.score_bands(gold_tables[0].limit(0)).collect()
    assert [r["posts"] for r in empty] == [0, 0, 0, 0, 0]


def test_null_scores(spark):
    rows = [(None,), (25,)]
    df = spark.createDataFrame(rows, "score long")
    assert [r["posts"] for r in reports.score_bands(df).collect()] == [0, 0, 0, 0, 2]
    assert [tuple(r) for r in reports.score_bands(df, "none").collect()][-2:] == [
        (4, "20+", 1), (5, "none", 1),
    ]


def test_unanswered_status_and_tags(gold_tables):
    posts, tags = gold_tables
    assert reports.unanswered(posts).first()[0] == 2
    statuses = [("resolved", 5), ("anonymous", 1), ("unresolved", 1)]
    assert [tuple(r) for r in reports.author_status_counts(posts).collect()] == statuses
    counts = reports.status_by_band(posts)
    assert [tuple(r) for r in reports.status_of(counts).collect()] == statuses
    assert reports.bands_of(counts).collect() == reports.score_bands(posts).collect()
    none = reports.status_by_band(posts.limit(0))
    assert [r["posts"] for r in reports.bands_of(none).collect()] == [0] * 5
    assert [tuple(r) for r in reports.report_tags(tags, 2).collect()] == TAG_ROWS[:2]


def test_top_authors(gold_tables):
    assert [tuple(r) for r in reports.top_authors(gold_tables[0]).collect()] == [
        ("ines", 2, 310), ("juro", 2, 120), ("kaya", 1, 5),
    ]
    assert len(reports.top_authors(gold_tables[0], 2).collect()) == 2


def test_namesakes(spark):
    rows = [
        (i, "Answer", 1, 1, 1, "2020-01-01", user, user, "sam", user * 10, "resolved")
        for i, user in enumerate([1, 1, 2])
    ]
    posts = gold_table(spark, rows)
    assert [tuple(r) for r in reports.top_authors(posts).collect()] == [("sam", 3, 20)]
    assert [tuple(r) for r in reports.top_author_accounts(posts).collect()] == [
        (1, "sam", 2, 10), (2, "sam", 1, 20),
    ]


def test_nothing_to_report_is_refused(gold_tables):
    posts, tags = gold_tables
    with pytest.raises(ValueError, match="empty"):
        reports.require_reportable(reports.gold_kpis(posts.limit(0), tags))
    with pytest.raises(ValueError, match="no questions"):
        reports.require_reportable(reports.gold_kpis(posts.where("post_type = 'Answer'"), tags))
