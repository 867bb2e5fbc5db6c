import time

import pytest
from pyspark.sql import functions as F

from postmill.functions import timestamp_text
from postmill.operators import clean_columns
from postmill.operators.quality import schema_problems
from postmill.plans.ingest import TooFewRows, ingest
from postmill.schemas import POSTS, USERS, attribute_schema
from postmill.sinks import BATCH, append_batch, batches
from postmill.sources import FILE, RAW, REASON, load_rows, split_rejects

LAYOUTS = ["lines", "file"]


def write(tmp_path, text, name="dump.xml", **kwargs):
    path = tmp_path / name
    path.write_text(text, **({"encoding": "utf-8"} | kwargs))
    return str(path)


def dump(*rows):
    return "<?xml version='1.0'?>\n<users>\n" + "\n".join(rows) + "\n</users>\n"


@pytest.mark.parametrize("layout", LAYOUTS)
def test_posts_contract_and_values(spark, dumps, layout):
    raw = load_rows(spark, dumps["posts"], POSTS, layout=layout)
    assert raw.schema == attribute_schema(POSTS)
    posts = clean_columns(raw)
    assert posts.schema == POSTS and len(POSTS) == 22
    rows = {r["Id"]: r for r in posts.collect()}
    assert sorted(rows) == [11, 12, 15, 16, 17, 21, 22]
    assert rows[11]["Body"] == '<p>Does dough "rest" at night?</p>\n'
    assert rows[12]["Body"] == "<p>Salt &amp; sugar</p>\n"
    answer = rows[15]
    assert answer["ParentId"] == 11 and answer["Score"] == 9
    assert answer["Tags"] is None and answer["Title"] is None and answer["ViewCount"] is None
    assert posts.filter(F.col("PostTypeId") == 2).count() == 2


@pytest.mark.parametrize("layout", LAYOUTS)
def test_users_keep_absent_and_empty_apart(spark, dumps, layout):
    users = clean_columns(load_rows(spark, dumps["users"], USERS, layout=layout))
    rows = {r["Id"]: r for r in users.collect()}
    assert rows[-1]["WebsiteUrl"] == "" and rows[40]["AboutMe"] == ""
    assert rows[31]["WebsiteUrl"] is None and rows[31]["AboutMe"] is None
    shown = users.select("Id", timestamp_text(F.col("CreationDate")).alias("t")).collect()
    assert dict((r["Id"], r["t"]) for r in shown)[-1] == "2018-05-05T05:05:05.050"
    assert users.select("Id").distinct().count() == 6


def test_both_layouts_read_the_same(spark, dumps):
    for name, schema in (("posts", POSTS), ("users", USERS)):
        lines = load_rows(spark, dumps[name], schema, layout="lines")
        whole = load_rows(spark, dumps[name], schema, layout="file")
        assert lines.exceptAll(whole).isEmpty() and whole.exceptAll(lines).isEmpty()


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_wrong_row_tag_gives_no_rows(spark, dumps, layout):
    assert load_rows(spark, dumps["users"], USERS, row_tag="post", layout=layout).count() == 0


def test_inferred_schema(spark, dumps):
    inferred = load_rows(spark, dumps["users"], None)
    assert set(inferred.columns) == set(attribute_schema(USERS).names)
    assert inferred.count() == 6


@pytest.mark.parametrize("layout", LAYOUTS)
def test_spaces_in_text_are_kept(spark, tmp_path, layout):
    path = write(tmp_path, dump('<row Id="1" DisplayName="  pad &lt;p&gt; &#xA;" Location=" " />'))
    row = load_rows(spark, path, USERS, layout=layout).first()
    assert row["_DisplayName"] == "  pad <p> \n" and row["_Location"] == " "


def test_unusual_but_valid_lines(spark, tmp_path):
    text = (
        '﻿<?xml version="1.0"?>\r\n<users>\r\n\r\n<!-- no rows here -->\r\n'
        '\t<row Id="1" DisplayName="a > b" />\t\r\n<row Id="2"/>\r\n<row Id="3"></row>\r\n'
        '<row/>\r\n<rowset Id="9"/>\r\n</users>'
    )
    path = write(tmp_path, text, newline="")
    rows = load_rows(spark, path, USERS).select("_Id", "_DisplayName").collect()
    assert sorted(rows, key=str) == sorted(
        [(1, "a > b"), (2, None), (3, None), (None, None)], key=str
    )


def test_a_dump_without_markup_around_it(spark, tmp_path):
    path = write(tmp_path, '﻿<row Id="1"/>\n<row Id="2"/>')
    assert sorted(r["_Id"] for r in load_rows(spark, path, USERS).collect()) == [1, 2]


BAD_VALUES = [
    '<row Id="x1" DisplayName="letters" />',
    '<row Id="2" Reputation="" />',
    '<row Id="3" CreationDate="yesterday" />',
]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("row", BAD_VALUES)
def test_a_bad_value_fails_the_job(spark, tmp_path, row, layout):
    path = write(tmp_path, dump('<row Id="7" />', row))
    rows = load_rows(spark, path, USERS, layout=layout)
    with pytest.raises(Exception, match="bad value"):
        rows.collect()
    with pytest.raises(Exception, match="bad value"):
        rows.count()


@pytest.mark.parametrize("layout", LAYOUTS)
def test_bad_values_are_quarantined(spark, tmp_path, layout):
    both = '<row Id="q" Views="w" />'
    path = write(tmp_path, dump('<row Id="7" Views="1" />', *BAD_VALUES, both))
    rows = load_rows(spark, path, USERS, layout=layout, on_bad="quarantine")
    good, refused = split_rejects(rows)
    assert good.schema == attribute_schema(USERS)
    assert [r["_Id"] for r in good.collect()] == [7]
    reasons = sorted(r[REASON] for r in refused.collect())
    assert reasons == [
        "bad value: _CreationDate",
        "bad value: _Id",
        "bad value: _Id, _Views",
        "bad value: _Reputation",
    ]
    assert all(r[RAW] for r in refused.collect())


BROKEN_LAYOUT = [
    '<row Id="1"\n  DisplayName="over two lines" />',
    '<row Id="1" /><row Id="2" />',
    '<row Id="1"><Child/></row>',
    '<users><row Id="1" /></users>',
    "stray text",
]


@pytest.mark.parametrize("row", BROKEN_LAYOUT)
def test_lines_that_do_not_fit_are_never_lost(spark, tmp_path, row):
    path = write(tmp_path, dump('<row Id="7" />', row))
    with pytest.raises(Exception, match="one element per line"):
        load_rows(spark, path, USERS).count()
    good, refused = split_rejects(load_rows(spark, path, USERS, on_bad="quarantine"))
    assert [r["_Id"] for r in good.collect()] == [7]
    assert sorted(r[RAW].strip() for r in refused.collect()) == sorted(
        line.strip() for line in row.split("\n")
    )


def test_malformed_xml_is_named(spark, tmp_path):
    path = write(tmp_path, dump('<row Id="1" Id="2" />', '<row Id="3" DisplayName="&nope;" />'))
    _, refused = split_rejects(load_rows(spark, path, USERS, on_bad="quarantine"))
    assert [r[REASON] for r in refused.collect()] == ["malformed XML"] * 2


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [f'  <row Id="{i}" DisplayName="user {i} é" />' for i in range(20_000)]
    path = write(tmp_path, dump(*rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        users = load_rows(spark, path, USERS)
        assert users.rdd.getNumPartitions() > 4
        assert users.agg(F.count_distinct("_Id"), F.sum("_Id")).first() == (20_000, 199_990_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_filter_does_not_repeat_the_parse(spark, dumps):
    rows = load_rows(spark, dumps["posts"], POSTS).where("_Score > 10")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1


@pytest.mark.parametrize("on_bad", ["fail", "quarantine"])
def test_filters_and_joins_on_a_scan_stay_cheap_to_plan(spark, dumps, on_bad):
    """The checks of all attributes must not spread through the plan as constraints."""
    rows = load_rows(spark, dumps["posts"], POSTS, on_bad=on_bad)
    good = rows if on_bad == "fail" else split_rejects(rows)[0]
    posts = clean_columns(good)
    answers = posts.where("ParentId is not null").select(F.col("ParentId").alias("asked"))
    start = time.monotonic()
    found = posts.where("Score > 1").join(answers, posts["Id"] == answers["asked"])
    assert [r["Id"] for r in found.distinct().collect()] == [11]
    assert time.monotonic() - start < 60


# --- ingest ---------------------------------------------------------------------------


@pytest.mark.parametrize("layout", LAYOUTS)
def test_ingest_round_trip_and_rerun(spark, database, dumps, layout):
    table = f"{database}.users"
    for _ in range(2):
        assert ingest(spark, dumps["users"], table, USERS, layout=layout) == 6
        stored = spark.table(table)
        assert stored.count() == 6
        assert schema_problems(stored, USERS) == []
    assert not any(name.startswith("_") for name in stored.columns)


def test_ingest_appends(spark, database, dumps):
    table = f"{database}.users"
    for expected in (6, 12):
        ingest(spark, dumps["users"], table, USERS, write_mode="append")
        assert spark.table(table).count() == expected


def test_ingest_refuses_too_few_rows_and_keeps_the_old_table(spark, database, dumps):
    table = f"{database}.users"
    ingest(spark, dumps["users"], table, USERS)
    with pytest.raises(TooFewRows):
        ingest(spark, dumps["users"], table, USERS, row_tag="post")
    with pytest.raises(TooFewRows):
        ingest(spark, dumps["users"], table, USERS, min_rows=7)
    assert spark.table(table).count() == 6
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["users"]


def test_a_failed_ingest_keeps_the_old_table(spark, database, dumps, tmp_path):
    table = f"{database}.users"
    ingest(spark, dumps["users"], table, USERS)
    bad = write(tmp_path, dump('<row Id="oops" />'))
    with pytest.raises(Exception, match="bad value"):
        ingest(spark, bad, table, USERS)
    assert spark.table(table).count() == 6
    assert ingest(spark, dumps["users"], table, USERS) == 6


def test_ingest_with_quarantine(spark, database, dumps, tmp_path):
    table, refused = f"{database}.users", f"{database}.users_refused"
    mixed = write(tmp_path, dump('<row Id="7" />', *BAD_VALUES))
    assert ingest(spark, mixed, table, USERS, quarantine_table=refused) == 1
    assert spark.table(refused).count() == 3
    assert ingest(spark, dumps["users"], table, USERS, quarantine_table=refused) == 6
    assert spark.table(refused).count() == 0
    assert schema_problems(spark.table(table), USERS) == []


@pytest.mark.parametrize("layout", LAYOUTS)
def test_valid_and_refused_rows_come_from_one_read(spark, database, tmp_path, layout, monkeypatch):
    write(tmp_path, dump('<row Id="1" />'), name="Users 1.xml")
    write(tmp_path, dump('<row Id="2" />', *BAD_VALUES), name="Users 2 100%é[a].xml")
    write(tmp_path, dump('<row Id="x" />', '<row Id="3" />'), name="Users 3.xml")
    scans = []

    def counted(spark, path, *args):
        scans.append(path)
        return load_rows(spark, path, *args)

    monkeypatch.setattr("postmill.plans.ingest.load_rows", counted)
    table, refused = f"{database}.users", f"{database}.refused"
    path = f"{tmp_path}/Users*.xml"
    assert ingest(spark, path, table, USERS, layout=layout, quarantine_table=refused) == 3
    assert len(scans) == 1
    rows = spark.table(refused).groupBy(FILE).count().collect()
    assert sorted(r["count"] for r in rows) == [1, 3]
    assert sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary) == ["refused", "users"]


def test_a_failing_quarantine_write_publishes_nothing(spark, database, dumps, tmp_path, monkeypatch):
    table, refused = f"{database}.users", f"{database}.refused"
    ingest(spark, dumps["users"], table, USERS)
    real = ingest.__globals__["write_table"]

    def failing(df, name, *args, **kwargs):
        if name == refused:
            raise OSError("no space")
        real(df, name, *args, **kwargs)

    monkeypatch.setitem(ingest.__globals__, "write_table", failing)
    mixed = write(tmp_path, dump('<row Id="7" />', *BAD_VALUES))
    with pytest.raises(OSError):
        ingest(spark, mixed, table, USERS, quarantine_table=refused)
    assert spark.table(table).count() == 6
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["users"]


@pytest.mark.parametrize("quarantine", [False, True])
def test_a_short_append_adds_nothing(spark, database, dumps, quarantine):
    table = f"{database}.users"
    refused = f"{database}.refused" if quarantine else None
    ingest(spark, dumps["users"], table, USERS)
    with pytest.raises(TooFewRows):
        ingest(spark, dumps["users"], table, USERS, write_mode="append", min_rows=7, quarantine_table=refused)
    assert spark.table(table).count() == 6
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["users"]


def held(spark, table):
    return sorted((r["Id"], r[BATCH] or "") for r in spark.table(table).collect())


@pytest.mark.parametrize("fails_at", ["refused", "users", "users_batches"])
def test_a_failed_batch_that_is_retried_has_each_line_once(spark, database, tmp_path, monkeypatch, fails_at):
    """Whatever the first attempt has written before it died, the retry replaces."""
    table, refused = f"{database}.users", f"{database}.refused"
    first = write(tmp_path, dump('<row Id="1" />', '<row Id="x" />'), name="1.xml")
    second = write(tmp_path, dump('<row Id="2" />', '<row Id="3" />', '<row Id="y" />'), name="2.xml")

    def load(path, batch):
        return ingest(spark, path, table, USERS, write_mode="append", quarantine_table=refused, batch=batch)

    load(first, "day 1")
    real = batches.append_batch

    def dies(df, name, *args):
        if name.endswith("." + fails_at):
            if "batches" not in name:
                real(df.limit(1), name, *args)  # some of it is there already
            raise KeyboardInterrupt
        real(df, name, *args)

    with monkeypatch.context() as patched:
        patched.setitem(ingest.__globals__, "append_batch", dies)
        patched.setattr(batches, "append_batch", dies)
        with pytest.raises(KeyboardInterrupt):
            load(second, "day 2")
        complete = [r[BATCH] for r in spark.table(f"{table}_batches").collect()]
        assert complete == ["day 1"]
    for _ in range(2):
        assert load(second, "day 2") == 2
        assert held(spark, table) == [(1, "day 1"), (2, "day 2"), (3, "day 2")]
        assert sorted(r[BATCH] for r in spark.table(refused).collect()) == ["day 1", "day 2"]
        lines = spark.table(f"{table}_batches").select(BATCH, "n_rows", "n_refused").collect()
        assert sorted(map(tuple, lines)) == [("day 1", 1, 1), ("day 2", 2, 1)]
    assert schema_problems(spark.table(table).drop(BATCH), USERS) == []


def test_batches_join_rows_that_have_none(spark, database, dumps, tmp_path):
    table = f"{database}.users"
    ingest(spark, dumps["users"], table, USERS)
    more = write(tmp_path, dump('<row Id="77" />'))
    for _ in range(2):
        assert ingest(spark, more, table, USERS, write_mode="append", batch="it's \\ one") == 1
    rows = held(spark, table)
    assert len(rows) == 7 and (77, "it's \\ one") in rows and sum(b == "" for _, b in rows) == 6
    with pytest.raises(TooFewRows):
        ingest(spark, more, table, USERS, write_mode="append", batch="it's \\ one", min_rows=2)
    with pytest.raises(Exception, match="bad value"):
        ingest(spark, write(tmp_path, dump('<row Id="z" />'), name="bad.xml"), table, USERS, write_mode="append", batch="two")
    with pytest.raises(ValueError):
        ingest(spark, more, table, USERS, batch="three")
    assert held(spark, table) == rows


def test_a_batch_may_be_empty_or_misfit(spark, database):
    table = f"{database}.t"
    append_batch(spark.range(3), table, "a")
    append_batch(spark.range(5), table, "b")
    append_batch(spark.range(0), table, "a")
    assert [tuple(r) for r in spark.table(table).groupBy(BATCH).count().collect()] == [("b", 5)]
    for df, batch in ((spark.range(1), ""), (spark.range(1).selectExpr("string(id) as id"), "c"), (spark.range(1).selectExpr("id", "1 as batch_id"), "c")):
        with pytest.raises(ValueError):
            append_batch(df, table, batch)


BROKEN_FILES = {
    "cut off": ("<users>\n<row Id=\"1\" />\n<row Id=\"2\" Displ", [1], "not one element per line"),
    "no end": ("<users><row Id=\"1\" /><row Id=\"2\" />", [1, 2], "not one complete document"),
    "bad row in the middle": (
        dump('<row Id="1" />', '<row Id="2" <b/>', '<row Id="4" />', '<row Id=5 />', '<row Id="6" Id="6" />', '<row Id="7" />'),
        [1, 4, 7], None,
    ),
    "two roots": ("<users><row Id=\"1\" /></users>\n<users><row Id=\"2\" /></users>", [1, 2], "not one complete document"),
    "no beginning": (" Id=\"0\" /><row Id=\"1\" /></users>", [1], "not one complete document"),
    "no beginning, content": ("><b/></row><row Id=\"1\" /></users>", [1], "not one complete document"),
    "only a tag": ("<users><row", [], "not one element per line"),
    "a tag after the root": ("<users><row Id=\"1\"/></users>\n<row", [1], "not one element per line"),
    "text before the root": ("x <users><row Id=\"1\" /></users>", [1], "not one complete document"),
    "text between rows": ("<users><row Id=\"1\" /> x <row Id=\"2\" /></other>", [1, 2], "not one complete document"),
    "a row without end": ("<users><row Id=\"1\"><row Id=\"2\" /></users>", [2], "not one element per line"),
    "text after the root": ("<users><row Id=\"1\" /></users> more", [1], "not one complete document"),
}


@pytest.mark.parametrize("name", BROKEN_FILES)
def test_broken_files_lose_no_row(spark, tmp_path, name):
    text, ids, reason = BROKEN_FILES[name]
    path = write(tmp_path, text)
    with pytest.raises(Exception, match=reason or "not one|malformed"):
        load_rows(spark, path, USERS, layout="file").count()
    good, refused = split_rejects(load_rows(spark, path, USERS, layout="file", on_bad="quarantine"))
    assert sorted(r["_Id"] for r in good.collect()) == ids
    reasons = {r[REASON] for r in refused.collect()}
    assert reasons and (reason is None or reasons == {reason})


def test_files_of_any_layout(spark, tmp_path):
    text = (
        "\ufeff<?xml version='1.0'?>\n<!-- a > b --><!DOCTYPE users>\n<users kind='x'>\n<row\n Id='1'\n DisplayName='a > b'/>"
        "<row Id=\"2\"></row><row Id=\"3\"><Child>c</Child></row><rowset Id=\"9\"/><!-- end --></users>\n<!-- bye -->\n"
    )
    path = write(tmp_path, text)
    rows = load_rows(spark, path, USERS, layout="file").select("_Id", "_DisplayName").collect()
    assert sorted(map(tuple, rows)) == [(1, "a > b"), (2, None), (3, None)]


def test_a_file_of_any_layout_is_read_by_many_tasks(spark, tmp_path):
    """Cuts of the scan fall anywhere in records that take several lines; good and bad files side by side."""
    rows = [f"<row\n  Id='{i}'\n  DisplayName=\"a > b /> é {i}\"\n/>" if i % 3 else f"<row Id='{i}'>\n<Child x='1'/>\n</row>" for i in range(9_000)]
    write(tmp_path, "<?xml version='1.0'?>\n<!-- one -->\n<users>\n" + "\n".join(rows) + "\n<!-- two --></users>\n", name="good.xml")
    write(tmp_path, "<users>" + "".join(rows[:4_000]) + "<row Id='x' />", name="open.xml")
    write(tmp_path, "".join(rows[:3_000])[9:] + "</users>", name="headless.xml")
    write(tmp_path, "", name="empty.xml")
    settings = {"spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        users = load_rows(spark, f"{tmp_path}/*.xml", USERS, layout="file", on_bad="quarantine")
        assert users.rdd.getNumPartitions() > 20
        good, refused = split_rejects(users)
        assert good.agg(F.count("*"), F.count_distinct("_Id"), F.sum("_Id")).first() == (15_999, 9_000, 40_495_500 + 7_998_000 + 4_498_500)
        found = [(r[FILE].rsplit("/", 1)[1], r[REASON]) for r in refused.collect()]
        assert sorted(found) == [
            ("headless.xml", "not one complete document"), ("open.xml", "bad value: _Id"), ("open.xml", "not one complete document"),
        ]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_long_file_as_a_whole(spark, tmp_path):
    rows = [f'<row Id="{i}" DisplayName="user {i} é" />' for i in range(30_000)]
    path = write(tmp_path, dump(*rows))
    assert load_rows(spark, path, USERS, layout="file").count() == 30_000
    assert load_rows(spark, path, USERS, row_tag="post", layout="file").count() == 0


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("text", ["", "<?xml version='1.0'?>\n<users>\n</users>\n"])
def test_a_dump_without_rows(spark, database, tmp_path, text, layout):
    path = write(tmp_path, text)
    table, refused = f"{database}.users", f"{database}.refused"
    with pytest.raises(TooFewRows):
        ingest(spark, path, table, USERS, layout=layout)
    assert not spark.catalog.tableExists(table)
    assert ingest(
        spark, path, table, USERS, layout=layout, quarantine_table=refused, min_rows=0
    ) == 0
    assert spark.table(table).count() == spark.table(refused).count() == 0


def test_a_folder_of_dumps(spark, database, tmp_path):
    for part in range(3):
        write(tmp_path, dump(f'<row Id="{part}" />'), name=f"Users-{part}.xml")
    assert ingest(spark, f"{tmp_path}/Users-*.xml", f"{database}.users", USERS) == 3
