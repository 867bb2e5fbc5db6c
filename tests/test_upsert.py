import logging
import shutil
import threading
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postmill.operators import merge_rows
from postmill.sinks import upsert, upsert_table, write_table
from postmill.sinks.tables import details, recover_table

SCHEMA = "id long, part string, v long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, table):
    rows = spark.table(table).select("id", "part", "v").collect()
    return sorted(map(tuple, rows), key=repr)


def tables(spark, database):
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def folder(spark, table):
    return Path(unquote(urlparse(details(spark, table)["Location"]).path))


OLD = [(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, "c", 40)]
SENT = [(2, "a", 21), (3, "b", 31), (5, "d", 51)]
MERGED = [(1, "a", 10), (2, "a", 21), (3, "b", 31), (4, "c", 40), (5, "d", 51)]


@pytest.mark.parametrize("partition_by", [(), ("part",), ("part", "v")])
def test_update_insert_and_keep(spark, database, partition_by):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id", partition_by=partition_by)
    assert stored(spark, table) == sorted(OLD, key=repr)
    for _ in range(2):
        upsert_table(frame(spark, SENT), table, "id")
        assert stored(spark, table) == sorted(MERGED, key=repr)
        assert tables(spark, database) == ["t"]
    assert upsert.partition_columns(spark, table) == list(partition_by)


def test_full_refresh(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id")
    upsert_table(frame(spark, SENT).drop("part"), table, "id", full_refresh=True)
    assert spark.table(table).columns == ["id", "v"] and spark.table(table).count() == 3


def test_a_row_may_change_partition(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id", partition_by=["part"])
    upsert_table(frame(spark, [(4, "a", 41), (3, None, 31)]), table, "id")
    want = [(1, "a", 10), (2, "a", 20), (3, None, 31), (4, "a", 41)]
    assert stored(spark, table) == sorted(want, key=repr)
    upsert_table(frame(spark, [(3, "a", 32)]), table, "id")
    assert (3, "a", 32) in stored(spark, table) and len(stored(spark, table)) == 4


def test_only_touched_partitions_are_written(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id", partition_by=["part"])

    def files():
        at = spark.table(table).selectExpr("part", "_metadata.file_path f").distinct()
        return {r["part"]: r["f"] for r in at.collect()}

    before = files()
    upsert_table(frame(spark, [(2, "a", 22), (6, "b", 60)]), table, "id")
    after = files()
    assert after["c"] == before["c"]
    assert after["a"] != before["a"] and after["b"] != before["b"]
    assert len(stored(spark, table)) == 5


def test_columns_may_come_in_another_order(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id")
    upsert_table(frame(spark, SENT).select("v", "part", "id"), table, "id")
    assert stored(spark, table) == sorted(MERGED, key=repr)


def test_a_source_that_reads_the_target(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id")
    doubled = spark.table(table).selectExpr("id", "part", "v * 2 AS v")
    upsert_table(doubled, table, "id")
    assert [r[2] for r in stored(spark, table)] == [20, 40, 60, 80]


@pytest.mark.parametrize(
    "rows, message",
    [
        ([(1, "a", 1), (1, "a", 2)], "1 duplicate keys and 0 NULL keys"),
        ([(None, "a", 1), (None, "b", 1)], "0 duplicate keys and 2 NULL keys"),
    ],
)
def test_ambiguous_keys_are_refused(spark, database, rows, message):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id")
    with pytest.raises(ValueError, match=message):
        upsert_table(frame(spark, rows), table, "id")
    assert stored(spark, table) == sorted(OLD, key=repr)
    assert tables(spark, database) == ["t"]


def test_other_columns_are_refused(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id")
    with pytest.raises(ValueError, match="columns differ"):
        upsert_table(frame(spark, SENT).drop("v"), table, "id")


def test_an_empty_source_changes_nothing(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id")
    upsert_table(frame(spark, []), table, "id")
    assert stored(spark, table) == sorted(OLD, key=repr)


def test_several_keys(spark, database):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, ["id", "part"])
    upsert_table(frame(spark, [(1, "a", 11), (1, "b", 12)]), table, ["id", "part"])
    want = [(1, "a", 11), (1, "b", 12), *OLD[1:]]
    assert stored(spark, table) == sorted(want, key=repr)


keyed = st.dictionaries(
    st.integers(0, 6), st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 9)), max_size=6
)


def as_rows(values):
    return [(k, p, v) for k, (p, v) in values.items()]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, keyed)
def test_merge_is_a_dictionary_update(spark, old, sent):
    target, source = frame(spark, as_rows(old)), frame(spark, as_rows(sent))
    once = merge_rows(target, source, ["id"])
    assert sorted(map(tuple, once.collect())
                  , key=repr) == sorted(as_rows({**old, **sent}), key=repr)
    twice = merge_rows(once, source, ["id"])
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(
        map(tuple, once.collect()), key=repr
    )


def test_merge_updates_every_row_of_a_key(spark):
    target = frame(spark, [(1, "a", 1), (1, "b", 2), (None, "c", 3), (2, "d", 4)])
    merged = merge_rows(target, frame(spark, [(1, "z", 9), (3, None, None)]), ["id"])
    want = [(1, "z", 9), (1, "z", 9), (None, "c", 3), (2, "d", 4), (3, None, None)]
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("full_refresh", [False, True])
def test_keys_are_checked_on_every_write(spark, database, full_refresh):
    table = f"{database}.t"
    if full_refresh:
        upsert_table(frame(spark, OLD), table, "id")
    with pytest.raises(ValueError, match="1 duplicate keys and 1 NULL keys"):
        upsert_table(frame(spark, [(1, "a", 1), (1, "a", 2), (None, "b", 3)]), table, "id", full_refresh)
    assert tables(spark, database) == (["t"] if full_refresh else [])


def test_an_upsert_that_died_while_putting_partitions_is_finished(spark, database, monkeypatch):
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id", partition_by=["part"])

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_put_partitions", dies)
        with pytest.raises(KeyboardInterrupt):
            upsert_table(frame(spark, [(2, "a", 22), (6, "b", 60)]), table, "id")
    shutil.rmtree(folder(spark, table) / "part=a")  # as a commit cut short may
    spark.catalog.refreshTable(table)
    upsert_table(frame(spark, []), table, "id")
    want = [(1, "a", 10), (2, "a", 22), (3, "b", 30), (4, "c", 40), (6, "b", 60)]
    assert stored(spark, table) == want and tables(spark, database) == ["t"]


def cut_short(spark, table, monkeypatch, sent, done=()):
    """An upsert whose driver dies when its rewrite is stored, or after it has replaced ``done`` partitions."""
    real = upsert._put_partitions

    def dies(spark, table, rewrite):
        if done:
            spark.table(rewrite).where(upsert.F.col("part").isin(*done)).write.saveAsTable(rewrite + "some")
            real(spark, table, rewrite + "some")
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_put_partitions", dies)
        with pytest.raises(KeyboardInterrupt):
            upsert_table(frame(spark, sent), table, "id")


ODD = "a b/%é'=:"  # a partition value whose folder is named otherwise


@pytest.mark.parametrize("done", [(), ("a",), ("a", ODD)])
def test_partitions_replaced_before_the_driver_died_are_known(spark, database, monkeypatch, done):
    table = f"{database}.t"
    upsert_table(frame(spark, [*OLD, (9, ODD, 1)]), table, "id", partition_by=["part"])
    cut_short(spark, table, monkeypatch, [(2, "a", 22), (9, ODD, 2), (6, "b", 60)], done)
    upsert_table(frame(spark, [(4, "c", 41)]), table, "id")
    want = [(1, "a", 10), (2, "a", 22), (3, "b", 30), (4, "c", 41), (6, "b", 60), (9, ODD, 2)]
    assert stored(spark, table) == want and tables(spark, database) == ["t"]


def overwritten(spark, table):
    write_table(frame(spark, [(1, "a", 0), (9, "a", 9), (2, "b", 0)]), table, partition_by=["part"])


def appended(spark, table):
    write_table(frame(spark, [(7, "a", 70)]), table, "append", partition_by=["part"])


def appended_elsewhere(spark, table):
    write_table(frame(spark, [(7, "z", 70)]), table, "append", partition_by=["part"])


def other_columns(spark, table):
    write_table(frame(spark, OLD).withColumn("w", upsert.F.lit(1)), table, partition_by=["part"])


@pytest.mark.parametrize("change", [overwritten, appended, appended_elsewhere, other_columns])
@pytest.mark.parametrize("done", [(), ("a",)])
def test_a_stale_rewrite_is_never_replayed(spark, database, monkeypatch, caplog, change, done):
    """What was written after an upsert died stays; the rewrite was made from another table."""
    table = f"{database}.t"
    upsert_table(frame(spark, OLD), table, "id", partition_by=["part"])
    cut_short(spark, table, monkeypatch, [(1, "a", 11), (2, "a", 22)], done)
    change(spark, table)
    before = sorted(spark.table(table).collect())
    with caplog.at_level(logging.WARNING):
        upsert_table(frame(spark, [(2, "b", 23)]).select("id", "part", "v", *[upsert.F.lit(2).alias(c) for c in spark.table(table).columns if c == "w"]), table, "id")
    assert "the rewrite is dropped" in caplog.text
    assert sorted(r for r in spark.table(table).collect() if r["id"] != 2) == [r for r in before if r["id"] != 2]
    assert [(r["part"], r["v"]) for r in spark.table(table).collect() if r["id"] == 2] == [("b", 23)]
    assert tables(spark, database) == ["t"]


def test_a_rewrite_without_its_table_or_journal_is_dropped(spark, database):
    table = f"{database}.t"
    for suffix in ("__rewrite_1", "__journal_2"):
        frame(spark, SENT).write.saveAsTable(table + suffix)
    upsert_table(frame(spark, OLD), table, "id", partition_by=["part"])
    assert stored(spark, table) == sorted(OLD, key=repr) and tables(spark, database) == ["t"]


def test_upserts_from_two_threads_leave_the_session_alone(spark, database):
    from concurrent.futures import ThreadPoolExecutor

    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    names = [f"{database}.t{k}" for k in range(2)]
    for name in names:
        upsert_table(frame(spark, OLD), name, "id", partition_by=["part"])
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda name: upsert_table(frame(spark, SENT), name, "id"), names))
    assert all(stored(spark, name) == sorted(MERGED, key=repr) for name in names)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


# --- table writes ---------------------------------------------------------------------


def test_overwrite_replaces_the_schema(spark, database):
    table = f"{database}.t"
    write_table(frame(spark, OLD), table)
    write_table(spark.range(3), table)
    assert spark.table(table).columns == ["id"] and tables(spark, database) == ["t"]


def versions(spark, table):
    at = folder(spark, table).parent
    return {p.name: sorted(f.name for f in p.rglob("part-*.parquet")) for p in at.iterdir()}


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_readers_never_miss_a_table_that_is_overwritten(spark, database, partition_by):
    """Each read sees one overwrite whole; files are neither renamed nor copied."""
    table = f"{database}.t"
    write_table(spark.range(40).selectExpr("id", "string(id % 3) as part", "0L as v"), table, partition_by=partition_by)
    seen, failed, over = [], [], threading.Event()

    def read():
        while not over.is_set():
            try:
                seen.append(spark.table(table).selectExpr("count(*) n", "min(v) a", "max(v) b").first())
            except Exception as e:
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 11):
            written = []
            write_table(
                spark.range(40).selectExpr("id", "string(id % 3) as part", f"{k}L as v"), table, partition_by=partition_by,
                before_swap=lambda staging: written.extend(spark.table(staging).inputFiles()),  # noqa: B023
            )
            assert sorted(spark.table(table).inputFiles()) == sorted(written)
            assert len(versions(spark, table)) == 2
    finally:
        over.set()
        reader.join()
    assert failed == [] and len(seen) > 3
    assert all(r["n"] == 40 and r["a"] == r["b"] for r in seen)
    assert [r["a"] for r in seen] == sorted(r["a"] for r in seen)
    assert details(spark, table)["Type"] == "MANAGED" and tables(spark, database) == ["t"]


def test_an_overwrite_that_fails_leaves_no_version(spark, database):
    table = f"{database}.t"
    write_table(frame(spark, OLD), table)
    before = versions(spark, table)

    def refuse(staging):
        raise ValueError("no")

    with pytest.raises(ValueError):
        write_table(frame(spark, SENT), table, before_swap=refuse)
    with pytest.raises(Exception, match="boom"):
        write_table(frame(spark, SENT).selectExpr("id", "part", "if(id > 4, bigint(raise_error('boom')), v) as v"), table)
    assert versions(spark, table) == before and stored(spark, table) == sorted(OLD, key=repr)


def test_a_table_written_by_others_is_taken_over(spark, database):
    for name, partition_by in (("plain", ()), ("parted", ("part",))):
        table = f"{database}.{name}"
        frame(spark, OLD).write.partitionBy(*partition_by).saveAsTable(table)
        for _ in range(2):
            upsert_table(frame(spark, SENT), table, "id")
            assert stored(spark, table) == sorted(MERGED, key=repr)
        write_table(frame(spark, OLD), table, partition_by=partition_by)
        assert stored(spark, table) == sorted(OLD, key=repr)


def test_a_publication_cut_short_is_completed(spark, database, monkeypatch):
    """The driver dies between the two steps of an overwrite that changes the columns."""
    table = f"{database}.t"
    write_table(frame(spark, OLD), table)
    real = type(spark).sql

    def dies(self, query, *args, **kwargs):
        if query.startswith(f"CREATE TABLE {table} LIKE"):
            raise KeyboardInterrupt
        return real(self, query, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", dies)
        with pytest.raises(KeyboardInterrupt):
            write_table(spark.range(3), table)
    assert not spark.catalog.tableExists(table)
    recover_table(spark, table)
    assert spark.table(table).count() == 3 and tables(spark, database) == ["t"]


def test_a_dropped_table_stays_dropped(spark, database):
    table = f"{database}.t"
    write_table(frame(spark, OLD), table)
    write_table(frame(spark, MERGED), table)
    spark.sql(f"DROP TABLE {table}")
    upsert_table(frame(spark, SENT), table, "id")
    assert stored(spark, table) == sorted(SENT, key=repr)


def test_append_and_unknown_mode(spark, database):
    table = f"{database}.t"
    write_table(frame(spark, OLD), table, "append")
    write_table(frame(spark, OLD), table, "append")
    assert spark.table(table).count() == 8
    with pytest.raises(ValueError):
        write_table(frame(spark, OLD), table, "ignore")


def test_a_run_that_died_during_its_swap_is_put_right(spark, database):
    table = f"{database}.t"
    frame(spark, OLD).write.saveAsTable(table + "__previous_1")
    recover_table(spark, table)
    assert stored(spark, table) == sorted(OLD, key=repr) and tables(spark, database) == ["t"]
    frame(spark, SENT).write.saveAsTable(table + "__previous_2")
    write_table(frame(spark, MERGED), table)
    assert stored(spark, table) == sorted(MERGED, key=repr) and tables(spark, database) == ["t"]
