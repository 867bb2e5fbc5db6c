import pytest

from postmill.__main__ import main, show


def test_ingest_models_reports(spark, database, dumps, capsys):
    gold = database + "_gold"
    try:
        for name in ("posts", "users"):
            main(["ingest", name, dumps[name], f"{database}.{name}"])
        main(["models", f"{database}.posts", f"{database}.users", "--gold-db", gold, "--top-tags", "3"])
        main(["reports", "--gold-db", gold])
        shown = capsys.readouterr().out
        assert f"{database}.posts: 7 rows" in shown and "paula" in shown
        assert spark.table(f"{gold}.marts_top_tags").count() == 3
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {gold} CASCADE")


def test_judge_and_silver(spark, database, dumps, tmp_path):
    seed = tmp_path / "types.csv"
    seed.write_text("post_type_id,post_type\n1,Question\n")
    main(["ingest", "posts", dumps["posts"], f"{database}.posts"])
    main(["judge", f"{database}.posts", f"{database}.valid", f"{database}.refused"])
    main(["silver", f"{database}.posts", f"{database}.stg", "--types", str(seed)])
    assert spark.table(f"{database}.valid").count() == 7
    assert spark.table(f"{database}.stg").where("post_type = 'Unknown'").count() == 3


def test_long_reports_are_shown_whole(spark, capsys):
    show({"years": spark.range(2000, 2030).withColumnRenamed("id", "year")})
    shown = capsys.readouterr().out
    assert all(f"|{year}|" in shown for year in range(2000, 2030))


def test_the_table_needs_a_database(spark, dumps):
    with pytest.raises(SystemExit):
        main(["ingest", "posts", dumps["posts"], "posts"])


def test_a_batch_that_is_sent_again(spark, database, dumps):
    for _ in range(2):
        main(["ingest", "users", dumps["users"], f"{database}.users", "--write-mode", "append", "--batch", "june"])
    assert spark.table(f"{database}.users").where("batch_id = 'june'").count() == 6


def test_build(spark, database, dumps, capsys):
    main(["build", dumps["posts"], dumps["users"], "--bronze-db", database, "--gold-db", database])
    shown = capsys.readouterr().out
    assert "report_kpis" in shown and f"{database}.users: 6 rows" in shown
