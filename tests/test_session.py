import logging

from postmill.session import TIMEZONE_CONF, get_spark, pin_utc


def test_the_active_session_is_reused(spark):
    assert get_spark() is spark or get_spark()._jsparkSession is spark._jsparkSession


def test_another_zone_is_changed_and_reported(spark, caplog):
    spark.conf.set(TIMEZONE_CONF, "America/New_York")
    with caplog.at_level(logging.WARNING):
        get_spark()
    assert spark.conf.get(TIMEZONE_CONF) == "UTC"
    assert "America/New_York" in caplog.text


def test_a_utc_session_is_left_alone(spark, caplog):
    with caplog.at_level(logging.WARNING):
        pin_utc(spark)
    assert caplog.text == ""
