"""One Spark session for every job, always in UTC.

The dump stores naive timestamps that mean UTC. Read in another session time
zone they would move by that zone's offset, so the zone is pinned here, on a
session built by us and on one handed to us alike.
"""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

logger = logging.getLogger(__name__)

TIMEZONE_CONF = "spark.sql.session.timeZone"
TIMEZONE = "UTC"

# Plan-time defaults for a session we build. A session we are handed keeps its own.
# The initial number of shuffle partitions is left to the cluster: AQE only ever
# lowers it, so size it from the data (see the README) and let AQE coalesce.
DEFAULTS = {
    TIMEZONE_CONF: TIMEZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Set the session time zone to UTC; say so when that changes a shared session."""
    current = spark.conf.get(TIMEZONE_CONF, None)
    if current != TIMEZONE:
        logger.warning("session time zone changed from %s to %s", current, TIMEZONE)
        spark.conf.set(TIMEZONE_CONF, TIMEZONE)
    return spark


def get_spark(
    app_name: str = "postmill",
    warehouse_dir: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session pinned to UTC, or build one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return pin_utc(active)
    settings = {**DEFAULTS, **(conf or {})}
    if warehouse_dir is not None:
        settings["spark.sql.warehouse.dir"] = warehouse_dir
    return pin_utc(SparkSession.builder.appName(app_name).config(map=settings).getOrCreate())
