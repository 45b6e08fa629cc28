"""Spark session set-up: an explicit time zone and the adaptive defaults that every plan here relies on."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "heddle", master: str | None = None, time_zone: str = "UTC", **conf: str) -> SparkSession:
    """A session with the defaults above.

    ``time_zone`` is always set: zone-dependent functions must not follow the
    machine. ``conf`` takes further settings, dots written as double underscores.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", time_zone)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_logged(name: str, action, logger: logging.Logger | None = None):
    """Run ``action()``; an exception is written to the log with its trace, then raised again."""
    try:
        return action()
    except Exception:
        (logger or logging.getLogger("heddle")).exception("query %s failed", name)
        raise
