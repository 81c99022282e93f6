"""Session settings shared by the bench, the tests and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on and a UTC clock.

    On a cluster leave ``master`` unset and let the submit command decide; keyword settings use
    ``__`` for dots (``spark__driver__memory="8g"``).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
