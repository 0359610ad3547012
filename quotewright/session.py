"""A SparkSession with the settings these jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window operators keep one instrument's rows in memory; the stock value of
    # 4096 would spill any history longer than about 16 years of trading days.
    "spark.sql.windowExec.buffer.in.memory.threshold": "32768",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "quotewright", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
