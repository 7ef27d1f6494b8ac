"""Session settings that the operators rely on, and table access."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "bitloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; existing settings of a cluster are left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
