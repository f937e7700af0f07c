"""A session with the settings that the transformations assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A replayed game makes some ninety rows; smaller batches keep the workers' memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("plycask")
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | settings).getOrCreate()
