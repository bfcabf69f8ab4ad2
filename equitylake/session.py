"""A session with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(name: str = "equitylake", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


BATCH_BYTES = 4_000_000
BATCH_ROWS = 2048


def narrow_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``, as texts can
    be long. A plan reads these settings when it runs, after the operator has returned it,
    so they stay in the session; smaller ones are left alone."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        try:
            now = int(spark.conf.get(key))
        except ValueError:  # a size with a unit
            now = 0
        if not 0 < now <= most:
            spark.conf.set(key, str(most))
