"""Session settings shared by batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. AQE measures shuffle sizes at run
# time: it merges small partitions, splits skewed join partitions and turns a join into a
# broadcast only when the measured side is below the threshold.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession, tz: str = "UTC") -> SparkSession:
    """Apply the settings every job relies on; the caller's sizing is left alone.

    ``tz`` is the zone in which days and hours are cut.
    """
    for name, value in {**RUNTIME_SETTINGS, **STREAM_SETTINGS, "spark.sql.session.timeZone": tz}.items():
        spark.conf.set(name, value)
    return spark
