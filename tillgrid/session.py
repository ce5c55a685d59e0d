"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Days are taken in UTC; AQE coalesces, splits skewed partitions and turns a
# shuffled join into a broadcast one when a side proves small at run time. Items
# are filtered by the shipments in the order range before they are added up: a
# filter of up to 40 million keys, where the items are 1 GB or more.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "400000000",
}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings above, overridden by ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
