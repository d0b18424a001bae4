"""Session settings that the library recommends."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings for any size of cluster; memory, cores and the shared folder are the deployment's.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
