"""Session settings the plans are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # joins start as sort-merge and become broadcast when the measured side is small; hot join partitions are split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not compile larger methods; beyond it Spark generates code per operator, in smaller methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def session_builder(name: str = "risklake") -> SparkSession.Builder:
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
