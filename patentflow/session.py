"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession


def build_session(name: str = "patentflow", **settings: str) -> SparkSession:
    """Get or create a session; adaptive execution sizes shuffles and splits skewed partitions."""
    builder = SparkSession.builder.appName(name)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.minPartitionNum": "64",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
