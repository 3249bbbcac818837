"""Spark session helpers.

On a cluster the session comes from the platform (``spark-submit`` or a
notebook).  ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces shuffle
# partitions at run time and splits skewed join partitions; session time
# zone is pinned so text dates render the same everywhere.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "revlens") -> SparkSession:
    """A local-mode session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
