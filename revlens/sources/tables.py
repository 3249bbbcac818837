"""Named Parquet tables (the ``data_dict[name]`` of the reference).

Tables are read lazily; Catalyst prunes columns and pushes filters into the
Parquet scan, so callers just ``select``/``where`` what they need.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan a table, keeping ``columns`` only.  Its splits are those of the
    files (``spark.sql.files.maxPartitionBytes``, row-group size)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns is None:
        return df
    return df.select(*columns)


def register_tables(spark: SparkSession, sf_dir: str, names=TEST_TABLES) -> None:
    """Register each table as a temp view so SQL text can use it."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
