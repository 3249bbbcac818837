"""Reproducible row splits.

``randomSplit`` draws per partition, so the same seed gives different rows
when the input is partitioned differently.  A hash of the row key decides
the side of every row independently of partitioning, executor loss or
re-execution, and the same rule is expressible in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column | str, seed: str) -> Column:
    """0..99 from the first 28 bits of md5(key || '-' || seed)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat_ws("-", k.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 7), 16, 10).cast("bigint") % 100


def hash_split(df: DataFrame, key: str, seed: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """(first, second): rows whose bucket is below ``percent`` and the rest."""
    b = hash_bucket(key, seed)
    return df.where(b < percent), df.where(b >= percent)


def with_split_flag(df: DataFrame, key: str, seed: str, percent: int,
                    name: str = "in_first") -> DataFrame:
    return df.withColumn(name, hash_bucket(key, seed) < percent)
