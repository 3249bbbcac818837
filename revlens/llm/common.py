"""Helpers shared by the text operators."""

from __future__ import annotations

import contextlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.sources.scratch import freed, settled, shared_dir, written
from revlens.sources.tables import table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; Catalyst prunes the columns."""
    return spark.read.parquet(table_path(sf_dir, name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared directory and read it back:
    lineage is cut, and the rows survive the loss of executors.  The shuffle
    files of finished steps are freed."""
    out = written(df, name)
    settled(df.sparkSession)
    for made in _watched:
        made.append(out)
    return out


_watched: list[list[DataFrame]] = []


@contextlib.contextmanager
def stored_within():
    """The list of the tables stored inside the block."""
    made: list[DataFrame] = []
    _watched.append(made)
    try:
        yield made
    finally:
        _watched.remove(made)


def parallelism(spark: SparkSession, floor: int = 1) -> int:
    """The session's shuffle partition count."""
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(key: Column, buckets: int, salt: str = "") -> Column:
    """Bucket number of a key by MD5, the same in any engine; NULL is bucket
    0's neighbour like any other value (hashed as an empty text)."""
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


#: A key that holds one in HOT of the rows is looked up by broadcast.
HOT = 1000


def looked_up(rows: DataFrame, found: DataFrame, key: list[str], total: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``found``, which has one row per key and in
    ``refs`` the number of rows with it.  Keys that hold a thousandth of all
    rows are broadcast (there are at most 1,000, whatever the input), so the
    shuffled rest has no hot key.  Both inputs are read twice: give stored
    ones."""
    total = rows.count() if total is None else total
    frequent = F.col("refs") * HOT >= total
    hot = found.where(frequent)
    if hot.isEmpty():
        return rows.join(found, key)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(found.where(~frequent), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def summed_vectors(df: DataFrame, salts: int = 16) -> DataFrame:
    """Sum float64 vectors stored as binary: columns key int, value binary ->
    one row per key.  Two steps, so that no task gets all rows of a key."""
    import numpy as np
    import pandas as pd

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(pdf["value"].iloc[0]) // 8)
        for v in pdf["value"]:
            total += np.frombuffer(v)
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "value": [total.tobytes()]})

    schema = "key int, value binary"
    salted = df.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(salts)))
    return salted.groupBy("key", "salt").applyInPandas(add, schema).groupBy("key").applyInPandas(add, schema)


def bitmap(hashes: DataFrame, bits: int):
    """Bitmap of 2^bits bits over the top bits of a 64-bit column ``hash``, as
    packed bytes.  Its size does not grow with the rows: it is built by a
    grouped bit_or, and at most 2^(bits - 6) rows reach the driver."""
    import numpy as np

    slots = hashes.select(F.shiftrightunsigned("hash", 64 - bits).alias("slot"))
    rows = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows.column("word").to_numpy()] = rows.column("mask").to_numpy()
    return out.view(np.uint8)


def in_bitmap(packed, hashes):
    """Whether the top bits of each unsigned 64-bit hash are set."""
    import numpy as np

    slot = (hashes >> np.uint64(64 - (len(packed) * 8).bit_length() + 1)).astype(np.int64)
    return (packed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


#: A table of at most so many (node, node) rows is sent to the tasks whole.
SENT = 100_000


def sent(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for a broadcast, if that many rows are few enough."""
    return F.broadcast(df) if rows <= SENT else df


def packed(df: DataFrame, rows: int, each: int = 20_000) -> DataFrame:
    """``df``, known to have at most so many rows, in no more parts than hold
    ``each`` of them: a small table is not written as many small files."""
    parts = -(-rows // each) or 1
    return df.coalesce(parts) if parts < parallelism(df.sparkSession) else df


def components(edges: DataFrame, name: str = "edges", most: int = 60) -> DataFrame:
    """Connected components of a graph given as columns a, b (long): node and
    root, the smallest node of its component; nodes without edges are absent.
    Give stored edges: the first round reads them more than once.

    Alternating large-star and small-star steps; each round is written to the
    shared folder, until every node but the roots has one edge, to its root.
    A hub's edges are combined before the shuffle by the grouped minimum; the
    joins back send few minima to the edges, and are else left to adaptive
    skew handling.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    for step in range(most):
        if step:
            # Edges of a node to smaller ones; has it edges from larger ones?
            ends = now.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
                now.select("b", F.lit(0), F.lit(1)))
            inner = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
            if not inner.where("down > 1 OR (down = 1 AND up = 1)").count():
                stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
                return stars.union(now.select("b", "b").distinct())
        edges_now = now.count()
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # At most two nodes an edge.
        large = both.join(sent(low, 2 * edges_now), "a").where("b > a").select(
            F.col("b").alias("a"), F.col("low").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(sent(least, 2 * edges_now), "a")
        now = stored(packed(small.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
                            .union(small.select("a", F.col("low").alias("b"))).distinct(), 4 * edges_now), name)
    raise RuntimeError("components did not settle")
