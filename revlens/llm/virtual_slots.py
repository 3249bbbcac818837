"""Sharding by fixed virtual slots (native DataFrame code only).

A record's slot is a hash of its id, size and text checksum, one of ``SLOTS``
that never change; so records that share an id (or have none) spread too.  A
small versioned table maps slots to shards.  Version 1 deals the slots out
evenly without looking at the data; a rebalancing aggregates the bytes of
each slot and writes the next version, in which only slots that overfill
their shard have moved.  Records are never hashed again: moving data means
editing the map.

The law that holds is ``bytes``: after the edit the shards' sizes are near
equal.  The size of a record is the UTF-8 length of its text plus 16.

Everything that leaves the distributed tables is bounded by the number of
slots: bytes per slot are pre-aggregated on the map side, and the edit folds
over at most SLOTS rows.  Equal rows share a slot.  NULL text counts as
empty.  Every input row gives one output row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import bucket_of

SLOTS = 16_384
SHARDS = 40
#: Bytes that a record takes besides its text.
OVERHEAD = 16

MAP_SCHEMA = "version int, virtual_slot int, shard int"


def with_slot(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every record."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size, checksum = (F.octet_length(raw) + F.lit(OVERHEAD)).cast("long"), F.crc32(raw)
    record = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), size.cast("string"), checksum.cast("string"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        checksum.alias("text_crc32"),
        bucket_of(record, slots).alias("virtual_slot"),
    )


def initial_map(spark: SparkSession, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Version 1: slots dealt out in turn."""
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        (F.col("id") % shards).cast("int").alias("shard"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes and records of every slot in use; at most SLOTS rows."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


def _assign(spilled: Column, loads: Column) -> Column:
    """Each spilled slot, largest first, goes to the shard with least bytes."""

    def place(state: Column, item: Column) -> Column:
        lightest = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        return F.struct(
            F.transform(state["loads"], lambda x, i: x + F.when(i + 1 == lightest, item["bytes"]).otherwise(0)
                        ).alias("loads"),
            F.concat(state["owners"], F.array(F.struct(item["virtual_slot"].alias("virtual_slot"),
                                                       (lightest - 1).alias("shard")))).alias("owners"))

    start = F.struct(loads.alias("loads"),
                     F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("owners"))
    return F.aggregate(spilled, start, place, lambda s: s["owners"])


def rebalance(current: DataFrame, sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of the map.

    Every shard keeps its largest slots as long as they fit under the mean
    size of a shard; the rest, its smallest slots, are placed anew, each on
    the shard that has least.  Slots without records stay where they are.
    """
    known = current.join(sizes, "virtual_slot", "left").select(
        "version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"))
    # Both windows run over at most one row per slot.
    whole = known.withColumn("mean", F.sum("bytes").over(Window.partitionBy("version")) / shards)
    order = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    whole = whole.withColumn("stays", (F.sum("bytes").over(order) <= F.col("mean")) | (F.col("bytes") == 0))
    folded = whole.agg(
        F.max("version").alias("version"),
        F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct(
            (-F.col("bytes")).alias("negative"), "virtual_slot", "bytes")))).alias("spilled"),
        F.array(*(F.coalesce(F.sum(F.when((F.col("shard") == s) & F.col("stays"), F.col("bytes"))),
                             F.lit(0).cast("long")) for s in range(shards))).alias("loads"))
    moved = folded.select(F.explode(_assign(F.col("spilled"), F.col("loads"))).alias("m")).select("m.*")
    return whole.join(moved.withColumnRenamed("shard", "new_shard"), "virtual_slot", "left").select(
        (F.col("version") + 1).alias("version"), "virtual_slot",
        F.coalesce("new_shard", "shard").alias("shard"))


def assign(rows: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """Shard of every record and its gapless place there.

    Places are numbered within each virtual slot, in thousands of tasks, and
    start after the records of the shard's earlier slots; the start comes
    from the per-slot counts, at most SLOTS rows.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(sizes, "virtual_slot").select(
        "version", "virtual_slot", "shard",
        F.coalesce(F.sum("records").over(before), F.lit(0)).cast("long").alias("start"))
    place = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    # Bounded by the number of slots, whatever the size of the input.
    return rows.withColumn("place", F.row_number().over(place) - 1).join(
        F.broadcast(starts), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"))


def write_map(slot_map: DataFrame, path: str) -> None:
    """Store one version of the map; each version is a folder of its own and
    is never changed afterwards."""
    version = slot_map.select(F.max("version")).first()[0]
    slot_map.select("virtual_slot", "shard").coalesce(1).write.parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the newest if none is named."""
    every = spark.read.parquet(path).select(F.col("version").cast("int").alias("version"), "virtual_slot", "shard")
    if version is None:
        version = every.select(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def shard_documents(docs: DataFrame, map_path: str, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Write versions 1 and 2 of the map below ``map_path`` and place every
    record by the newest version."""
    spark = docs.sparkSession
    rows = with_slot(docs, slots)
    sizes = slot_bytes(rows)
    write_map(initial_map(spark, slots, shards), map_path)
    write_map(rebalance(read_map(spark, map_path), sizes, shards), map_path)
    return assign(rows, read_map(spark, map_path), sizes)
