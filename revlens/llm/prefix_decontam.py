"""Benchmark decontamination by a prefix-filtered set join with exact
verification over item-sized windows.

A benchmark item gives windows of WINDOW consecutive words (all its words, if
it has fewer).  A window is the set of its shingles of SHINGLE words, and a
document contains the window only if it holds all of them, so one necessary
prefix token per window is enough: its rarest shingle, by counts over all
documents.  Documents are joined on those tokens alone.  A match at a known
offset fixes where the window must start, and the candidate is kept only if
that start and the window's length lie inside a stretch of document words all
of whose shingles occur in the benchmark (positional and length bounds).
Then the words themselves are compared.

Documents are read once.  A bitmap of fixed size over the benchmark's shingle
hashes tells each task which stretches of words can matter; only those
stretches leave the scan.  If the benchmark is large the bitmap lets more
through, and the joins, whose sides are never hinted, do the rest.  A passage
in a third of all documents gives hot shingles only on the document side of
the join, which adaptive execution splits or replaces by a broadcast of a side
that it has measured.

Words: ASCII letters (lower-cased), digits and non-ASCII characters.  NULL or
empty texts have no words and no hits.  Repeated document rows each get their
own result row; equal windows of several items count for each item; items
without words never match.  An item with a NULL id hits words like any other,
but has no id to list or to count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import bitmap, in_bitmap, stored
from revlens.llm.text import _LOWER, ALNUM, hashed_words, shingles, spans, utf8

WINDOW = 10
SHINGLE = 5
#: log2 of the bits of the bitmap over shingle hashes (2 MB).
BITMAP_BITS = 24

WINDOW_SCHEMA = "item_id string, words array<string>, hashes array<long>"
STRETCH_SCHEMA = ("row_id long, doc_id long, n_words long, "
                  "stretches array<struct<start:long,size:int,words:array<string>,hashes:array<long>>>")


def _words(raw: bytes) -> list[str]:
    buf = _LOWER[np.frombuffer(raw, np.uint8)]
    low = buf.tobytes()
    return [low[a:b].decode("utf-8", "replace") for a, b in zip(*(x.tolist() for x in spans(buf, ALNUM)))]


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Windows of every item with the hashes of their shingles, in order."""

    def run(batches):
        for batch in batches:
            rows = []
            texts = utf8(batch.column("text"))
            hashes, at = hashed_words(texts, ALNUM, lower=True)
            for i, (item, raw) in enumerate(zip(batch.column("item_id").to_pylist(), texts)):
                words = _words(raw)
                size = min(shingle, len(words))
                grams = shingles(hashes[at[i]: at[i + 1]], shingle).view(np.int64)
                n = min(window, len(words))
                for start in range(len(words) - n + 1 if words else 0):
                    rows.append((item, words[start: start + n], grams[start: start + n - size + 1].tolist()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.string())),
                pa.array(columns[2], pa.list_(pa.int64()))], names=["item_id", "words", "hashes"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return items.mapInArrow(run, WINDOW_SCHEMA)


def stretches(docs: DataFrame, known: np.ndarray, least: dict[int, int]) -> DataFrame:
    """One row per document with the stretches of words whose shingles may
    all occur in the benchmark.  ``least`` gives, for each shingle size in
    use, the least number of shingles of a window."""
    held = docs.sparkSession.sparkContext.broadcast(known)
    names = ["row_id", "doc_id", "n_words", "stretches"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int32()), ("words", pa.list_(pa.string())),
                               ("hashes", pa.list_(pa.int64()))]))

    def run(batches):
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        for batch in batches:
            texts = utf8(batch.column("text"))
            hashes, at = hashed_words(texts, ALNUM, lower=True)
            # All shingles of the batch at once; those across texts are not used.
            grams = {size: shingles(hashes, size) for size in least if len(hashes) >= size}
            hits = {size: in_bitmap(held.value, g) for size, g in grams.items()}
            found = []
            for i, raw in enumerate(texts):
                mine, words = [], None
                for size, hit in hits.items():
                    a, b = at[i], at[i + 1] - size + 1
                    if b <= a or not (part := hit[a:b]).any():
                        continue
                    edge = np.diff(np.concatenate([[0], part.astype(np.int8), [0]]))
                    for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                        if e - s < least[size]:
                            continue
                        words = words or _words(raw)
                        mine.append({"start": s, "size": size, "words": words[s: e + size - 1],
                                     "hashes": grams[size][a + s: a + e].view(np.int64).tolist()})
                found.append(mine)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + len(texts))), batch.column("doc_id").cast(pa.int64()),
                pa.array(np.diff(at)), pa.array(found, kind)], names=names)
            row += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STRETCH_SCHEMA)


def matches(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(row_id, start, length, item_id) of every occurrence of a window."""
    grams = found.select("row_id", F.explode("stretches").alias("s")).select(
        "row_id", "s.start", "s.words", F.posexplode("s.hashes").alias("at", "hash"))
    counts = grams.groupBy("hash").agg(F.count("*").alias("rarity"))
    # Equal windows are matched once, whatever number of items has them.
    distinct = windows.groupBy("words").agg(F.first("hashes").alias("hashes"), F.collect_set("item_id").alias("items"))
    prefix = (distinct.select("words", "items", F.size("hashes").alias("n"), F.posexplode("hashes").alias("offset", "hash"))
              .join(counts, "hash")
              .groupBy("words").agg(F.first("items").alias("items"), F.first("n").alias("n"), F.count("*").alias("known"),
                                    F.min(F.struct("rarity", "hash", "offset")).alias("token"))
              # A shingle that no document has: the window occurs nowhere.
              .where("known = n")
              .select(F.col("words").alias("window"), "items", "token.hash", "token.offset"))
    begin, n = F.col("at") - F.col("offset"), F.size("window")
    return (grams.join(prefix, "hash")
            .where((begin >= 0) & (begin + n <= F.size("words")))
            .where(F.slice("words", F.greatest(begin, F.lit(0)) + 1, n) == F.col("window"))
            .select("row_id", (F.col("start") + begin).alias("start"), n.alias("length"),
                    F.explode_outer("items").alias("item_id")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document row: row_id, doc_id, n_words, n_hit, spans (merged hit
    stretches, word positions, end exclusive) and items (sorted ids)."""
    windows = stored(item_windows(benchmark, window, shingle), "windows")
    # At most ``shingle`` rows.
    least = {r["size"]: r["least"] for r in windows.select(
        F.least(F.size("words"), F.lit(shingle)).alias("size"), F.size("hashes").alias("n")).groupBy("size").agg(
        F.min("n").alias("least")).collect()}
    known = bitmap(windows.select(F.explode("hashes").alias("hash")), BITMAP_BITS)
    found = stored(stretches(docs, known, least), "stretches")
    spots = matches(found, windows)
    # Hit words as merged spans: a span starts where no earlier match reaches.
    reach = F.max("stop").over(Window.partitionBy("row_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    ends = spots.groupBy("row_id", "start").agg(F.max(F.col("start") + F.col("length")).alias("stop"))
    runs = ends.withColumn("reach", reach).withColumn(
        "run", F.sum((F.col("reach").isNull() | (F.col("start") > F.col("reach"))).cast("int")).over(
            Window.partitionBy("row_id").orderBy("start")))
    merged = runs.groupBy("row_id", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    hit = merged.groupBy("row_id").agg(
        F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    items = spots.groupBy("row_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<string>")
    return found.select("row_id", "doc_id", "n_words").join(hit, "row_id", "left").join(items, "row_id", "left").select(
        "row_id", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "spans",
        F.coalesce("items", none).alias("items"))
