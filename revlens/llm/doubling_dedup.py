"""Removal of passages that an earlier document holds, by level-wise doubling.

Windows repeated at one length alone are extended to twice that length:

* half length (25 words): of the 26 half windows inside a window, the one with
  the least hash is its anchor, the leftmost of equals.  Equal windows have
  equal anchors, so a window can repeat only where its anchor does, and the
  windows of about 13 places share one.  Anchors that occur in one document
  only are given up.
* whole length (50 words): the windows around the anchors that are left, in
  runs with the same anchor.  Equal runs (copies) are one row before their
  windows are compared; a window that starts in an earlier document removes
  its words.
* twice, four times, ... the length (``follow``): windows that start at an
  anchor, until none starts in several documents.  They give ``longest``, the
  greatest length reached by a document; every word of theirs lies in a window
  of the first length too, so the kept text does not depend on them.

Runs and windows are told apart by 128 bits: 64 over the anchor's words and 64
over their own.

Scale: anchors are two in 27 words; rows that meet at a key are combined
before the shuffle, and keys that hold a thousandth of the rows are looked up
by broadcast (there are at most 1,000), so no common passage and no large
group of copies meets in one task.  Only the windows of anchors with several
different runs are compared one by one.  Texts are shuffled twice by row;
intermediate tables are deleted as soon as the next one is written.

Rows: a document with a NULL id is neither earlier nor later than any (it
keeps all words); rows with equal ids are not earlier than each other;
repetition inside a document removes nothing; NULL and empty texts have no
words; texts of fewer words than a window lose nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import freed, looked_up, stored
from revlens.llm.text import SPACED, _power_tables, hashed_words, mix, utf8

#: Words of a window.
LENGTH = 50
#: Texts are hashed in portions of about this many bytes.
PORTION = 4 << 20


def portions(raws: list[bytes]):
    """Ranges of rows of about PORTION bytes together."""
    begin = size = 0
    for i, raw in enumerate(raws):
        if i > begin and size + len(raw) > PORTION:
            yield begin, i
            begin, size = i, 0
        size += len(raw)
    if begin < len(raws):
        yield begin, len(raws)


class Rolling:
    """Hashes of word ranges of one array of word hashes."""

    def __init__(self, words: np.ndarray):
        self.up, self.down = _power_tables(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * self.up[: len(words)], out=self.sums[1:])

    def of(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, n: int) -> np.ndarray:
        at = np.arange(max(0, len(self.sums) - n))
        return self.of(at, at + n)


def leftmost_least(h: np.ndarray, m: int) -> np.ndarray:
    """Of every m consecutive values the place of the least, the first of equals."""
    place, width = np.arange(len(h)), 1
    while width < m:
        shift = min(width, m - width)
        a, b = place[:-shift], place[shift:]
        place = np.where(h[b] < h[a], b, a)
        width += shift
    return place


def runs(words: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of windows with one anchor in the texts of a portion: row, first
    start, number of windows, anchor's place and hash."""
    half = length // 2
    none = np.zeros(0, dtype=np.int64)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    if not counts.sum():
        return none, none, none, none, none.astype(np.uint64)
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(counts.sum()) + np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    halves = Rolling(words).windows(half)
    anchor = leftmost_least(halves, length - half + 1)[starts]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    n = np.diff(np.concatenate([first, [len(starts)]]))
    return row[first], starts[first], n, anchor[first], halves[anchor[first]]


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """row_id, doc_id, place and hash of every run's anchor."""

    def find(batches):
        for batch in batches:
            raws = utf8(batch.column("text"))
            for a, b in portions(raws):
                words, offsets = hashed_words(raws[a:b], SPACED, lower=False)
                row, _, _, place, h = runs(words, offsets, length)
                at = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_id").take(at), batch.column("doc_id").take(at),
                     pa.array((place - offsets[row]).astype(np.int32)), pa.array(h.view(np.int64))],
                    names=["row_id", "doc_id", "place", "anchor"])

    return docs.where("doc_id IS NOT NULL").mapInArrow(find, "row_id long, doc_id long, place int, anchor long")


def around(docs: DataFrame, length: int) -> DataFrame:
    """The runs of the anchors at ``places``: row_id, doc_id, start, n, the hash
    of the anchor and of the run, those of its windows and those of the windows
    of twice, four times, ... the length at the anchor (longer)."""
    names = ["row_id", "doc_id", "start", "n", "anchor", "run", "windows", "longer"]

    def lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))

    def portion(raws: list[bytes], places: list[list[int]]):
        words, offsets = hashed_words(raws, SPACED, lower=False)
        row, start, n, place, anchor = runs(words, offsets, length)
        wanted = np.concatenate([np.asarray(p, dtype=np.int64) + o for p, o in zip(places, offsets)])
        keep = np.isin(place, wanted)
        row, start, n, place, anchor = row[keep], start[keep], n[keep], place[keep], anchor[keep]
        hashes = Rolling(words)
        each = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        room = offsets[1:][row] - place
        levels = np.zeros(len(row), dtype=np.int64)
        while (more := room >= length << (int(levels.max(initial=0)) + 1)).any():
            levels[more] += 1
        first, longer = np.cumsum(levels) - levels, np.zeros(levels.sum(), dtype=np.uint64)
        for k in range(int(levels.max(initial=0))):
            has = levels > k
            longer[first[has] + k] = hashes.of(place[has], place[has] + (length << (k + 1)))
        return row, [
            pa.array((start - offsets[row]).astype(np.int32)), pa.array(n.astype(np.int32)),
            pa.array(anchor.view(np.int64)), pa.array(hashes.of(start, start + n + length - 1).view(np.int64)),
            lists(hashes.of(each, each + length), n), lists(longer, levels)]

    def find(batches):
        for batch in batches:
            raws, places = utf8(batch.column("text")), batch.column("places").to_pylist()
            for a, b in portions(raws):
                row, columns = portion(raws[a:b], places[a:b])
                at = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_id").take(at), batch.column("doc_id").take(at), *columns], names=names)

    return docs.mapInArrow(find, "row_id long, doc_id long, start int, n int, anchor long, run long, "
                                 "windows array<long>, longer array<long>")


def earlier(found: DataFrame, length: int) -> DataFrame:
    """row_id, start, stop of the words to remove; ``found``: rows of around()."""
    run, window = ["anchor", "run"], ["anchor", "window"]
    distinct = stored(found.groupBy(*run).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("refs"),
        F.first("windows").alias("windows")), "double-runs")
    several = stored(distinct.groupBy("anchor").agg(F.count("*").alias("refs")).where("refs > 1"), "double-several")
    compared = stored(looked_up(distinct.drop("refs", "last"), several, ["anchor"]).drop("refs"), "double-compared")
    windows = compared.select(*run, "first", F.posexplode("windows").alias("at", "window"))
    owners = stored(windows.groupBy(*window).agg(
        F.min("first").alias("owner"), F.max("first").alias("latest"), F.count("*").alias("refs"))
        .where("owner < latest").drop("latest"), "double-owners")
    covered = looked_up(windows, owners, window).where("owner < first").groupBy(*run).agg(
        F.collect_list("at").alias("covered"))
    known = stored(distinct.select(*run, "first", "last", "refs").join(covered, run, "left")
                   .where("first < last OR covered IS NOT NULL").drop("last"), "double-known")
    freed(distinct, several, compared, owners)
    met = looked_up(found.select("row_id", "doc_id", "start", "n", *run), known, run)
    whole = F.col("doc_id") > F.col("first")
    at = F.when(whole, F.array(F.struct(F.col("start").alias("start"), (F.col("start") + F.col("n") + length - 1).alias("stop")))) \
        .otherwise(F.transform("covered", lambda k: F.struct(
            (F.col("start") + k).alias("start"), (F.col("start") + k + length).alias("stop"))))
    spans = met.where(whole | F.col("covered").isNotNull()).select("row_id", F.explode(at).alias("span"))
    spans = stored(spans.select("row_id", "span.*"), "double-spans")
    freed(known)
    return spans


def longest(found: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """row_id and the greatest doubled length at which one of its anchors'
    windows starts in another document too; documents without one are absent."""
    # Only hashes of levels to come are kept.
    rows = stored(found.where("size(longer) > 0").select("row_id", "doc_id", "longer"), "double-level")
    level, reached = 1, []
    while True:
        hashed = rows.where("size(longer) > 0").withColumn("h", F.get("longer", F.lit(0)))
        repeated = stored(hashed.groupBy("h").agg(
            F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("refs"))
            .where("lo < hi").select("h", "refs"), "double-repeated")
        if repeated.isEmpty():
            freed(rows, repeated)
            break
        left = stored(looked_up(hashed, repeated, ["h"]).select(
            "row_id", "doc_id", F.slice("longer", F.lit(2), F.size("longer")).alias("longer")), "double-level")
        freed(rows, repeated)
        rows = left
        reached.append(stored(rows.select("row_id").distinct().withColumn(
            "longest", F.lit(length << level).cast("long")), "double-reached"))
        level += 1
    out = spans.select("row_id", F.lit(length).cast("long").alias("longest"))
    for r in reached:
        out = out.union(r)
    return out.groupBy("row_id").agg(F.max("longest").alias("longest"))


def dedup(docs: DataFrame, length: int = LENGTH, follow: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, the kept text (words joined by
    one space; NULL stays) and longest (0 without repeated windows; at most
    ``length`` if not ``follow``), a row for each row of ``docs``."""
    copy = stored(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                              F.col("text").cast("string").alias("text")), "double-docs")
    places = stored(anchors(copy, length), "double-anchors")
    repeated = stored(places.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("refs"))
        .where("lo < hi").select("anchor", "refs"), "double-half")
    left = looked_up(places, repeated, ["anchor"]).groupBy("row_id").agg(F.collect_list("place").alias("places"))
    found = around(copy.join(left, "row_id"), length)
    found = stored(found if follow else found.drop("longer"), "double-found")
    freed(places, repeated)
    spans = earlier(found, length)
    work = spans.groupBy("row_id").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"),
                                       F.lit(length).cast("long").alias("longest"))
    if follow:
        work = work.drop("longest").join(longest(found, spans, length), "row_id", "full")
    freed(found)

    def cut(batches):
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("starts", "stops"))
            for raw, valid, starts, stops in zip(utf8(batch.column("text")), batch.column("text").is_valid().to_pylist(), *columns):
                words, n = raw.split(), 0
                total = len(words)
                if starts:
                    gone = np.zeros(total + 1, dtype=np.int64)
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, stops, -1)
                    gone = np.cumsum(gone)[:total] > 0
                    n = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words)
                out.append((total, n, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if valid else None))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds)),
                 batch.column("longest")], names=["doc_id", "n_words", "n_removed", "kept_sha256", "text", "longest"])

    joined = copy.join(work, "row_id", "left").select(
        "doc_id", "text", "starts", "stops", F.coalesce("longest", F.lit(0).cast("long")).alias("longest"))
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, text string, longest long")
