"""Mixture-controlled packing: every window of a fixed number of tokens holds
the sources in target proportions.

Each source is a queue of documents; a queue's tokens are one long stream.
Deficit round-robin serves the queues: a queue's credit grows by its share of
a window, it is served whole tokens as its credit covers them, and what is
left (the deficit) is carried into the next window.  With credit growing in
proportion to the weight w of a queue, its token x falls due at
(2 x + 1) / (2 w); serving all tokens in due order, ties by queue number, is
that schedule.  The position of the window boundaries in every queue then has
a closed form over the queue lengths alone, so any task can cut its own
documents without knowing what others hold, and the deficits carry across
windows and partitions exactly.  All windows but the last are full.

By default the weights are the queues' own lengths: every window has the
corpus's mixture and all queues end together.  With other weights, a queue
that runs dry leaves its share to the rest.  No token is lost or repeated.

Queues: the OWN_QUEUES sources with most tokens have one each, all others
share HASHED_QUEUES by hash.  The sources of a shared queue are merged by the
same due order over their own lengths, so every source has its share of every
window.  The driver and the tasks hold one number per source.  A NULL source counts as ''.  A document's tokens are its text's ids
(none for a NULL or empty text) and one end id; repeated rows are packed one
by one.  Order within a source: input partition, row.

The text is read and encoded once; the ids are written to the shared folder
with each row's place in its (partition, source) run.  Only the lengths of
these runs are shuffled, so a source with a third of all rows is no hot key.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import bucket_of, stored
from revlens.llm.text import utf8
from revlens.llm.tokens import encoder

CAPACITY = 4096
END_ID = 2
OWN_QUEUES = 64
HASHED_QUEUES = 32

TOKEN_SCHEMA = "doc_id long, source string, part int, run_start long, n_tokens long, ids binary"
PIECE_SCHEMA = ("doc_id long, source string, start long, length long, ids binary, doc_tokens long, "
                "sequence_id long, offset long")


def tokenized(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Ids (16-bit, little-endian) of every document with its place in the
    run of its input partition and source."""
    names = [c.split()[0] for c in TOKEN_SCHEMA.split(", ")]

    def run(batches):
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        encode, end = encoder(vocabulary).encode, np.array([end_id], "<u2").tobytes()
        served: dict[str, int] = {}
        for batch in batches:
            ids = [encode(t) + end for t in utf8(batch.column("text"))]
            sources = [s or "" for s in batch.column("source").to_pylist()]
            starts = []
            for s, x in zip(sources, ids):
                starts.append(served.get(s, 0))
                served[s] = starts[-1] + len(x) // 2
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(sources, pa.string()),
                pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").mapInArrow(
        run, TOKEN_SCHEMA)


class Schedule:
    """Window boundaries of all queues, from their lengths and weights."""

    def __init__(self, lengths: list[int], weights: list[int] | None = None, capacity: int = CAPACITY):
        self.lengths = [int(n) for n in lengths]
        self.weights = [int(w) for w in weights] if weights else list(self.lengths)
        if any(w <= 0 < n for w, n in zip(self.weights, self.lengths)):
            raise ValueError("a queue with tokens needs a positive weight")
        self.capacity, self.total = capacity, sum(self.lengths)
        self._known: dict[int, list[int]] = {}
        # Queues in the order in which they run dry, with the tokens of those
        # before each and the weight of it and those after it.
        self.live = sorted((q for q, x in enumerate(self.lengths) if x),
                           key=lambda q: self._due(q, self.lengths[q] - 1))
        self.dry = [0, *itertools.accumulate(self.lengths[q] for q in self.live)]
        weight = [0, *itertools.accumulate(self.weights[q] for q in self.live)]
        self.left = [weight[-1] - w for w in weight]

    def _due(self, q: int, x: int) -> tuple[int, int]:
        # Fixed point with more digits than two different due times can share.
        return ((2 * x + 1) << 128) // self.weights[q], q

    def served(self, window: int) -> list[int]:
        """Tokens of each queue in all windows before this one."""
        if window not in self._known:
            if len(self._known) > 4096:
                self._known.clear()
            self._known[window] = self._solve(min(window * self.capacity, self.total))
        return self._known[window]

    def _solve(self, n: int) -> list[int]:
        # Queues that are dry at the time when n tokens are due, at unit rate.
        first = 0
        while first < len(self.live) and (self.lengths[self.live[first]] * self.left[first]
                                          < (n - self.dry[first]) * self.weights[self.live[first]]):
            first += 1
        ahead, weight = 2 * (n - self.dry[first]), self.left[first]
        out = list(self.lengths)
        for q in self.live[first:]:
            x = -((weight - ahead * self.weights[q]) // (2 * weight))
            out[q] = 0 if x < 0 else min(x, out[q])
        # The estimate is off by less than a token for each queue.
        short = n - sum(out)
        if not short:
            return out
        step = 1 if short > 0 else -1
        sign = 1 if step > 0 else -1
        heap = []
        for q in self.live:
            x = out[q] if step > 0 else out[q] - 1
            if 0 <= x < self.lengths[q]:
                heap.append((sign * (((2 * x + 1) << 128) // self.weights[q]), sign * q, q, x))
        heapq.heapify(heap)
        for _ in range(abs(short)):
            _, _, q, x = heapq.heappop(heap)
            out[q] += step
            if 0 <= x + step < self.lengths[q]:
                due = self._due(q, x + step)
                heapq.heappush(heap, (sign * due[0], sign * due[1], q, x + step))
        return out

    def before(self, window: int, q: int) -> int:
        """Tokens of the window that stand before those of queue q."""
        now, after = self.served(window), self.served(window + 1)
        return sum(after[:q]) - sum(now[:q])

    def window_of(self, q: int, x: int) -> int:
        """The window that holds token x of queue q."""
        share = self.total * x // max(1, self.lengths[q])
        low, high = 0, -(-self.total // self.capacity)
        guess = min(high - 1, max(0, share // self.capacity))
        if self.served(guess)[q] <= x:
            low = guess
            step = 1
            while low + step < high and self.served(low + step)[q] <= x:
                low, step = low + step, step * 2
            high = min(high, low + step)
        else:
            high, step = guess, 1
            while high - step > 0 and self.served(high - step)[q] > x:
                high, step = high - step, step * 2
            low = max(0, high - step)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.served(mid)[q] <= x else (low, mid)
        return low

    def cut(self, q: int, start: int, length: int):
        """Pieces (from, length, window, offset in the window) of the tokens
        start .. start + length - 1 of queue q."""
        x, end = start, start + length
        window = self.window_of(q, x) if length else 0
        while x < end:
            now, after = self.served(window), self.served(window + 1)
            stop = min(end, after[q])
            if stop > x:
                offset = self.before(window, q) + x - now[q]
                yield x - start, stop - x, window, offset
                x = stop
            window += 1


class Shared(Schedule):
    """The sources that share one queue of ``outer``, merged in due order."""

    def __init__(self, outer: Schedule, queue: int, lengths: list[int]):
        super().__init__(lengths, capacity=outer.capacity)
        self.outer, self.queue, self.total = outer, queue, outer.total

    def served(self, window: int) -> list[int]:
        if window not in self._known:
            if len(self._known) > 256:
                self._known.clear()
            self._known[window] = self._solve(self.outer.served(window)[self.queue])
        return self._known[window]

    def before(self, window: int, q: int) -> int:
        return self.outer.before(window, self.queue) + super().before(window, q)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
         targets: dict[str, int] | None = None) -> DataFrame:
    """One row per piece (PIECE_SCHEMA); ``ids`` are little-endian unsigned
    32-bit integers.  ``targets`` gives weights of sources; all sources must
    then be named.  An empty table gives no rows."""
    tokens = stored(tokenized(docs, vocabulary, end_id), "tokens")
    runs = tokens.groupBy("source", "part").agg(F.sum("n_tokens").alias("tokens"))
    by_source = runs.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    if targets is None:
        # At most OWN_QUEUES rows.
        largest = [r["source"] for r in by_source.orderBy(F.desc("tokens"), "source").limit(OWN_QUEUES).collect()]
    else:
        largest = sorted(targets)
    own = F.create_map(*[x for i, s in enumerate(largest) for x in (F.lit(s), F.lit(i))]) if largest else None
    shared = F.lit(len(largest)) + bucket_of(F.col("source"), HASHED_QUEUES)
    queue = F.coalesce(F.try_element_at(own, F.col("source")), shared) if largest else shared
    # One row per source.
    lengths = [0] * (len(largest) + HASHED_QUEUES)
    members: dict[int, dict[str, int]] = {}
    for r in by_source.withColumn("queue", queue.cast("int")).orderBy("queue", "source").collect():
        lengths[r["queue"]] += r["tokens"]
        if r["queue"] >= len(largest):
            members.setdefault(r["queue"], {})[r["source"]] = r["tokens"]
    held = docs.sparkSession.sparkContext.broadcast(members)
    weights = None if targets is None else [*(targets[s] for s in largest), *[0] * HASHED_QUEUES]
    # One row per input partition and source.
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("source", "part", queue.cast("int").alias("queue"),
                       F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    placed = tokens.join(runs, ["source", "part"]).select(
        "doc_id", "source", "queue", (F.col("base") + F.col("run_start")).alias("start"), "n_tokens", "ids")
    names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]

    def cut(batches):
        schedule = Schedule(lengths, weights, capacity)
        shared = {q: (Shared(schedule, q, list(m.values())), {s: i for i, s in enumerate(m)})
                  for q, m in held.value.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounds what a batch can grow to
                rows = []
                for r in batch.slice(at, 256).to_pylist():
                    ids = np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes()
                    mine, place = shared.get(r["queue"], (schedule, {}))
                    at_queue = place.get(r["source"], r["queue"])
                    for start, n, window, offset in mine.cut(at_queue, r["start"], len(ids) // 4):
                        rows.append((r["doc_id"], r["source"], start, n, ids[4 * start: 4 * (start + n)],
                                     len(ids) // 4, window, offset))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
                columns = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return placed.mapInArrow(cut, PIECE_SCHEMA)
