"""Token-id output: best-fit-decreasing packing into fixed-length rows.

Documents are encoded, followed by an end id each, and packed into rows of
``capacity`` ids.  A document longer than a row is cut without loss: whole
rows first, and its rest is packed with the others.  Pieces are placed from
the longest to the shortest, each into the open row with the least free room
that still holds it; a segment tree over free room finds that row in
logarithmic time.

Each row comes with its padded ids (one line of the id matrix, unsigned
32-bit little-endian), the cumulative lengths of its segments, and positions
that restart at 0 with every segment.

One pass without a shuffle: each task packs its documents in groups of about
GROUP_TOKENS tokens, so memory is bounded and a lost task is just run again.
The order of rows follows the input's partitions; sequence ids are unique but
not consecutive.  NULL and empty texts give one segment with the end id;
repeated rows are packed one by one; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.text import utf8
from revlens.llm.tokens import encoder

CAPACITY = 2048
END_ID = 2
PAD_ID = 0
#: Tokens that a task packs together.
GROUP_TOKENS = 4 << 20

SCHEMA = ("sequence_id long, n_tokens long, ids binary, cu_seqlens array<int>, positions binary, "
          "doc_ids array<long>, starts array<long>")


class CapacityTree:
    """Multiset of open rows by free room; finds the least room that is
    enough.  ``count[node]`` is the number of open rows below a node."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the least room >= need."""
        node = need + self.leaves
        while not self.count[node]:
            # Climb until a right sibling has an open row.
            while node & 1 or not self.count[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows as lists of item numbers; every length is 1 .. capacity."""
    tree = CapacityTree(capacity)
    rows: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], row)
    return rows


def bfd_pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
             pad_id: int = PAD_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per packed sequence (SCHEMA)."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(),
             pa.list_(pa.int64()), pa.list_(pa.int64())]
    end = np.array([end_id], "<u2").tobytes()

    def rows_of(pieces, first):
        for k, members in enumerate(best_fit_decreasing([len(p[2]) // 2 for p in pieces], capacity)):
            parts = [np.frombuffer(pieces[i][2], "<u2") for i in members]
            sizes = [len(p) for p in parts]
            ids = np.full(capacity, pad_id, "<u4")
            positions = np.zeros(capacity, "<u4")
            at = np.concatenate([[0], np.cumsum(sizes)])
            ids[: at[-1]] = np.concatenate(parts)
            positions[: at[-1]] = np.concatenate([np.arange(n) for n in sizes])
            yield (first + k, int(at[-1]), ids.tobytes(), at.astype(np.int32).tolist(), positions.tobytes(),
                   [pieces[i][0] for i in members], [pieces[i][1] for i in members])

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def pack_group(pieces, first):
        held = []
        for row in rows_of(pieces, first):
            held.append(row)
            if len(held) == 512:
                yield out(held)
                held = []
        if held:
            yield out(held)

    def run(batches):
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 32
        encode = encoder(vocabulary).encode
        pieces, held = [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                ids = encode(raw) + end
                for at in range(0, len(ids), 2 * capacity):
                    pieces.append((doc_id, at // 2, ids[at: at + 2 * capacity]))
                held += len(ids) // 2
                if held >= group_tokens:
                    yield from pack_group(pieces, first)
                    first, pieces, held = first + len(pieces), [], 0
        if pieces:
            yield from pack_group(pieces, first)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the id matrix rows, cumulative lengths and positions as Parquet."""
    packed.write.parquet(path)
