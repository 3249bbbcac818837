"""Removal of repeated byte strings by suffix order: threshold-bounded interval
expansion on a Burrows-Wheeler transform.

Every byte covered by a LENGTH-byte string that also starts earlier (smaller
doc_id, or earlier in the same document; rows that share an id in row order)
is removed.  Strings are judged on the input, overlaps count, and matches
never cross documents.

*Distribution.*  Each LENGTH-byte string has an anchor: the position in it
whose GRAM-byte hash is least (the first such).  Equal strings have the same
anchor hash at the same place, so all occurrences of a string meet where their
anchor's hash is sent.  A first pass finds the anchor hashes that occur in two
places (in different texts or at different positions); a bitmap of fixed size
over them picks, in a second pass, the segments to send: the bytes of all
strings of one anchor, about 130 bytes each.

*Index.*  A task keeps one copy of the equal segments of an anchor, with their
owners.  (An anchor left with a single segment needs no index: its strings
have their anchor at different places, so no two are equal, and strings with
other anchors differ from them.)  Other segments are taken in chunks of whole
anchors, and the task builds the chunk's suffix order (by doubling) and its
Burrows-Wheeler transform, with a separate end mark for every segment.  Starting from the intervals of single bytes, one round of
backward extension splits all intervals of depth d into those of depth d + 1,
so common-prefix lengths come out in increasing order; it stops at LENGTH.
Neighbours that no round has split share LENGTH bytes or more: every interval
left is one repeated string, and all its occurrences but the earliest are
marked.

*Large groups.*  A passage in very many documents, each time among other words,
gives an anchor many different segments.  Such a group is split by the place of
the anchor in the strings: all strings that have it in a range of places
contain the same bytes around it (the core of the range), so only those with
equal cores can be equal.  Halves of the range are grouped by core, equal pieces
become one, and groups that are still large are halved again; a range of one
place has the whole string as its core.  So the index never holds much more
than CHUNK bytes, whatever the group.

*Copies.*  Of equal texts of at least LENGTH bytes all but the first are
removed whole; their segments are equal too, so they cost one copy in the
index.  A NULL or empty text has no bytes.  Rows with a NULL id come last.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import bitmap, in_bitmap, parallelism, stored
from revlens.llm.text import mix, utf8

LENGTH = 100
#: Bytes of an anchor (a multiple of 8): long enough that chance rarely repeats it.
GRAM = 48
BITMAP_BITS = 26
#: Indexing tasks for each shuffle partition of the session; small tasks hold
#: little at once.
FINER = 4
#: Bytes that are indexed together; a larger anchor group is split exactly.
CHUNK = 1 << 18
#: Bytes of a text whose anchors are searched at once.
PART = 1 << 20
#: Bytes of texts whose segments are held and sent at once; a longer text goes alone.
HELD = 1 << 21


def _windows8(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number."""
    x = buf.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return x


def _least_in(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size:]) if width > size else x


def _gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position."""
    eight = _windows8(buf)
    n = len(buf) - gram + 1
    h = eight[:n].copy()
    for at in range(8, gram, 8):
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
        h += eight[at: at + n]
    return mix(h)


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first start and last start of each run of strings with the
    same anchor, in order."""
    out = []
    for base in range(0, max(1, len(raw) - length + 1), PART):
        part = raw[base: base + PART + length - 1]
        if len(part) < length:
            break
        h = _gram_hashes(np.frombuffer(part, np.uint8), gram)
        # Ties go to the first place: low bits hold the position.
        keyed = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        place = (_least_in(keyed, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        # Minima crowd near 0: hashed again, they spread over buckets and bitmaps.
        out.append((mix(h[place[first]] ^ np.uint64(0xD6E8FEB86659FD93)), first + base, last + base))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def text_hash(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _rows(batches):
    """(row ids or None, texts, batch)."""
    for batch in batches:
        ids = batch.column("row_id").to_numpy() if "row_id" in batch.schema.names else None
        yield ids, utf8(batch.column("text")), batch


def numbered(plain: DataFrame) -> DataFrame:
    """A written copy of the rows with the column row_id.  All passes read it,
    so the numbers stay, however the input is split or a task is repeated."""
    names = [*plain.columns, "row_id"]

    def number(batches):
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(row, row + batch.num_rows))], names=names)
            row += batch.num_rows

    with_row = T.StructType([*plain.schema.fields, T.StructField("row_id", T.LongType())])
    return stored(plain.mapInArrow(number, with_row), "input")


def described(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, n_bytes, text hash and SHA-256 of every row."""
    names = ["row_id", "doc_id", "n_bytes", "same", "sha256"]

    def run(batches):
        for row, texts, batch in _rows(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array(row), batch.column("doc_id").cast(pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()), pa.array([text_hash(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], names=names)

    return docs.mapInArrow(run, "row_id long, doc_id long, n_bytes long, same long, sha256 string")


def _slices(texts: list[bytes]):
    """(from, to) of consecutive texts with about HELD bytes together."""
    begin, size = 0, 0
    for i, raw in enumerate(texts):
        size += len(raw)
        if size >= HELD:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def repeated_anchors(docs: DataFrame, buckets: int, length: int) -> DataFrame:
    """``hash`` of the anchors that occur at two places of different texts, or
    twice in a text; equal texts count as one."""

    def send(batches):
        seen: set[int] = set()
        for _, texts, _ in _rows(batches):
            hashes, tags = [], []
            for raw in texts:
                if len(raw) < length or (same := text_hash(raw)) in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(same)
                h, first, _ = anchors(raw, length)
                hashes.append(h)
                tags.append(mix(first.astype(np.uint64) + np.uint64(same & 0xFFFFFFFFFFFFFFFF)).astype("<u4"))
            if not hashes:
                continue
            hashes, tags = np.concatenate(hashes), np.concatenate(tags)
            bucket = _bucket(hashes, buckets)
            order = np.argsort(bucket, kind="stable")
            hashes, tags, bucket = hashes[order], tags[order], bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
            rows = [(int(bucket[a]), hashes[a:b].tobytes(), tags[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i else pa.int32())
                                              for i, c in enumerate(zip(*rows))], names=["bucket", "hashes", "tags"])

    def meet(batches):
        hashes, tags = [], []
        for batch in batches:
            hashes += batch.column("hashes").to_pylist()
            tags += batch.column("tags").to_pylist()
        h, t = np.frombuffer(b"".join(hashes), np.uint64), np.frombuffer(b"".join(tags), "<u4")
        order = np.argsort(h)
        h, t = h[order], t[order]
        # A second place: a neighbour with this hash and another tag.
        other = (h[1:] == h[:-1]) & (t[1:] != t[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(h[1:][other]).view(np.int64))], names=["hash"])

    sent = docs.select("text").mapInArrow(send, "bucket int, hashes binary, tags binary")
    return sent.repartition(buckets, "bucket").mapInArrow(meet, "hash long")


def _segments(docs: DataFrame, known: np.ndarray, buckets: int, length: int) -> DataFrame:
    """The segments of repeated anchors, one row per batch and bucket."""
    held = docs.sparkSession.sparkContext.broadcast(known)
    names = ["bucket", "hashes", "owners", "sizes", "data"]

    def send(batches):
        for row, texts, batch in _rows(batches):
            doc_ids = [np.iinfo(np.int64).max if d is None else d for d in batch.column("doc_id").to_pylist()]
            # Of equal texts of a batch the first stands for all: the others
            # are removed whole.
            first: dict[bytes, int] = {}
            for i, raw in enumerate(texts):
                if len(raw) >= length:
                    at = first.setdefault(raw, i)
                    if doc_ids[i] < doc_ids[at]:
                        first[raw] = i
            sent = set(first.values())
            for begin, end in _slices(texts):
                yield from sliced(row, texts, doc_ids, [i for i in range(begin, end) if i in sent])

    def sliced(row, texts, doc_ids, here):
        hashes, owners, sizes, data = [], [], [], []
        for i in here:
            raw = texts[i]
            h, first, last = anchors(raw, length)
            hit = np.flatnonzero(in_bitmap(held.value, h))
            if not len(hit):
                continue
            hashes.append(h[hit])
            owner = np.empty((len(hit), 3), np.int64)
            owner[:, 0] = doc_ids[i]
            owner[:, 1], owner[:, 2] = row[i], first[hit]
            owners.append(owner)
            sizes.append(last[hit] - first[hit] + length)
            data += [raw[a: b + length] for a, b in zip(first[hit].tolist(), last[hit].tolist())]
        if not hashes:
            return
        hashes, owners, sizes = np.concatenate(hashes), np.concatenate(owners), np.concatenate(sizes)
        bucket = _bucket(hashes, buckets)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        at = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
        rows = [(int(bucket[a]), hashes[order[a:b]].tobytes(), owners[order[a:b]].tobytes(),
                 sizes[order[a:b]].astype("<u4").tobytes(), b"".join(data[k] for k in order[a:b]))
                for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i else pa.int32())
                                          for i, c in enumerate(zip(*rows))], names=names)

    return docs.mapInArrow(send, "bucket int, hashes binary, owners binary, sizes binary, data binary")


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their next ``depth`` symbols or more (cyclic)."""
    kinds, rank = np.unique(symbols, return_inverse=True)
    base, h = len(kinds), 1
    while h < depth:
        # As many symbols at once as fit 63 bits.
        steps = 1
        while (base ** (steps + 1)).bit_length() < 63 and steps < 8:
            steps += 1
        key = rank.astype(np.int64)
        for i in range(1, max(2, steps)):
            key = key * base + np.roll(rank, -i * h)
        h *= max(2, steps)
        order = np.argsort(key)
        key = key[order]
        step = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(len(order), np.int64)
        rank[order] = step
        base = int(step[-1]) + 1
        if base == len(rank):
            break
    return np.argsort(rank)


def expand_intervals(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For every row of the suffix order, whether it shares fewer than
    ``length`` symbols with the row before it.

    ``new[r]`` is set in round d for the rows with a common prefix of exactly
    d: rows r - 1 and r extend two rows by the same symbol, and those two lie
    in different intervals of depth d."""
    previous = symbols[order - 1]  # the transform; position 0 wraps around
    extend = np.argsort(previous, kind="stable").astype(np.int32)
    sorted_symbols = previous[extend]
    split = np.ones(len(order), dtype=bool)
    split[1:] = sorted_symbols[1:] != sorted_symbols[:-1]
    first = split.copy()
    count = int(split.sum())
    number, interval = np.empty(len(order), np.int32), np.empty(len(order), np.int32)
    for _ in range(1, length):
        np.cumsum(split, dtype=np.int32, out=number)
        np.take(number, extend, out=interval, mode="clip")
        np.not_equal(interval[1:], interval[:-1], out=split[1:])
        split |= first
        now = np.count_nonzero(split)
        if now == count:  # no interval was split: none will be
            break
        count = now
    return split


def repeated_starts(segments: list[bytes], keys: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each of the distinct segments, whether each of its strings occurs
    earlier, in this segment or another; keys[i] orders segment i's start."""
    sizes = np.array([len(s) for s in segments])
    total = int(sizes.sum()) + len(segments)
    symbols = np.empty(total, np.int32)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    marks = begins + sizes
    inside = np.ones(total, dtype=bool)
    inside[marks] = False
    symbols[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int32) + len(segments)
    symbols[marks] = np.arange(len(segments))
    order = suffix_order(symbols, length)
    split = expand_intervals(symbols, order, length)
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    offset = np.arange(total) - begins[owner]
    whole = offset + length <= sizes[owner]
    key = np.where(whole, keys[owner] + offset, np.iinfo(np.int64).max)[order]
    heads = np.flatnonzero(split)
    earliest = np.repeat(np.minimum.reduceat(key, heads), np.diff(np.append(heads, total)))
    late = np.zeros(total, dtype=bool)
    late[order] = key != earliest
    late &= whole
    return [late[b: b + max(0, n - length + 1)] for b, n in zip(begins.tolist(), sizes.tolist())]


Owner = tuple[int, int, int]  # doc_id, row_id, place of the segment


def _index_chunk(chunk: list[tuple[bytes, list[Owner]]], length: int):
    """(row, from, to) of what the first owners of distinct segments lose."""
    firsts = [min(owners) for _, owners in chunk]
    # Order of documents within the chunk, and of positions within a document.
    rank = {d: i for i, d in enumerate(sorted({f[:2] for f in firsts}))}
    keys = np.array([(rank[f[:2]] << 36) + f[2] for f in firsts], np.int64)
    for first, late in zip(firsts, repeated_starts([data for data, _ in chunk], keys, length)):
        edge = np.diff(np.concatenate([[0], late.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            yield first[1], first[2] + a, first[2] + b - 1 + length


def _gram(data: bytes, length: int, gram: int = GRAM) -> bytes:
    """The anchor of a segment's first string."""
    at = int(np.argmin(_gram_hashes(np.frombuffer(data[:length], np.uint8), gram) & ~np.uint64(0xFFFFFF)))
    return data[at: at + gram]


def _halved(group: list[tuple[bytes, int, Owner]], low: int, high: int, length: int, found: list):
    """Distinct segments (data, place of the anchor, first owner) of one anchor,
    as small groups of (data, [owner]) that hold all strings with the anchor at
    places low .. high - 1.  What equal pieces lose goes to ``found``."""
    if high - low == 1 or sum(len(data) for data, _, _ in group) <= CHUNK:
        yield [(data, [owner]) for data, _, owner in group]
        return
    middle = (low + high) // 2
    for least, beyond in ((low, middle), (middle, high)):
        cores: dict[bytes, dict[tuple[bytes, int], Owner]] = {}
        for data, place, (doc, row, start) in group:
            a, b = max(0, place - beyond + 1), min(len(data) - length, place - least)
            if a > b:
                continue
            piece, owner = (data[a: b + length], place - a), (doc, row, start + a)
            same = cores.setdefault(data[place - least: place - beyond + 1 + length], {})
            first = same.get(piece)
            if first is not None:
                first, late = min(first, owner), max(first, owner)
                found.append((late[1], late[2], late[2] + len(piece[0])))
                owner = first
            same[piece] = owner
        while cores:
            _, same = cores.popitem()
            if len(same) > 1:
                yield from _halved([(*piece, owner) for piece, owner in same.items()], least, beyond, length, found)


def _small_groups(owners: dict[bytes, list[Owner]], length: int, found: list):
    """The distinct segments of an anchor in groups that can be indexed."""
    if sum(map(len, owners)) <= CHUNK:
        yield list(owners.items())
        return
    gram = _gram(next(iter(owners)), length)
    group, other = [], []
    for data, all_owners in owners.items():
        # The first occurrence in the first string; another gram with the
        # same 64-bit hash is left as it is.
        place = data.find(gram, 0, length)
        if place < 0:
            other.append((data, all_owners))
        else:
            group.append((data, place, min(all_owners)))
    yield from _halved(group, 0, length - GRAM + 1, length, found)
    yield other


def _index(parts: list[tuple[int, bytes, Owner]], length: int):
    """(row, from, to) of what all segments (in order of anchors) mark."""
    chunk: list[tuple[bytes, list[Owner]]] = []
    size = 0
    for _, group in itertools.groupby(parts, key=lambda p: p[0]):
        owners: dict[bytes, list[Owner]] = {}
        for _, data, owner in group:
            owners.setdefault(data, []).append(owner)
        for data, all_owners in owners.items():
            if len(all_owners) > 1:
                first = min(all_owners)
                yield from ((o[1], o[2], o[2] + len(data)) for o in all_owners if o != first)
        if len(owners) < 2:
            continue
        found: list[tuple[int, int, int]] = []
        for small in _small_groups(owners, length, found):
            chunk += small
            size += sum(len(data) for data, _ in small)
            if size >= CHUNK:
                yield from _index_chunk(chunk, length)
                chunk, size = [], 0
            yield from found
            found.clear()
        yield from found
    if chunk:
        yield from _index_chunk(chunk, length)


def marked(segments: DataFrame, buckets: int, length: int) -> DataFrame:
    """(row_id, start, stop) of bytes to remove; they may overlap."""
    names = ["row_id", "start", "stop"]

    def rows_of(parts):
        parts.sort(key=lambda p: p[0])
        found = _index(parts, length)
        while rows := list(itertools.islice(found, 50_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    def run(batches):
        # Buckets arrive one after another; only one is held.
        now, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["bucket"] != now:
                    yield from rows_of(parts)
                    now, parts = r["bucket"], []
                ends = np.cumsum(np.frombuffer(r["sizes"], "<u4")).tolist()
                data = [r["data"][a:b] for a, b in zip([0, *ends], ends)]
                owner = map(tuple, np.frombuffer(r["owners"], np.int64).reshape(-1, 3).tolist())
                parts += zip(np.frombuffer(r["hashes"], np.uint64).tolist(), data, owner)
        yield from rows_of(parts)

    dealt = segments.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "row_id long, start long, stop long")


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping or touching spans as maximal runs, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Rows (described) with ``first_row``, the first row with the same text,
    and for first rows the spans of bytes to remove: row_id, spans.  ``docs``:
    written rows with row_id, doc_id and text."""
    plain = docs.select("row_id", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = parallelism(docs.sparkSession)
    rows = stored(described(plain), "texts")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    firsts = rows.groupBy("same", "n_bytes").agg(F.min(order).alias("first")).select(
        "same", "n_bytes", F.col("first.row_id").alias("first_row"))
    rows = rows.join(firsts, ["same", "n_bytes"])
    hashes = stored(repeated_anchors(plain, buckets, length), "anchors")
    known = bitmap(hashes, BITMAP_BITS)
    finer = FINER * buckets
    spans = stored(marked(_segments(plain, known, finer, length), finer, length), "spans")
    return rows, spans.groupBy("row_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All columns of ``docs`` with the repeated bytes cut from its text, and
    row_id, n_bytes, n_removed, n_spans, kept_sha256.  A text that is left
    with a broken character (a cut inside it) has U+FFFD there; kept_sha256 is
    of the exact bytes."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, doc_id = (names[docs.columns.index(c)] for c in ("text", "doc_id"))
    copy = numbered(docs.toDF(*names))
    rows, spans = repeated_spans(copy.select("row_id", F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), length)
    first = rows.where("row_id = first_row").select("row_id")
    # Rows that lose bytes: first rows with spans; other rows lose everything.
    work = stored(spans.join(first, "row_id", "left_semi").select("row_id", "spans").union(
        rows.where((F.col("row_id") != F.col("first_row")) & (F.col("n_bytes") >= length)).select(
            "row_id", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop"))))), "work")

    def cut(batches):
        for batch in batches:
            texts, found = [], []
            raws = batch.column(text).cast(pa.binary()).to_pylist()
            for raw, spans in zip(raws, batch.column("spans").to_pylist()):
                runs = merged([(s["start"], s["stop"]) for s in spans or []])
                kept, at = [], 0
                for a, b in runs:
                    kept.append((raw or b"")[at:a])
                    at = b
                left = b"".join([*kept, (raw or b"")[at:]])
                texts.append(None if raw is None else left.decode("utf-8", "replace"))
                found.append((len(raw or b""), sum(b - a for a, b in runs), len(runs), hashlib.sha256(left).hexdigest()))
            columns = [pa.array(texts, pa.string()) if n == text else batch.column(n) for n in [*names, "row_id"]]
            kinds = [pa.int64()] * 3 + [pa.string()]
            columns += [pa.array(c, k) for c, k in zip(list(zip(*found)) or [()] * 4, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "row_id", *new])

    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = T.StructType([*copy.schema.fields, *(
        T.StructField(n, T.StringType() if n == "kept_sha256" else T.LongType()) for n in new)])
    out = copy.join(work, "row_id", "left").mapInArrow(cut, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)), "row_id", *new)
