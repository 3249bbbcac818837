"""N-gram Jaccard join by PartEnum signatures (exact).

A document is the set of its distinct SHINGLE-word shingles.  Two documents
link when 100 |A n B| >= PERCENT |A u B|.  Sets A, B of sizes s, t that link
differ in at most k = (s + t)(1 - j)/(1 + j) elements.

*Size bands.*  Band i holds the sizes l .. r with r = l / j, so linked sets
lie in one band or in neighbouring ones.  Instance i of the scheme serves band
i and, as partners, band i - 1; a set takes part in two instances.

*Partitions.*  Instance i splits the shingle domain, by hash, into n
partitions.  Two sets with at most k differing elements agree on at least
n - k partitions.  A set's signature for a partition is a hash of all its
shingles there: the enumerated subsets are the single partitions, which for
these thresholds is the cheapest member of the family.  Two sets may also
agree on a partition that is empty in both, so a set with e empty partitions
shares at least c = n - k - e signatures of filled partitions with any linked
set.  A set with c < 1 (a few small ones) emits its empty partitions too and
meets others of its kind there.

*Frequent signatures.*  Passages that many unrelated documents share make
signatures that many have.  Since c shared signatures are certain, a set may
leave out its c - 1 most frequent ones: of the signatures that two linked
sets share, the least frequent stays in both.  Signatures of HOT or more nodes
are counted and thinned out in this way; no candidate is lost.

*Candidates.*  Signatures travel in blocks, one per task batch and bucket, and
each bucket task sorts its signatures.  Documents with equal sets are one node
from the start.  Sets with a common signature are first compared with one node
among them (a star, never all pairs): the smallest, or for a frequent
signature the one with most frequent company, since the text that near copies
were made from shares most.  Verified links are
joined to components.  Only where the nodes of one signature lie in more than
one component are the pairs across components compared too; within a component
nothing more can be learnt.  For frequent signatures this is done block against
block inside tasks, without a row per pair.  So no link between different texts
is lost, and copies or close near copies cost about one comparison each.

*Verification* first compares histograms of the sets over parts of the domain,
which refute most candidates, then intersects the sets themselves.  Only documents with a
candidate ship them (picked by a bitmap of fixed size, then by an exact join).

NULL or empty texts, and texts without words, have the empty set and link with
nothing.  Texts of fewer words are one shingle.  Repeated rows are nodes of one
component.  Rows with a NULL id take part; the component's id is the smallest
id that is not NULL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import bitmap, components, in_bitmap, packed, parallelism, sent, stored
from revlens.llm.text import SPACED, hashed_words, mix, shingles, utf8

SHINGLE = 5
PERCENT = 75
#: Partitions of an instance: so many for each element of its largest set, and
#: a few more, so that small sets rarely run out of partitions.
PER_ELEMENT = 0.40
EXTRA = 6
BITMAP_BITS = 24
#: Signatures of so many nodes are thinned out by frequency.
HOT = 8
#: A bucket's signatures are sorted in so many parts, one after another.
PARTS = 8
#: Words whose shingles are hashed and sorted at a time.
PORTION = 1 << 17
#: Sets, or pairs of sets, that a task holds at least where they are few.
EACH = 1000
#: Nodes in a block, when the nodes of frequent signatures are compared.
BLOCK = 256


class Scheme:
    """Bands, partitions and difference bounds for one threshold."""

    def __init__(self, percent: int = PERCENT, per_element: float = PER_ELEMENT, extra: int = EXTRA):
        self.percent, self.per_element, self.extra = percent, per_element, extra
        self.lows = [1]

    def band(self, size: int) -> int:
        while self.high(len(self.lows) - 1) < size:
            self.lows.append(self.high(len(self.lows) - 1) + 1)
        return next(i for i in range(len(self.lows) - 1, -1, -1) if self.lows[i] <= size)

    def high(self, band: int) -> int:
        return self.lows[band] * 100 // self.percent

    def partitions(self, band: int) -> int:
        # More than the largest possible difference, or empty sets could not meet.
        high = self.high(band)
        return max(int(self.per_element * high) + self.extra, self.differ(high, high) + 1)

    def differ(self, s: int, t: int) -> int:
        """Most differing elements of linked sets of sizes s and t."""
        return (s + t) * (100 - self.percent) // (100 + self.percent)

    def instances(self, size: int):
        """(instance, partitions, most differing elements) for a set."""
        own = self.band(size)
        # Partners in the same band, or below it.
        yield own, self.partitions(own), self.differ(size, min(self.high(own), size * 100 // self.percent))
        self.band(self.high(own) + 1)
        reach = min(self.high(own + 1), size * 100 // self.percent)
        if reach > self.high(own):
            yield own + 1, self.partitions(own + 1), self.differ(size, reach)


def _partitioned(grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Filled partitions of a set in ascending order, and where each begins."""
    at = (((grams >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], first


def spare(grams: np.ndarray, scheme: Scheme) -> list[int]:
    """Signatures that the set may leave out, by parity of the instance."""
    out = [0, 0]
    for instance, n, k in scheme.instances(len(grams)):
        out[instance % 2] = max(0, len(_partitioned(grams, n)[0]) - k - 1)
    return out


def signatures(grams: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Signatures of a set of distinct hashes in ascending order; the lowest
    bit is the parity of the instance."""
    out = []
    mixed = mix(grams ^ np.uint64(0x5851F42D4C957F2D))
    for instance, n, k in scheme.instances(len(grams)):
        filled, first = _partitioned(grams, n)
        seed = np.uint64(((instance + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        sums = np.add.reduceat(mixed, first)
        if len(filled) - k < 1:
            whole = np.zeros(n, dtype=np.uint64)
            whole[filled] = sums
            filled, sums = np.arange(n), whole
        out.append(mix((sums ^ seed) + filled.astype(np.uint64)) & ~np.uint64(1) | np.uint64(instance % 2))
    return np.concatenate(out)


def set_hashes(grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit number for every set, as signed longs; the sets stand one
    after another and end at ``ends``."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams), dtype=np.uint64)])[np.concatenate([[0], ends])]
    return mix(np.diff(sums) + np.diff(ends, prepend=0).astype(np.uint64)).view(np.int64)


def _in_portion(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the texts of a portion, one after
    another, and where each text's end.  Text i has words[at[i]:at[i + 1]]."""
    counts = np.diff(at)
    windows = np.maximum(counts - n + 1, 0)
    inside = np.zeros(len(words), dtype=bool)
    inside[np.arange(windows.sum()) + np.repeat(at[:-1] - (np.cumsum(windows) - windows), windows)] = True
    grams = shingles(words, n)[inside[: max(0, len(words) - n + 1)]] if windows.any() else words[:0]
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        # All words of these texts are one shingle.
        ends = np.cumsum(windows)
        grams = np.insert(grams, ends[few], [shingles(words[at[i]: at[i + 1]], n)[0] for i in few])
        windows[few] = 1
    ends = np.cumsum(windows)
    for a, b in zip((ends - windows).tolist(), ends.tolist()):
        grams[a:b].sort()
    fresh = np.ones(len(grams), dtype=bool)
    fresh[1:] = grams[1:] != grams[:-1]
    fresh[(ends - windows)[windows > 0]] = True
    return grams[fresh], np.concatenate([[0], np.cumsum(fresh)])[ends]


def _sets(batch, n: int = SHINGLE):
    """Node (None for the empty set) and the sorted distinct shingle hashes
    of every text of a batch, hashed in portions of about PORTION words."""
    hashes, at = hashed_words(utf8(batch.column("text")), SPACED, lower=True)
    begin = 0
    while begin < len(at) - 1:
        stop = max(begin + 1, int(np.searchsorted(at, at[begin] + PORTION, "right")) - 1)
        grams, ends = _in_portion(hashes[at[begin]: at[stop]], at[begin: stop + 1] - at[begin], n)
        first = 0
        for node, end in zip(set_hashes(grams, ends).tolist(), ends.tolist()):
            yield (node if end > first else None), grams[first:end]
            first = end
        begin = stop


def described(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, node (NULL for the empty set) and the signatures
    that the set may leave out, by parity."""
    names = ["doc_id", "n_shingles", "node", "spare0", "spare1"]

    def run(batches):
        scheme = Scheme(percent)
        for batch in batches:
            sets = [(len(g), node, *spare(g, scheme)) if len(g) else (0, None, 0, 0) for node, g in _sets(batch)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                *(pa.array([x[i] for x in sets], pa.int64()) for i in range(4))], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, ", ".join(f"{c} long" for c in names))


def _blocks(docs: DataFrame, buckets: int, percent: int) -> DataFrame:
    """Signatures, one row per batch and bucket: nodes, their sizes, how many
    signatures each has here, and the signatures (48 bits each)."""
    names = ["bucket", "nodes", "sizes", "counts", "sigs"]

    def run(batches):
        scheme = Scheme(percent)
        seen: set[int] = set()  # equal sets of a task are sent once
        for batch in batches:
            nodes, sizes, sigs = [], [], []
            for node, grams in _sets(batch):
                if not len(grams) or node in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(node)
                nodes.append(node)
                sizes.append(len(grams))
                sigs.append(signatures(grams, scheme))
            if not nodes:
                continue
            every = np.concatenate(sigs)
            owner = np.repeat(np.arange(len(nodes)), [len(s) for s in sigs])
            bucket = ((every >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            every, owner, bucket = every[order], owner[order], bucket[order]
            nodes, sizes = np.array(nodes, np.int64), np.array(sizes, np.int32)
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
            rows = []
            for a, b in zip(edges[:-1], edges[1:]):
                who, count = np.unique(owner[a:b], return_counts=True)
                low = np.ascontiguousarray(every[a:b]).view("<u2").reshape(-1, 4)[:, :3]
                rows.append((int(bucket[a]), nodes[who].tobytes(), sizes[who].tobytes(),
                             count.astype("<u2").tobytes(), low.tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))], names=names)

    return docs.select("text").mapInArrow(run, "bucket int, nodes binary, sizes binary, counts binary, sigs binary")


def _meet(blocks: DataFrame, buckets: int, percent: int) -> DataFrame:
    """kind 0: (a, b) to compare, a the smallest node with a signature.
    kind 1: (list, node), the nodes of a signature that three or more have;
    equal lists of a task are given once.
    kind 2: (signature, node, nodes that have it), if HOT or more do."""
    names = ["kind", "a", "b", "n"]

    def part_of(rows, part):
        """Signatures in one PARTS-th of their domain, their nodes and sizes."""
        sigs, nodes, sizes = [], [], []
        for bucket, node, size, count, low in rows:
            low = np.frombuffer(low, "<u2").reshape(-1, 3)
            here = low[:, 2] // (65536 // PARTS) == part
            whole = np.zeros((int(here.sum()), 4), "<u2")
            whole[:, :3] = low[here]
            # Buckets that share a task differ in the free top bits.
            whole[:, 3] = bucket & 0xFFFF
            owner = np.repeat(np.arange(len(count) // 2), np.frombuffer(count, "<u2"))[here]
            sigs.append(whole.view("<u8").ravel())
            nodes.append(np.frombuffer(node, np.int64)[owner])
            sizes.append(np.frombuffer(size, np.int32)[owner])
        return np.concatenate(sigs), np.concatenate(nodes), np.concatenate(sizes)

    def run(batches):
        rows = [tuple(r[k] for k in ("bucket", "nodes", "sizes", "counts", "sigs"))
                for batch in batches for r in batch.to_pylist()]
        for part in range(PARTS if rows else 0):
            yield from meeting(*part_of(rows, part))

    def meeting(sigs, nodes, sizes):
        order = np.argsort(sigs)
        sigs = sigs[order]
        same = np.zeros(len(sigs) + 1, dtype=bool)
        same[1:-1] = sigs[1:] == sigs[:-1]
        keep = same[1:] | same[:-1]
        order, sigs = order[keep], sigs[keep]
        nodes, sizes = nodes[order], sizes[order]
        again = np.lexsort((nodes, sigs))
        sigs, nodes, sizes = sigs[again], nodes[again], sizes[again]
        fresh = np.ones(len(sigs), dtype=bool)
        fresh[1:] = (sigs[1:] != sigs[:-1]) | (nodes[1:] != nodes[:-1])
        sigs, nodes, sizes = sigs[fresh], nodes[fresh], sizes[fresh]
        heads = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]])) if len(sigs) else np.zeros(0, int)
        members = np.diff(np.append(heads, len(sigs)))
        head = np.repeat(heads, members)
        hot = np.repeat(members >= HOT, members)
        hot_rows = np.stack([sigs[hot].view(np.int64), nodes[hot], np.repeat(members, members)[hot]], axis=1)
        pair = ~hot & (np.arange(len(sigs)) != head) & (
            100 * np.minimum(sizes, sizes[head]) >= percent * np.maximum(sizes, sizes[head]).astype(np.int64))
        pairs = np.unique(np.stack([nodes[head][pair], nodes[pair]], axis=1), axis=0)
        listed = (members >= 3) & (members < HOT)
        many = np.repeat(listed, members)
        lists = np.zeros((0, 2), np.int64)
        if many.any():
            starts, counts = heads[listed], members[listed]
            inner = np.concatenate([[0], np.cumsum(counts)[:-1]])
            key = mix(np.add.reduceat(mix(nodes[many].view(np.uint64)), inner) + counts.astype(np.uint64))
            _, one = np.unique(key, return_index=True)
            chosen = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in one])
            lists = np.stack([np.repeat(key[one].view(np.int64), counts[one]), nodes[chosen]], axis=1)
        for kind, rows in ((0, pairs), (1, lists), (2, hot_rows)):
            for at in range(0, len(rows), 100_000):
                part = rows[at: at + 100_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), kind, np.int32)), pa.array(part[:, 0].copy()),
                    pa.array(part[:, 1].copy()),
                    pa.array(part[:, 2].copy() if kind == 2 else np.zeros(len(part), np.int64))], names=names)

    return blocks.repartition(buckets, "bucket").mapInArrow(run, "kind int, a long, b long, n long")


def _thinned(hot: DataFrame, nodes: DataFrame) -> DataFrame:
    """(signature, node) of frequent signatures, without the most frequent
    ones that each node may leave out; signatures left with one node go."""
    parity = F.col("sig").bitwiseAND(F.lit(1).cast("long"))
    rank = F.row_number().over(Window.partitionBy("node", "parity").orderBy(F.desc("n"), "sig"))
    weight = F.sum("n").over(Window.partitionBy("node"))
    kept = (hot.withColumn("weight", weight).withColumn("parity", parity).withColumn("rank", rank).join(nodes, "node")
            .where(F.col("rank") > F.when(F.col("parity") == 0, F.col("spare0")).otherwise(F.col("spare1"))))
    # The text that near copies come from shares most with all the others.
    heads = kept.groupBy("sig").agg(F.max_by("node", F.struct("weight", "node")).alias("head"),
                                    F.count("*").alias("members")).where("members > 1")
    return kept.select("sig", "node", "size").join(heads, "sig")


def _picked(docs: DataFrame, wanted: DataFrame, payload) -> DataFrame:
    """node, size and ``payload`` of the sets of the wanted nodes, which may
    repeat.  A bitmap of fixed size picks them in the scan, a join makes the
    choice exact."""
    bits = bitmap(wanted.select(F.col("node").alias("hash")), BITMAP_BITS)
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            rows = []
            sets = [(node, g) for node, g in _sets(batch) if len(g)]
            wanted_here = in_bitmap(held.value, np.array([n for n, _ in sets], np.int64).view(np.uint64))
            for (node, grams), here in zip(sets, wanted_here):
                if not here or node in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(node)
                rows.append((node, len(grams), payload(grams)))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.binary())], names=["node", "size", "grams"])

    found = docs.select("text").mapInArrow(run, "node long, size long, grams binary")
    # While few bits are set, there are hardly more nodes than bits.
    nodes = int(np.bitwise_count(bits).sum())
    exact = found.join(sent(wanted.distinct(), nodes), "node", "left_semi").dropDuplicates(["node"])
    return packed(exact, nodes, EACH)


def _histogram(grams: np.ndarray) -> bytes:
    """How many of the set's shingles lie in each of 2^c equal parts of the
    domain, with 2^c the largest power up to the set's size; at most 255."""
    bits = len(grams).bit_length() - 1
    at = (mix(grams) >> np.uint64(40)) >> np.uint64(24 - bits)
    return np.minimum(np.bincount(at.astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _folded(histogram: np.ndarray, cells: int) -> np.ndarray:
    return histogram.reshape(cells, -1).sum(axis=1, dtype=np.int32)


def _may_link(x: np.ndarray, y: np.ndarray, s: int, t: int, scheme: Scheme) -> bool:
    """False only if the parts' counts differ by more than linked sets may
    differ; the sum of those differences never exceeds that of the sets."""
    cells = min(len(x), len(y))
    return int(np.abs(_folded(x, cells) - _folded(y, cells)).sum()) <= scheme.differ(s, t)


def _in_blocks(near: DataFrame, rows: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that have a head in common, lie in different
    components, and may link by their histograms; they may repeat.

    ``near``: head, node, root, size, grams, at most so many ``rows``.  The nodes of a head are dealt
    into blocks of about BLOCK; a task gets two blocks and compares all their
    pairs in place, so pairs are never rows and no task holds more than two
    blocks."""
    blocks = near.groupBy("head").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = near.join(sent(blocks, rows), "head").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "head", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("first"), "node", "root", "size", "grams")

    def compare(pdf):
        import pandas as pd

        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        if pdf["root"].nunique() < 2:
            return none
        found = [np.frombuffer(g, np.uint8) for g in pdf["grams"]]
        cells = min(map(len, found))
        counts = np.stack([_folded(g, cells) for g in found])
        size = pdf["size"].to_numpy()
        both, least = size[:, None] + size, np.minimum(size[:, None], size)
        apart = np.stack([np.abs(counts - row).sum(axis=1) for row in counts])
        hit = (apart <= both * (100 - percent) // (100 + percent)) & (100 * least >= percent * (both - least))
        root, first = pdf["root"].to_numpy(), pdf["first"].to_numpy()
        hit &= root[:, None] != root
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            hit &= first[:, None] != first
        x, y = np.nonzero(np.triu(hit, 1))
        node = pdf["node"].to_numpy()
        return pd.DataFrame({"a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y])})

    return dealt.groupBy("head", "i", "j").applyInPandas(compare, "a long, b long")


def _compare(pairs: DataFrame, sets: DataFrame, keep, kind) -> DataFrame:
    """The pairs (a, b) for which keep(set, set, size, size) holds; ``pairs``
    may be marked for a broadcast."""

    def run(batches):
        for batch in batches:
            x, y, s, t = (batch.column(c).to_pylist() for c in ("x", "y", "s", "t"))
            hit = [keep(np.frombuffer(p, kind), np.frombuffer(q, kind), m, n) for p, q, m, n in zip(x, y, s, t)]
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    first = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"), F.col("size").alias("s"))
    second = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"), F.col("size").alias("t"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y", "s", "t").mapInArrow(
        run, "a long, b long")


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _linked(docs: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets, which only they ship."""

    def does(x, y, s, t):
        shared = _shared(x, y)
        return 100 * shared >= percent * (s + t - shared)

    near = stored(near, "near")
    n_near = near.count()
    nodes = near.select(F.col("a").alias("node")).union(near.select("b"))
    sets = stored(_picked(docs, nodes, lambda g: g.tobytes()), "whole-sets")
    return packed(_compare(sent(near, n_near), sets, does, np.uint64), n_near, EACH)


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    buckets = parallelism(docs.sparkSession)
    rows = stored(described(docs, percent), "sets")
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("size"),
        F.first("spare0").alias("spare0"), F.first("spare1").alias("spare1"))
    met = stored(_meet(_blocks(docs, buckets, percent), buckets, percent), "met")
    hot = met.where("kind = 2").select(F.col("a").alias("sig"), F.col("b").alias("node"), "n")
    hot = stored(_thinned(hot, classes.drop("least")), "frequent")
    pairs = stored(met.where("kind = 0").select("a", "b").union(
        hot.where("head <> node").select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"))
    ).distinct(), "pairs")
    n_pairs = pairs.count()
    lists = met.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node"))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(lists.select("node"))
    histograms = stored(_picked(docs, wanted, _histogram), "histograms")
    scheme = Scheme(percent)
    near = packed(_compare(sent(pairs, n_pairs), histograms, lambda x, y, s, t: _may_link(x, y, s, t, scheme),
                           np.uint8), n_pairs, EACH)
    links = stored(_linked(docs, near, percent), "links")
    roots, n_roots = components(links), 2 * links.count()

    # The members of signatures whose nodes lie in several components; head is
    # NULL for the lists of few nodes.
    members = lists.distinct().select("key", "node", F.lit(None).cast("long").alias("head")).union(
        hot.select("sig", "node", "head"))
    at = members.join(sent(roots, n_roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    key = ["key", F.col("head").isNull().alias("few")]
    mixed = at.groupBy(*key).agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
    across = at.select("*", key[1]).join(mixed.select("key", "few"), ["key", "few"])
    across = stored(packed(across, lists.count() + hot.count()), "across")
    n_across = across.count()
    # Few nodes: their pairs are rows.  Frequent signatures: blocks.
    few = sent(across.where("few"), n_across).join(histograms, "node").select("key", "node", "root", "size")
    x = few.select("key", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("size").alias("sa"))
    y = few.select("key", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("size").alias("sb"))
    rows_across = x.join(sent(y, n_across), "key").where(
        (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))
        & (100 * F.least("sa", "sb") >= percent * F.greatest("sa", "sb"))).select("a", "b").distinct()
    more = _compare(rows_across.join(pairs, ["a", "b"], "left_anti"), histograms,
                    lambda x, y, s, t: _may_link(x, y, s, t, scheme), np.uint8)
    many = across.where("NOT few").select("head", "node", "root").distinct()
    blocks = _in_blocks(sent(many, n_across).join(histograms, "node"), n_across, percent)
    more = stored(_linked(docs, more.union(blocks).distinct(), percent), "more-links")
    n_more = more.count()
    if n_more:
        roots, n_roots = components(links.union(more)), n_roots + 2 * n_more
    n_rows = rows.count()  # no fewer than classes
    classes = classes.select("node", "least").join(sent(roots, n_roots), "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = classes.join(sent(named, n_rows), "root").select("node", "component_id")
    return rows.join(sent(labels, n_rows), "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
