"""Spelling variants: words one edit apart, found by K-d trees over letter counts.

A word is a point: how often it holds each letter.  One inserted, deleted or
replaced letter moves the point by an L1 distance of at most two (one, if the
lengths differ), so near words lie in a small box around a word, and only
words of the same length (radius two) and of the next length (radius one) are
searched.  A range search goes down a K-d tree, leaves out subtrees whose box
is farther than the radius, and compares the words left in order of letters.

Scale: per word length, a tree fitted on a bounded sample of the vocabulary
(``SAMPLE`` words, by hash) only sets the cells' planes; every word is
indexed, in the one cell it lies in, and is sent as a query to the cells
within its radius.  A cell's words and queries are dealt into blocks of at
most about ``BLOCK``, counted beforehand, and each pair of blocks is searched
by a tree of its own.  Tasks return counts and best words, never pairs.

Letters other than a-z share six dimensions; a shared dimension or a capped
count only makes distances smaller, so nothing is missed.

Rows: a NULL or empty text has no words; a NULL id counts as an empty text in
the deletion rule; repeated rows count each time; an empty table has no words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import stored

#: Dimensions of the letter counts.
DIMS = 32
#: Words on which the planes of the cells are fitted.
SAMPLE = 200_000
#: Words of a cell, and words or queries of a block.
CELL = 131_072
BLOCK = 65_536
#: Words of a leaf.
LEAF = 64
#: Pairs compared at once.
PAIRS = 1 << 21

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs_of(docs: DataFrame) -> DataFrame:
    """doc_id and word: the maximal runs of Latin letters of every text, A-Z
    lower-cased."""
    text = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    found = F.regexp_extract_all(text, F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("word"))


def with_deletions(runs: DataFrame, one_in: int = 199) -> DataFrame:
    """A letter of some runs deleted, as a CRC-32 of id and run decides."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    at = (h % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return runs.select(F.when(h % one_in == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, letters: int = 6, least: int = 5) -> DataFrame:
    """word and n of the words with enough letters and occurrences."""
    return words.where(F.length("word") >= letters).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= least)


def codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), length)


def letter_counts(code: np.ndarray) -> np.ndarray:
    dim = np.where((code >= 97) & (code <= 122), code - 97, 26 + code % 6).astype(np.int64)
    flat = dim + (np.arange(len(code)) * DIMS)[:, None]
    return np.minimum(np.bincount(flat.ravel(), minlength=len(code) * DIMS), 255).astype(np.int16).reshape(-1, DIMS)


def signature(counts: np.ndarray) -> np.ndarray:
    """Two bits per dimension, for counts over 0 and over 1: two signatures
    differ in at most as many bits as the counts' L1 distance."""
    bits = np.concatenate([counts > 0, counts > 1], axis=1)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


class KdTree:
    """Planes (dimension, value) over integer points: at or below the value is
    left.  A leaf's number is its place in ``members``."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.dim, self.value, self.left, self.right = [], [], [], []
        self.members: list[np.ndarray] = []
        self._grow(points, np.arange(len(points)), leaf)

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        node = len(self.dim)
        for column in (self.dim, self.value, self.left, self.right):
            column.append(-1)
        own = points[rows]
        spread = own.var(axis=0) if len(rows) > leaf else np.zeros(1)
        if not spread.any():
            self.value[node] = len(self.members)
            self.members.append(rows)
            return node
        dim = int(spread.argmax())
        values, counts = np.unique(own[:, dim], return_counts=True)
        below = np.cumsum(counts)[:-1]
        at = int(values[np.abs(below - len(rows) / 2).argmin()])
        side = own[:, dim] <= at
        self.dim[node], self.value[node] = dim, at
        self.left[node] = self._grow(points, rows[side], leaf)
        self.right[node] = self._grow(points, rows[~side], leaf)
        return node

    def search(self, points: np.ndarray, radius: int):
        """(leaf, rows) of the points within an L1 ``radius`` of the leaf's box."""
        low, high = np.zeros(DIMS, dtype=np.int64), np.full(DIMS, 1 << 20)
        todo = [(0, np.arange(len(points)), np.zeros(len(points), dtype=np.int64), low, high)]
        while todo:
            node, rows, far, low, high = todo.pop()
            if not len(rows):
                continue
            dim, value = self.dim[node], self.value[node]
            if dim < 0:
                yield value, rows
                continue
            x = points[rows, dim].astype(np.int64)
            rest = far - np.maximum(low[dim] - x, 0) - np.maximum(x - high[dim], 0)
            for child, lo, hi in ((self.left[node], low[dim], value), (self.right[node], value + 1, high[dim])):
                now = rest + np.maximum(lo - x, 0) + np.maximum(x - hi, 0)
                near = now <= radius
                lows, highs = low.copy(), high.copy()
                lows[dim], highs[dim] = lo, hi
                todo.append((child, rows[near], now[near], lows, highs))


def _one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether the words of each row differ by exactly one edit."""
    length = shorter.shape[1]
    if longer.shape[1] == length:
        return (shorter != longer).sum(axis=1) == 1
    ahead, behind = shorter == longer[:, :length], (shorter == longer[:, 1:])[:, ::-1]
    same = [np.where(m.all(axis=1), length, m.argmin(axis=1)) for m in (ahead, behind)]
    return same[0] + same[1] >= length


def near_pairs(queries: np.ndarray, words: np.ndarray):
    """(query rows, word rows) one edit apart; code points, words of one
    length, queries of that length or one less."""
    points, others = letter_counts(queries), letter_counts(words)
    marks, signs = signature(points), signature(others)
    radius = 2 if queries.shape[1] == words.shape[1] else 1
    tree = KdTree(others, LEAF)
    for leaf, rows in tree.search(points, radius):
        members = tree.members[leaf]
        step = max(1, PAIRS // len(members))
        for a in range(0, len(rows), step):
            own = rows[a: a + step]
            close = np.bitwise_count(marks[own][:, None] ^ signs[members][None, :]) <= radius
            q, w = np.nonzero(close)
            q, w = own[q], members[w]
            right = _one_edit(queries[q], words[w])
            yield q[right], w[right]


_ROUTED = "length int, cell int, query boolean, word string, n long"


def _routed(vocab: DataFrame, trees: dict[int, KdTree]) -> DataFrame:
    """Every word as an index row of its cell (query false) and as a query of
    the cells near it among words of its own and of the next length."""

    def route(batches):
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                points = letter_counts(codes([words[i] for i in at], length))
                for to, query in ((length, False), (length, True), (length + 1, True)):
                    tree, radius = trees.get(to), 0 if not query else 2 if to == length else 1
                    hits = tree.search(points, radius) if tree else [(0, np.arange(len(at)))]
                    for cell, rows in hits:
                        own = at[rows]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), v, dtype=np.int32)) for v in (to, cell)]
                            + [pa.array(np.full(len(own), query)), pa.array([words[i] for i in own], pa.string()),
                               pa.array(n[own])], names=["length", "cell", "query", "word", "n"])

    return vocab.select("word", "n").mapInArrow(route, _ROUTED)


def _searched(table: pa.Table) -> pa.Table:
    """Of one pair of blocks: per word the number of near words found, and the
    best of them (greatest n, then least word)."""
    query = table.column("query").to_numpy()
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    length = table.column("length")[0].as_py()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    index = np.flatnonzero(~query)
    names = ["word", "n_near", "form", "form_n"]
    counts, heads, tails = np.zeros(len(words), dtype=np.int64), [], []
    if len(index):
        code = codes([words[i] for i in index], length)
        for own in (length, length - 1):
            at = np.flatnonzero(query & (lengths == own))
            if not len(at):
                continue
            for q, w in near_pairs(codes([words[i] for i in at], own), code):
                heads.append(at[q])
                tails.append(index[w])
                if own < length:  # the longer word does not ask for shorter ones
                    heads.append(index[w])
                    tails.append(at[q])
    if not heads or not sum(map(len, heads)):
        return pa.table([pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.string()), pa.array([], pa.int64())], names)
    head, tail = np.concatenate(heads), np.concatenate(tails)
    np.add.at(counts, head, 1)
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[tail], -n[tail], head))
    first = order[np.concatenate([[True], np.diff(head[order]) > 0])]
    return pa.table([pa.array([words[i] for i in head[first]], pa.string()), pa.array(counts[head[first]]),
                     pa.array([words[i] for i in tail[first]], pa.string()), pa.array(n[tail[first]])], names)


def cells(vocab: DataFrame, size: int = CELL) -> dict[int, KdTree]:
    """The planes for the word lengths that have more words than a cell takes."""
    large = {r["length"]: r["count"] for r in vocab.groupBy(F.length("word").alias("length")).count()
             .where(F.col("count") > size).collect()}
    if not large:
        return {}
    sample = vocab.where(F.length("word").isin(list(large))).select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    by: dict[int, list[str]] = {}
    for word in sample.toArrow().column("word").to_pylist():
        by.setdefault(len(word), []).append(word)
    trees = {}
    for length, words in by.items():
        trees[length] = KdTree(letter_counts(codes(words, length)), math.ceil(len(words) * size / large[length]))
        trees[length].members = []
    return trees


def near_words(vocab: DataFrame, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """word, n_near, best (-n and word of the best near word) of the words that
    have a near word.  ``vocab``: stored, distinct words of one letter or more."""
    rows = stored(_routed(vocab, cells(vocab, cell)), "near-routed")
    sizes = rows.groupBy("length", "cell").agg(F.count_if("query").alias("queries"), F.count_if(~F.col("query")).alias("words"))
    sizes = sizes.select("length", "cell", F.ceil(F.col("queries") / block).cast("int").alias("query_blocks"),
                         F.ceil(F.col("words") / block).cast("int").alias("word_blocks")).where("query_blocks * word_blocks > 0")
    dealt = rows.join(sizes, ["length", "cell"])
    hashed = F.xxhash64("word")
    # A row has its own block on its side and goes to every block of the other.
    own = F.when(F.col("query"), F.pmod(hashed, F.col("query_blocks"))).otherwise(F.pmod(hashed, F.col("word_blocks")))
    other = F.when(F.col("query"), F.col("word_blocks")).otherwise(F.col("query_blocks"))
    dealt = dealt.select("length", "cell", "query", "word", "n", own.alias("own"), F.explode(F.sequence(F.lit(0), other - 1)).alias("o"))
    dealt = dealt.withColumn("q", F.when(F.col("query"), F.col("own")).otherwise(F.col("o"))).withColumn(
        "w", F.when(F.col("query"), F.col("o")).otherwise(F.col("own"))).drop("own", "o")
    parts = dealt.groupBy("length", "cell", "q", "w").applyInArrow(
        _searched, "word string, n_near long, form string, form_n long")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(
        F.struct((-F.col("form_n")).alias("minus"), F.col("form").alias("word"))).alias("best"))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """word and root: where following ``form`` ends, for words with a form; a
    chain has at most 2^steps links."""
    now = stored(forms.select("word", F.col("form").alias("root")), "near-roots")
    for _ in range(steps):
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stored(now.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "near-roots")
    return now


def variants(vocab: DataFrame, ratio: int = 5, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``vocab`` (word, n)."""
    vocab = stored(vocab, "near-vocabulary")
    found = vocab.join(near_words(vocab, cell, block), "word", "left")
    best = -F.col("best.minus")
    takes = best >= ratio * F.col("n")
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(takes, F.col("best.word")).alias("form"), F.when(takes, best).alias("form_n")), "near-found")
    # Each link multiplies n by the ratio or more, which bounds the chains.
    ends = vocab.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    links = 1 if not ends["most"] else 1 + int(math.log(ends["most"] / ends["least"], ratio))
    chained = roots(found.where("form IS NOT NULL"), math.ceil(math.log2(links + 1)))
    return found.join(chained, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
