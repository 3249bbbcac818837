"""Quality classifier: random Fourier features over document statistics,
ridge regression from summed normal equations, isotonic calibration.

1. Statistics.  One pass turns every whole text into STATISTICS numbers
   (lengths, character classes, repetition); only those are stored.
2. Features.  Statistics are standardised by their mean and deviation over
   all documents and mapped to cos(x W + b), whose inner products approximate
   a Gaussian kernel of width ``width``.  W and b come from a fixed seed.
3. Fit.  Each task adds up Z'Z and Z'y of its labelled rows; the sums of the
   tasks are added in two steps, and one small system of fixed size is solved
   on the driver.
4. Calibration.  Labelled rows are counted by bins of their raw score (BINS
   at most) and pooled to a non-decreasing rate of label 1.

Rows of labels with a NULL id or quality do not count; several labels of a
document count as their mean, rounded.  NULL texts are empty texts.  Repeated
rows are scored alike.  Without labelled rows of both kinds in the training
part, all scores are the share of label 1, or 0.5 without any.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import stored, summed_vectors
from revlens.llm.compression_bands import repeated_words
from revlens.llm.text import SPACED, hashed_words, utf8

FEATURES = 384
WIDTH = 4.0
RIDGE = 1e-3
SEED = 7
BINS = 2048
#: Raw scores are counted in bins over this range; what lies outside counts
#: in the end bins.
RANGE = (-0.5, 1.5)

_CLASSES = np.zeros((256, 9))
for _k, _members in enumerate((
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n",
        b".,;:'\"-()", b"!?", b"#*$%&|<>@=_~^\\/+{}[]`", bytes(range(128, 256)))):
    _CLASSES[list(_members), _k] = 1
STATISTICS = _CLASSES.shape[1] + 11


def statistics(raw: bytes, words: np.ndarray) -> np.ndarray:
    """The numbers that describe a text."""
    out = np.zeros(STATISTICS)
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    k = _CLASSES.shape[1]
    out[:k] = counts @ _CLASSES / len(raw)
    p = counts[counts > 0] / len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    out[k:k + 4] = (np.log1p(len(raw)), np.log1p(n), -(p * np.log2(p)).sum(), len(raw) / (n + 1))
    out[k + 4] = 1 - len(set(lines)) / max(1, len(lines))
    out[k + 5] = np.log1p(n / max(1, len(lines)))
    if n:
        _, found = np.unique(words, return_counts=True)
        out[k + 6:k + 11] = (len(found) / n, found.max() / n, repeated_words(words, 3) / n,
                             float((words[1:] == words[:-1]).sum()) / n, np.log1p(raw.count(b".")) - np.log1p(n))
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` besides its text, and ``stats`` (float64s)."""
    rest = [c for c in docs.columns if c != "text"]
    kept = docs.select("text", F.struct(*rest).alias("row")) if rest else docs.select("text", F.lit(None).alias("row"))
    row_kind = kept.schema["row"].dataType
    schema = f"row {row_kind.simpleString()}, stats binary"

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column("text"))
            hashes, at = hashed_words(texts, SPACED, lower=True)
            found = [statistics(t, hashes[at[i]: at[i + 1]]).tobytes() for i, t in enumerate(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.binary())], names=["row", "stats"])

    out = kept.mapInArrow(run, schema)
    return out.select("row.*", "stats") if rest else out.select("stats")


@dataclass
class Model:
    """Everything a task needs to score; its size does not grow with data."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    edges: np.ndarray
    rates: np.ndarray
    seed: int = SEED
    width: float = WIDTH

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        w = rng.normal(size=(STATISTICS, FEATURES)) / self.width
        b = rng.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(x @ w + b) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(stats))
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        rate = np.interp(raw, self.edges, self.rates)
        # A trace of the raw score keeps the order where the rates are level.
        low, high = RANGE
        return 0.998 * rate + 0.002 * np.clip((raw - low) / (high - low), 0, 1)


def _matrix(batch) -> np.ndarray:
    stats = batch.column("stats").to_pylist()
    return np.frombuffer(b"".join(stats)).reshape(len(stats), STATISTICS)


def isotonic(counts: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: non-decreasing rates, weighted by counts."""
    pools: list[list[float]] = []
    for n, s in zip(counts, ones):
        pools.append([n, s, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n2, s2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + n2, pools[-1][1] + s2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), s / n) for n, s, k in pools]) if pools else np.zeros(0)


def _vectors(df: DataFrame, each) -> np.ndarray | None:
    """Sum over all rows of the vector that ``each`` makes of a batch."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                v = each(batch)
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             names=["key", "value"])

    found = summed_vectors(df.mapInArrow(run, "key int, value binary")).collect()  # one row of fixed size
    return np.frombuffer(found[0]["value"]).copy() if found else None


def fit(stats: DataFrame, labelled: DataFrame) -> Model:
    """``stats``: column stats, all documents; ``labelled``: stats and label
    (0 or 1) of the training rows."""

    def moments(batch):
        x = _matrix(batch)
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    m = _vectors(stats.select("stats"), moments)
    if m is None:
        m = np.concatenate([[1.0], np.zeros(2 * STATISTICS)])
    mean = m[1: 1 + STATISTICS] / m[0]
    scale = np.sqrt(np.maximum(m[1 + STATISTICS:] / m[0] - mean ** 2, 1e-12))
    model = Model(mean, scale, None, np.array([0.0]), np.array([0.5]))
    width = FEATURES + 1

    def normal(batch):
        z = model.features(_matrix(batch))
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y, [len(y), y.sum()]])

    sums = _vectors(labelled.select("stats", "label"), normal)
    if sums is None:
        return model
    n, ones = sums[-2:]
    model.rates = np.array([ones / n])
    if not 0 < ones < n:
        return model
    gram = sums[: width * width].reshape(width, width) + RIDGE * n / FEATURES * np.eye(width)
    model.weights = np.linalg.solve(gram, sums[width * width: width * width + width])
    low, high = RANGE

    def binned(batch):
        raw = model.raw(_matrix(batch))
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        at = np.clip(((raw - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS).astype(float), np.bincount(at, y, BINS)])

    counts = _vectors(labelled.select("stats", "label"), binned)
    used = np.flatnonzero(counts[:BINS])
    model.edges = low + (used + 0.5) * (high - low) / BINS
    model.rates = isotonic(counts[used], counts[BINS + used])
    return model


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; NULL ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def _labelled(stats: DataFrame, key: str, labels: DataFrame, folds: int, held: int) -> DataFrame:
    """stats and label of the documents with a label outside fold ``held``."""
    train = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold(F.col("doc_id"), folds) != held)
             .groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg((F.avg("quality") >= 0.5).cast("double").alias("label")))
    found = stats.select(F.col(key).cast("long").alias("label_id"), "stats").join(train, "label_id")
    return stored(found.select("stats", "label"), "labelled")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, folds: int = 3, held: int = 1) -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, unchanged.
    Texts are not shuffled: the model comes from stored statistics, and the
    rows are judged where they are read."""
    stats = stored(document_statistics(docs.select("doc_id", "text")), "statistics")
    model = fit(stats, _labelled(stats, "doc_id", labels, folds, held))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index("text")]

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(text))
            hashes, at = hashed_words(texts, SPACED, lower=True)
            found = [statistics(t, hashes[at[i]: at[i + 1]]) for i, t in enumerate(texts)]
            scores = model.score(np.array(found).reshape(len(texts), STATISTICS))
            yield batch.filter(pa.array(scores >= least, pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """All columns of ``docs`` but its text, with held_out, score, predicted.
    Labels of fold ``held`` are never read by the fit."""
    names = [f"c{i}" for i, c in enumerate(docs.columns) if c != "text"]
    back = dict(zip(names, (c for c in docs.columns if c != "text")))
    plain = docs.toDF(*("text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)))
    stats = stored(document_statistics(plain), "statistics")
    key = next(n for n, c in back.items() if c == "doc_id")
    model = fit(stats, _labelled(stats, key, labels, folds, held))
    schema = stats.drop("stats").schema.add("score", "double")

    def run(batches):
        for batch in batches:
            scores = model.score(_matrix(batch)) if batch.num_rows else np.zeros(0)
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*names, "score"])

    scored = stats.mapInArrow(run, schema)
    return scored.select(
        *(F.col(n).alias(c) for n, c in back.items()),
        (fold(F.col(key), folds) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
