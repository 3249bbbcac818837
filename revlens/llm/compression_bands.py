"""Quality rules by compression: zstandard ratios of the whole document and
of fixed chunks must lie in a band that depends on the document's length.

Repetitive text compresses far better than prose and leaves the band at the
top; encoded or random text hardly compresses and leaves it at the bottom.
Short texts compress badly whatever they hold, so every length class has
limits of its own, and so have its chunks, which are shorter in shorter texts.
The last chunk ends with the text and overlaps the one before it, so every byte
of a text that has chunks is judged in a chunk of full length.

One pass without a shuffle; each task holds one Arrow batch.  NULL and empty
texts have no words and fail the base rule.  Repeated rows are judged one by
one.  Only ``doc_id`` and ``text`` of the input are used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revlens.llm.text import SPACED, hashed_words, shingles, utf8

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Ratios (bytes / compressed bytes) allowed below a length in bytes, for the
    text and for its chunks of ``chunk`` bytes (0: the text is not cut)."""

    below: int
    low: float
    high: float
    chunk: int = 0
    chunk_low: float = 0.0
    chunk_high: float = 0.0


#: Limits by length of the whole text.
DOCUMENT_BANDS = (
    Band(512, 0.90, 2.60),
    Band(1_024, 1.30, 2.80),
    Band(4_096, 1.45, 3.20, 1_024, 1.45, 3.50),
    Band(16_384, 1.60, 3.70, 2_048, 1.60, 4.50),
    Band(1 << 62, 1.70, 4.20, 4_096, 1.70, 6.00),
)
#: Share of a text's chunks that may break their limits.
CHUNK_SHARE = 0.1
LEVEL = 3

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, ratio double, "
    "n_chunks long, n_bad_chunks long, verdict string"
)


def repeated_words(words: np.ndarray, n: int = 3) -> int:
    """Words covered by n-word windows that occur at least twice."""
    if len(words) <= n:
        return 0
    windows = shingles(words, n)
    _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[where] > 1
    cover = np.zeros(len(words), dtype=bool)
    for i in range(n):
        cover[i: i + len(windows)] |= again
    return int(cover.sum())


def base_statistics(raw: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    buf = np.frombuffer(raw, dtype=np.uint8)
    chars = int((((buf & 0xC0) != 0x80) & SPACED[buf]).sum())
    symbols = sum(raw.count(SYMBOLS[i: i + 1]) for i in range(len(SYMBOLS)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def band_verdict(raw: bytes, packer, bands=DOCUMENT_BANDS, share=CHUNK_SHARE) -> tuple[float, int, int, str]:
    """Ratio of the whole, chunks, chunks outside their limits, verdict."""
    if not raw:
        return 0.0, 0, 0, "empty"
    ratio = len(raw) / len(packer.compress(raw))
    band = next(b for b in bands if len(raw) < b.below)
    starts = []
    if 0 < band.chunk < len(raw):
        starts = [*range(0, len(raw) - band.chunk, band.chunk), len(raw) - band.chunk]
    bad = sum(not band.chunk_low <= band.chunk / len(packer.compress(raw[i: i + band.chunk])) <= band.chunk_high
              for i in starts)
    if ratio > band.high:
        return ratio, len(starts), bad, "repetitive"
    if ratio < band.low:
        return ratio, len(starts), bad, "incompressible"
    if bad > share * len(starts):
        return ratio, len(starts), bad, "chunks"
    return ratio, len(starts), bad, "pass"


def compression_bands(docs: DataFrame, bands=DOCUMENT_BANDS, share: float = CHUNK_SHARE,
                      level: int = LEVEL) -> DataFrame:
    """Base statistics and the compression verdict of every document."""

    def judge(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
        for batch in batches:
            texts = utf8(batch.column("text"))
            hashes, at = hashed_words(texts, SPACED, lower=False)
            rows = []
            for i, raw in enumerate(texts):
                n, chars, symbols, dup, rep = base_statistics(raw, hashes[at[i]: at[i + 1]])
                failed = n < 50 or 100 * rep > 50 * n
                ratio, chunks, bad, verdict = band_verdict(raw, packer, bands, share)
                rows.append((n, chars, symbols, dup, rep, failed,
                             not failed and verdict == "pass", ratio, chunks, bad, verdict))
            columns = list(zip(*rows)) or [()] * 11
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(judge, SCHEMA)
