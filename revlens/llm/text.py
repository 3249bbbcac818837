"""Byte-level word splitting and hashing, vectorised over a batch of texts.

Words are maximal runs of word bytes in the UTF-8 form of a text.  Both word
definitions used here treat every byte of a non-ASCII character as a word
byte, so working on bytes gives exactly the words of the characters.

Word and shingle hashes are 64-bit and depend on the bytes alone, not on the
process, so executors agree on them.  Two different shingles of one corpus
share a hash with a probability of about (number of shingles)^2 / 2^65.
"""

from __future__ import annotations

import numpy as np

#: Texts are hashed in joined pieces of about this many bytes.
PIECE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Words between ASCII white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: ASCII letters, digits and all non-ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
#: (applied after lower-casing)
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + (PIECE >> 2))
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that all bits of a hash are usable."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans(buf: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes in ``buf``."""
    mask = np.zeros(len(buf) + 2, dtype=np.int8)
    mask[1:-1] = word[buf]
    edge = np.diff(mask)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def _parts(texts: list[bytes], word: np.ndarray):
    """(text number, bytes); a text over PIECE bytes is cut between words."""
    for i, t in enumerate(texts):
        while len(t) > PIECE:
            free = np.flatnonzero(~word[_LOWER[np.frombuffer(t, np.uint8, offset=PIECE)]])
            if not len(free):
                break
            cut = PIECE + int(free[0])
            yield i, t[:cut]
            t = t[cut:]
        yield i, t


def _pieces(texts: list[bytes], word: np.ndarray):
    """Lists of parts of about PIECE bytes together."""
    held, size = [], 0
    for part in _parts(texts, word):
        if held and size + len(part[1]) > PIECE:
            yield held
            held, size = [], 0
        held.append(part)
        size += len(part[1])
    if held:
        yield held


def hashed_words(texts: list[bytes], word: np.ndarray, lower: bool,
                 ending: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the words of each text
    as offsets: text i has hashes[offsets[i]:offsets[i + 1]].  With ``ending``
    the top 5 bits of a hash depend on the word's last two bytes alone."""
    counts = np.zeros(len(texts), dtype=np.int64)
    found = [np.zeros(0, dtype=np.uint64)]
    for parts in _pieces(texts, word):
        buf = np.frombuffer(b" ".join(t for _, t in parts), dtype=np.uint8)
        if lower:
            buf = _LOWER[buf]
        starts, ends = spans(buf, word)
        hashes = _hash_spans(buf, starts, ends)
        if ending:
            pair = buf[ends - 1].astype(np.uint64) + (buf[np.maximum(ends - 2, starts)].astype(np.uint64) << np.uint64(8))
            top = np.uint64(59)
            hashes = (hashes >> np.uint64(5)) | (mix(pair) >> top << top)
        found.append(hashes)
        lengths = np.fromiter((len(t) for _, t in parts), np.int64, len(parts))
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        np.add.at(counts, [i for i, _ in parts], np.diff(np.searchsorted(starts, begins)))
    return np.concatenate(found), np.concatenate([[0], np.cumsum(counts)])


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words; all words as one if they are fewer."""
    if len(words) == 0:
        return np.zeros(0, dtype=np.uint64)
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        h = (h + words[i: len(words) - n + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return mix(h + np.uint64(n))


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes, NULL as empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
