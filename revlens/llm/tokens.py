"""Token ids of whole texts by a public BPE vocabulary, word by word.

For a vocabulary that drops white space, the ids of a text are the ids of its
space-separated words one after another, so each distinct word is encoded
once per worker and then looked up.  ``tests/llm`` compares this with the
library's own encoding of whole texts.

The vocabulary file's path is a parameter; the file must exist on every
executor.
"""

from __future__ import annotations

import functools
import struct

import numpy as np

#: Distinct words kept by a worker; the store starts afresh beyond it.
REMEMBERED = 1_500_000

#: ASCII punctuation that never joins with a letter before it.
_PUNCT = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes
    that print stand for themselves, the rest follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    extra = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(extra)) for b in range(256)]


#: The same by the character of each byte in Latin-1, for str.translate.
_SYMBOLS = dict(enumerate(_byte_symbols()))


class WordEncoder(dict):
    """word bytes -> its ids as little-endian unsigned integers."""

    def __init__(self, path: str, width: str = "<u2"):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if self.tokenizer.get_vocab_size() > 1 << (8 * int(width[-1])):
            raise ValueError(f"ids of {path} do not fit {width}")
        self.pack = [struct.Struct(f"<{n}{np.dtype(width).char}").pack for n in range(17)]
        self.width = np.dtype(width)

    def _packed(self, ids: list[int]) -> bytes:
        if len(ids) < len(self.pack):
            return self.pack[len(ids)](*ids)
        return np.array(ids, self.width).tobytes()

    def _encoded(self, word: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _ids(self, word: bytes) -> bytes:
        # Lower-case Latin letters are one piece that no normaliser changes.
        if word.isalpha():
            return self._packed([t.id for t in self.model.tokenize(word.decode("ascii"))])
        text = word.decode("utf-8", "replace")
        if text.isalpha() and text == text.lower() and max(text) < "ɐ":
            return self._packed([t.id for t in self.model.tokenize(word.decode("latin-1").translate(_SYMBOLS))])
        return self._encoded(word)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        if word.isalpha():
            low = word.lower()
            found = self._ids(word) if low == word else self[low]
        elif b"<|" in word or b"'" in word:
            found = self._encoded(word)
        else:
            low = word.lower()
            core = low.rstrip(_PUNCT)
            if core and len(core) < len(low) and core[-1:].isalnum():
                found = self[core] + self[low[len(core):]]
            elif low != word:
                found = self[low]
            else:
                found = self._ids(word)
        if len(word) <= 64:
            self[word] = found
        return found

    def encode(self, raw: bytes) -> bytes:
        """Ids of a whole text, as bytes."""
        return b"".join(map(self.__getitem__, raw.split()))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per vocabulary and worker process."""
    return WordEncoder(path)
