"""64-bit hashes of a text's words, with each worker remembering the words it met."""

from __future__ import annotations

import numpy as np
import xxhash

# Lower case of A-Z alone.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_REMEMBERED = 300_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _Hashes()


def forget() -> None:
    """Free what is remembered: idle workers keep their memory, next to others at work."""
    _HASHES.clear()


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text, in order; words end at ASCII white space."""
    if len(_HASHES) > _REMEMBERED:
        _HASHES.clear()
    words = text.encode().translate(_LOWER).split()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
