"""Words of letters, digits and non-ASCII characters, in lower case, and their hashes."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import xxhash

# every other ASCII character separates; only A-Z change case
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' words, one after the other, and where each text's begin."""
    bounds = np.zeros(len(texts) + 1, np.int64)

    def each() -> Iterator[list[bytes]]:
        for i, text in enumerate(texts, 1):
            words = words_of(text)
            bounds[i] = bounds[i - 1] + len(words)
            yield words
    words = itertools.chain.from_iterable(each())
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64), bounds
