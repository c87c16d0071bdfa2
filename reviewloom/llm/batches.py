"""Texts that arrive in Arrow batches, taken in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

SLICE_BYTES = 1_500_000


def slices(batches: Iterable[pa.Array], limit: int = SLICE_BYTES) -> Iterator[list[bytes | None]]:
    """The texts as UTF-8, in order, in lists of about ``limit`` bytes; a longer text ends its list."""
    held: list[bytes | None] = []
    size = 0
    for texts in batches:
        for scalar in texts.cast(pa.large_binary()):
            text = scalar.as_py()
            held.append(text)
            size += len(text) if text else 0
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held
