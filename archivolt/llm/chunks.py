"""Distinct-chunk tables: texts are cut where no token can cross, and each distinct chunk is tokenised once.

A table belongs to a Python worker and outlives its batches. It has a bound on its entries and starts anew beyond it,
which costs time and changes no result, so its memory is bounded whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Entries of a worker's table, of some 300 bytes each.
TABLE_ENTRIES = 500_000


def distinct_chunks(data: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct chunks of ``data``, which ``starts`` cuts without gaps, and for each chunk its place among them."""
    if not len(starts):
        return [], np.zeros(0, np.int64)
    offsets = np.append(starts, len(data)).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    encoded = whole.dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False)


class ChunkTable:
    """From a chunk's bytes to columns of values; ``encode`` gives them for a list of new chunks."""

    def __init__(self, encode: Callable[[list[bytes]], list[tuple]], width: int, limit: int = TABLE_ENTRIES):
        self.encode, self.width, self.limit = encode, width, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.columns: list[list] = [[] for _ in range(self.width)]

    def columns_of(self, chunks: list[bytes]) -> list[list]:
        """For each column, the values of the given distinct chunks."""
        if len(self.place) + len(chunks) > self.limit:
            self.clear()
        get = self.place.get
        at = [get(c, -1) for c in chunks]
        new = [c for c, i in zip(chunks, at, strict=True) if i < 0]
        if new:
            base = len(self.place)
            self.place.update(zip(new, range(base, base + len(new)), strict=True))
            for own, values in zip(self.columns, zip(*self.encode(new), strict=True), strict=True):
                own.extend(values)
            at = [self.place[c] for c in chunks]
        return [[own[i] for i in at] for own in self.columns]
