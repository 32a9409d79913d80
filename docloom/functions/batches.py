"""Arrow batches of texts in pieces that a Python worker holds at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 4 << 20  # of text; a longer text is a piece of its own


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of texts of at most ``limit`` bytes, or of one text."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < len(ends):
        to = max(int(np.searchsorted(ends, done + limit, "right")), at + 1)
        yield at, to - at
        at, done = to, int(ends[to - 1])


def bounded(parts: Iterable[pa.RecordBatch], column: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts in a column hold at most ``limit`` bytes, or are one text: what is made of a batch does not grow with its rows."""
    for part in parts:
        for at, n in pieces(part.column(column), limit):
            yield part.slice(at, n)
