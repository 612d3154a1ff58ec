"""Arrow batches in pieces, so that a Python worker's memory does not follow the size of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

# Most bytes of a piece that is worked on at once; the work takes some twenty times as much memory.
PIECE_BYTES = 4 << 20


def pieces(batch: pa.RecordBatch, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in slices of at most ``size`` bytes or one larger row."""
    if batch.num_rows > 1 and batch.nbytes > size:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half), size)
        yield from pieces(batch.slice(half), size)
    elif batch.num_rows:
        yield batch
