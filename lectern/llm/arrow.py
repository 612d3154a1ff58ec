"""Arrow batches as NumPy arrays, and hashes of the words in them."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Space, and the control characters 9 to 13.
SPACES = (9, 10, 11, 12, 13, 32)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def worker_cache() -> types.ModuleType:
    """A place that outlives a task: what is set on it stays for the Python worker's next tasks."""
    return sys.modules.setdefault("lectern_worker_cache", types.ModuleType("lectern_worker_cache"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the len + 1 places where rows begin; a null counts as empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    starts = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[starts[0] : starts[-1]], starts - starts[0]


def row_groups(starts: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes each, or one longer row."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def long_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the hash's base and of its inverse modulo 2^64."""
    cache = worker_cache()
    have = getattr(cache, "powers", None)
    if have is None or len(have[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = 1 << max(21, int(n - 1).bit_length())
        have = tuple(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)]).cumprod(dtype=np.uint64) for base in (_BASE, inverse))
        cache.powers = have
    return have


def byte_codes(lower: bool = False) -> np.ndarray:
    """A fixed random 64-bit value for each byte; with ``lower``, A to Z have those of a to z."""
    codes = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A hash of data[first:last] for each pair, from one running sum over all bytes."""
    up, down = long_powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=total[1:])
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of each run of bytes that are no white space; no word goes over a row's end."""
    blank = np.zeros(256, bool)
    blank[list(SPACES)] = True
    inside = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(starts, first, "right") - 1


def ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places first[i], first[i] + 1, ... (sizes[i] of them), one range after the other."""
    total = int(sizes.sum())
    shift = np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    return np.arange(total, dtype=np.int64) + shift


def batches(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of the given columns in the schema's order and types."""
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for f in schema for x in [columns[f.name]]], schema=schema)
