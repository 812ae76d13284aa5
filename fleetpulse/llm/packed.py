"""Columns of numbers as bytes, for tasks that exchange long columns instead of single rows."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard


def planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes and so on, compressed: planes of few different bytes shrink well."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes())


def unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(size, -1).T.copy().view(dtype).ravel()


def steps(ordered: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers as planes of their differences."""
    return planes(np.diff(ordered, prepend=np.uint64(0)))


def unsteps(raw: bytes) -> np.ndarray:
    return np.cumsum(unplanes(raw, np.uint64), dtype=np.uint64)


def columns(table: pa.Table, **kinds) -> dict[str, np.ndarray]:
    """The named binary columns of all rows, each joined to one array; ``kinds`` gives their types,
    ``"steps"`` for ascending numbers."""
    out = {}
    for name, kind in kinds.items():
        parts = [unsteps(x) if kind == "steps" else unplanes(x, kind) for x in table[name].to_pylist() if x is not None]
        out[name] = np.concatenate(parts) if parts else np.zeros(0, np.uint64 if kind == "steps" else kind)
    return out


def slices(sorted_keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(key, slice) for each run of equal keys."""
    if len(sorted_keys):
        cuts = np.flatnonzero(np.diff(sorted_keys)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sorted_keys)]):
            yield int(sorted_keys[a]), slice(a, b)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def deal(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, by its high bits, so that hashes in order have their parts in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def give_back() -> None:
    """Return freed memory to the system: workers are reused, and several share an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts as one array, and where each starts (and the last ends); null is empty."""
    raw = column.cast(pa.large_binary())
    if raw.null_count:
        raw = raw.fill_null(b"")
    buffers = raw.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
