"""Texts of an Arrow column as arrays of code points, and back."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that are worked on at once.
_BYTES = 1 << 21


def slices(batch: pa.RecordBatch, column: int, most: int = _BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``most`` bytes of text, a longer text alone."""
    sizes = _bytes(batch.column(column))
    at = 0
    ends = np.cumsum(sizes)
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def gathered(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in parts of about ``most`` bytes of text, a longer text alone."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, most):
            own = int(_bytes(part.column(column)).sum())
            if held and size + own > most:
                yield _one(held)
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    return pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns], names=table.schema.names)


def _bytes(texts: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(texts.type)
    return np.diff(np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64))


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all ``texts`` (none null) end to end, and how many each has."""
    if not len(texts):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    try:
        whole = raw.tobytes().decode("utf-8")
    except UnicodeDecodeError:  # bytes that are no text are replaced, as the JVM does
        own = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets - offsets[0], offsets[1:] - offsets[0])]
        return np.frombuffer("".join(own).encode("utf-32-le"), np.uint32), np.array([len(t) for t in own], np.int64)
    begun = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return np.frombuffer(whole.encode("utf-32-le"), np.uint32), np.diff(begun[offsets - offsets[0]])


def gram_keys(codes: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """One integer for the up to ``n`` (at most 3) characters from each position to its
    text's end; integers sort as the grams do."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    keys = np.zeros(len(codes), np.int64)
    for k in range(n):
        keys <<= 21
        keys[:len(codes) - k] |= np.where(left > k, np.r_[codes[k:], np.zeros(k, codes.dtype)].astype(np.int64) + 1, 0)[:len(codes) - k]
    return keys


def grams_of(keys: np.ndarray, n: int) -> pa.Array:
    """The texts of :func:`gram_keys`."""
    mask = (1 << 21) - 1
    parts = [[chr(c - 1) if c else "" for c in ((keys >> (21 * (n - 1 - k))) & mask).tolist()] for k in range(n)]
    return pa.array(["".join(g) for g in zip(*parts)], pa.string())


def texts_of(codes: np.ndarray) -> pa.Array:
    """One text of one character per code point."""
    if not len(codes):
        return pa.array([], pa.string())
    used = np.flatnonzero(np.bincount(codes))
    place = np.zeros(int(used[-1]) + 1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    return pa.array([chr(c) for c in used.tolist()], pa.string()).take(pa.array(place[codes]))
