"""Arrow helpers shared by the text operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[9:14] = 32


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one piece holds about `limit` bytes of
    `column` (a longer single row is its own piece); rows are never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size.astype(np.int64)) // limit
        starts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:]):
            yield batch.slice(a, b - a)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words `[^ \\t-\\r]+` of the A-Z-lower-cased texts (null: none).

    Returns (offsets, codes, words): text i has the words
    words[codes[offsets[i]:offsets[i + 1]]], in order."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    # one byte map lower-cases A-Z and makes every white space a blank; no byte of a longer character is touched
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    plain = _BYTES[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if len(texts) and data is not None else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0] if len(texts) else ends), pa.py_buffer(plain))
    lists = pc.split_pattern(plain, " ")
    flat, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
    coded = flat.filter(full).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return kept[np.r_[0, ends].astype(np.int64)], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + lengths[i] - 1, for all i in turn."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
