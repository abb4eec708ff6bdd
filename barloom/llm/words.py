"""Words and word shingles of Arrow text columns, vectorised over many documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text handled at once; one longer document is handled alone.
SLICE_BYTES = 1 << 20

SHINGLE = 5


def _table(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _table(11, 256)
_BASE, _NEXT, _M1, _M2 = (int(x) for x in _table(12, 4))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mixing of each number (multiply and shift, invertible for one salt)."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(32))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of `batch` with about `limit` bytes of text each."""
    if not batch.num_rows:
        return
    ends = flat(batch.column(batch.schema.get_field_index(column)))[1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words before each document) of all words `[^\\x20\\x09-\\x0D]+`."""
    word = ~_SPACE[data]
    starts_at = word.copy()
    starts_at[1:] &= ~word[:-1]
    ends_at = word.copy()
    ends_at[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    starts_at[inner] = word[inner]
    ends_at[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(starts_at)
    ends = np.flatnonzero(ends_at) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over random byte values, mixed with its length.

    All words come from one running sum over the bytes; the base is odd, so dividing by its
    power at a word's start is exact modulo 2**64.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    step = 1 << (len(data).bit_length() + 1) // 2
    turns = len(data) // step + 1
    power = np.outer(_powers(pow(_BASE, step, 2**64), turns), _powers(_BASE, step)).reshape(-1)[: len(data)]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * power, out=sums[1:])
    inverse = pow(_BASE, -1, 2**64)
    back = _powers(pow(inverse, step, 2**64), turns)[starts // step] * _powers(inverse, step)[starts % step]
    return mix((sums[ends] - sums[starts]) * back + (ends - starts).astype(np.uint64))


def lowered_words(column) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, words before each document) after lower-casing A-Z."""
    data, offsets = flat(column)
    data = _LOWER[data]
    starts, ends, before = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), before


def shingle_sets(column, size: int = SHINGLE) -> list[np.ndarray]:
    """Each document's set of `size`-word shingles as sorted 64-bit hashes.

    Fewer words give the whole sequence as one shingle, no words none.
    """
    words, before = lowered_words(column)
    grams = words.copy()
    for i in range(1, size):
        grams[: len(words) - i] = grams[: len(words) - i] * np.uint64(_NEXT) + words[i:]
    grams = mix(grams, size)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    whole = whole * np.uint64(_NEXT) + w
            out.append(mix(np.array([whole], dtype=np.uint64), b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
