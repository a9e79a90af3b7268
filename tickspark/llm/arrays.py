"""Texts of Arrow batches as numpy arrays: words, their hashes, and shingle sets.

A word is a maximal run of bytes other than space and 0x09-0x0D, with A-Z lower-cased.
Hashes have 64 bits and are the same in every task, so sets can be compared across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text turned into arrays at a time; a longer unbroken word is taken whole.
CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# Modular inverse of BASE (Newton's iteration doubles the right bits).
_inv = int(BASE)
for _ in range(6):
    _inv = _inv * (2 - int(BASE) * _inv) % (1 << 64)
BASE_INVERSE = np.uint64(_inv)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row boundaries (n + 1) and bytes of a string column; a null row is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return bounds, raw


def _word_hashes(raw: np.ndarray, starts_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some bytes and the words' starts. No word spans one of
    ``starts_row``."""
    low = _LOWER[raw]
    word = ~_SPACE[raw]
    cut = np.ones(len(raw) + 1, dtype=bool)  # a word may not continue over this position
    cut[1:-1] = ~word[:-1]
    cut[starts_row] = True
    first = np.flatnonzero(word & cut[:-1])
    cut[1:-1] = ~word[1:]
    cut[starts_row] = True
    cut[-1] = True
    end = np.flatnonzero(word & cut[1:]) + 1
    power = np.full(len(raw), BASE, dtype=np.uint64)
    if len(power):
        power[0] = 1
    np.multiply.accumulate(power, out=power)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])
    back = np.full(len(raw), BASE_INVERSE, dtype=np.uint64)
    if len(back):
        back[0] = 1
    np.multiply.accumulate(back, out=back)
    hashes = (total[end] - total[first]) * back[first] + (end - first).astype(np.uint64)
    return mix(hashes), first


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column in order, and each row's bounds in them."""
    bounds, raw = string_buffers(column)
    lo, hi = int(bounds[0]), int(bounds[-1])
    out, places = [], []
    at = lo
    while at < hi:
        to = min(hi, at + CHUNK_BYTES)
        while to < hi and not _SPACE[raw[to]] and to not in _row_at(bounds, to):
            step = np.flatnonzero(_SPACE[raw[to : to + 4096]])
            nxt = to + int(step[0]) if len(step) else min(hi, to + 4096)
            row = bounds[np.searchsorted(bounds, to)]
            to = min(nxt, int(row))
        inner = bounds[(bounds >= at) & (bounds < to)] - at
        hashes, first = _word_hashes(raw[at:to], inner)
        out.append(hashes)
        places.append(first + at)
        at = to
    hashes = np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
    where = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
    return hashes, np.searchsorted(where, bounds)


def _row_at(bounds: np.ndarray, at: int) -> tuple:
    i = int(np.searchsorted(bounds, at))
    return (at,) if i < len(bounds) and bounds[i] == at else ()


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``size`` words, repeats included, and the rows' bounds in
    them. A row of fewer words has its whole sequence as one shingle; one without words none."""
    lengths = np.diff(bounds)
    count = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    to = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(count)), count)
    start = bounds[:-1][row] + (np.arange(to[-1]) - to[:-1][row])
    have = np.minimum(lengths[row], size)
    total = have.astype(np.uint64)
    for k in range(size):
        inside = have > k
        at = np.where(inside, start + k, 0)
        part = words[at] if len(words) else np.zeros(0, dtype=np.uint64)
        turned = (part << np.uint64(7 * k + 1)) | (part >> np.uint64(63 - 7 * k))
        total = mix(total + np.where(inside, turned, np.uint64(0)))
    return total, to


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values, ascending, and the rows' bounds in them."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(len(bounds)))


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text has about ``most`` bytes; a longer row comes alone."""
    bounds, _ = string_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1
        to = min(batch.num_rows, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to
