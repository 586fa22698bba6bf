"""Whole texts as bytes: helpers that run inside tasks, over Arrow batches, without per-word Python.

A text column arrives as one byte buffer and row offsets. Words, shingles and their 64-bit hashes
are found for a whole slice of rows at once. Slices are bounded by bytes, not by rows, so memory
does not depend on how long the texts are (a single text is never cut).

Fixed rules: letters A-Z count as a-z; a word is a run of bytes other than space and 0x09-0x0D (in
UTF-8 these bytes stand only for themselves). A text with fewer words than a shingle has gives one
shingle, its whole word sequence; a null text or one without words gives none.

Hashes are 64 bits wide. With n different items in play, the chance that any two of them share a
hash is about n * n / 2**65: one in a thousand for 10**8 different shingles compared at once.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BLOCK = 1 << 16  # bytes whose terms of a hash are summed at once

U64 = np.uint64
_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[65:91] = _BYTE[97:123]
_POSITION = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LENGTH = U64(0xC2B2AE3D27D4EB4F)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base % (1 << 64), np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


# Powers of the hash base and of its inverse modulo 2**64 within a block; their number does not depend on the texts.
_LOW, _LOW_INVERSE = _powers(_BASE, BLOCK), _powers(_INVERSE, BLOCK)
_STEP, _STEP_INVERSE = pow(_BASE, BLOCK, 1 << 64), pow(_INVERSE, BLOCK, 1 << 64)


def _sums(data: np.ndarray, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums over i < p of table[data[i]] * base**i modulo 2**64, for each place p of ``at`` (ascending)."""
    out = np.empty(len(at), np.uint64)
    carried = U64(0)
    step = 1
    edges_ = np.searchsorted(at, np.arange(0, len(data) + BLOCK + 1, BLOCK))
    total = np.empty(BLOCK + 1, np.uint64)
    for i, first in enumerate(range(0, len(data) + 1, BLOCK)):
        part = data[first : first + BLOCK]
        sums = total[: len(part) + 1]
        sums[0] = carried
        np.multiply(table[part], _LOW[: len(part)], out=sums[1:])
        sums[1:] *= U64(step)
        np.cumsum(sums, out=sums)
        a, b = edges_[i], edges_[i + 1]
        out[a:b] = sums[at[a:b] - first]
        carried = sums[-1]
        step = step * _STEP % (1 << 64)
    return out


def span_sums(data: np.ndarray, table: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each byte span, the sum of table[byte] * base**(place in the span) modulo 2**64."""
    places = np.concatenate([begins, ends])
    order = np.argsort(places, kind="stable")
    sums = np.empty(len(places), np.uint64)
    sums[order] = _sums(data, table, places[order])
    back = _LOW_INVERSE[begins & (BLOCK - 1)]
    high = begins >> (BLOCK.bit_length() - 1)
    if len(high):
        back *= _powers(_STEP_INVERSE, int(high.max()) + 1)[high]
    return (sums[len(begins) :] - sums[: len(begins)]) * back


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # not glibc
    def _trim(_):
        return 0


def give_back() -> None:
    """Return freed memory to the system: a worker lives on, and idle ones would add up."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Parts of a batch whose texts together hold about ``limit`` bytes; no copy is made."""
    offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))[1]
    first, n = 0, batch.num_rows
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n, first + 65536)
        yield batch.slice(first, last - first)
        first = last
    give_back()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and n + 1 offsets into them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; no run reaches past a row."""
    n = len(inside)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte span, with A-Z as a-z; equal spans have equal hashes wherever they lie."""
    h = span_sums(data, _BYTE, begins, ends)
    return mix(h + (ends - begins).astype(np.uint64) * _LENGTH)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each row the place of its first word (n + 1 places)."""
    begins, ends = edges(~SPACE[data], offsets)
    return span_hashes(data, begins, ends), np.searchsorted(begins, offsets)


def shingles(word: np.ndarray, first: np.ndarray, k: int, whole_if_short: bool = True):
    """Hashes of k consecutive words, in text order with repeats, and their first places per row."""
    counts = np.diff(first)
    per_row = np.where(counts >= k, counts - k + 1, (counts > 0) & whole_if_short)
    places = np.zeros(len(first), np.int64)
    np.cumsum(per_row, out=places[1:])
    start = np.repeat(first[:-1], per_row) + np.arange(places[-1]) - np.repeat(places[:-1], per_row)
    left = np.repeat(first[1:], per_row) - start
    total = np.zeros(len(start), np.uint64)
    padded = np.concatenate([word, np.zeros(k, np.uint64)])
    for j in range(k):
        total += np.where(left > j, padded[start + j] * _POSITION[j], U64(0))
    return mix(total + np.minimum(left, k).astype(np.uint64) * _LENGTH), places


def distinct(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of each row, sorted, and their first places per row."""
    values = values.copy()
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    starts = places[:-1][places[:-1] < places[1:]]
    keep[starts] = True
    kept = np.zeros(len(values) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return values[keep], kept[places]


def shingle_sets(column: pa.Array, k: int, whole_if_short: bool = True):
    """The set of k-word shingle hashes of each text of a column."""
    data, offsets = text_buffer(column)
    return distinct(*shingles(*words(data, offsets), k, whole_if_short))


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0] .. starts[0] + lengths[0] - 1, then those of the next range, and so on."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
