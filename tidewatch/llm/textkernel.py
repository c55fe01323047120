"""Words and their hashes over whole Arrow columns of text, in numpy, with memory bounded by blocks of words.

A word is a run of bytes other than white space (0x20, 0x09-0x0D).  Its 64-bit hash adds up its 8-byte blocks, each
mixed with its place, and mixes the sum with the length; words over ``LONG_WORD`` bytes take XXH64.  Nothing in it is
linear, so words of regular structure collide no oftener than any others.  Hashes of runs of words are polynomials over
word hashes, from prefix sums modulo 2**64, so that equal runs hash alike wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 16
LONG_WORD = 64
_WORD_BLOCK = 1 << 18
_SEED = 42
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

BLANK_BYTE = np.zeros(256, bool)
BLANK_BYTE[[0x20, *range(0x09, 0x0E)]] = True
LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    global _powers
    if _powers[0].size < n:
        size = 1 << int(n).bit_length()
        both = []
        for factor in (_BASE, _INVERSE):
            p = np.full(size, factor, U64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers = (both[0], both[1])
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all 64."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting: the hash table that numpy takes otherwise leaves the heap in pieces."""
    values = np.sort(values)
    new = np.ones(values.size, bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """first row, end row, bytes, offsets: consecutive rows of about ``most`` bytes; a longer text is alone."""
    if not len(column):
        return
    data, offs = text_buffer(column)
    at = 0
    while at < len(column):
        end = min(at + CHUNK_ROWS, max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1))
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def code_points(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the offsets of the rows in them."""
    lead = (data & 0xC0) != 0x80
    if lead.all():
        return data, offs
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(lead)])[offs]


def split_words(data: np.ndarray, offs: np.ndarray, blank: np.ndarray = BLANK_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each row's words begin (one more than rows); ``blank``: bytes between words."""
    n = data.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(offs.size, np.int64)
    word = ~blank[data]
    cut = offs[(offs > 0) & (offs < n)]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    before[cut] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[cut - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``; starts and ends in order."""
    out = np.empty(starts.size, U64)
    raw = np.concatenate([data, np.zeros(8, np.uint8)])
    at_byte = np.ndarray(data.size + 1, "<u8", raw, strides=(1,))  # the 8 bytes from any place on
    for i in range(0, starts.size, _WORD_BLOCK):
        s, size = starts[i : i + _WORD_BLOCK], ends[i : i + _WORD_BLOCK] - starts[i : i + _WORD_BLOCK]
        total = mix(at_byte[s] & _LOW_BYTES[np.minimum(size, 8)])
        live = np.flatnonzero((size > 8) & (size <= LONG_WORD))
        k = 1
        while live.size:
            block = at_byte[s[live] + 8 * k] & _LOW_BYTES[np.minimum(size[live] - 8 * k, 8)]
            total[live] += mix(block + U64(k * _BASE & (1 << 64) - 1))
            k += 1
            live = live[size[live] > 8 * k]
        total = mix(total + size.astype(U64) * U64(_BASE))
        for w in np.flatnonzero(size > LONG_WORD):
            total[w] = xxhash.xxh64_intdigest(raw[s[w] : s[w] + size[w]].data, _SEED)
        out[i : i + s.size] = total
    return out


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """Hash of each run ``hashes[start:end]``; ``sums``: what ``prefix_sums`` gave for ``hashes``."""
    if sums is None:
        sums = prefix_sums(hashes)
    _, q = powers(hashes.size + 1)
    return mix((sums[ends] - sums[starts]) * q[starts])


def prefix_sums(hashes: np.ndarray) -> np.ndarray:
    p, _ = powers(hashes.size + 1)
    sums = np.zeros(hashes.size + 1, U64)
    np.cumsum(hashes * p[: hashes.size], out=sums[1:])
    return sums
