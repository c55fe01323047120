"""Sets of word shingles: their fingerprints, and exact Jaccard similarity.

A text's set is the 64-bit hashes of its lower-cased (A-Z) word shingles.  Its parity map says of each slot whether an
odd number of hashes fall into it: where the maps of two sets differ, a hash is in one set only, so the differing slots
are at most the hashes that the sets don't share, and ``may_be_alike`` drops no pair that is alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkernel import LOWER_BYTE, U64, chunks, mix, prefix_sums, run_hashes, split_words, word_hashes

_ROWS = 2048
#: Slots of a parity map, powers of two: as many as the set has hashes or more, up to the most (2 KB).
LEAST_SLOTS, MOST_SLOTS = 512, 1 << 14
_MAP_BLOCK = 1 << 20
#: The eight bits of each byte.
_BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :] & 1).astype(np.float64)


def _sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, each row's in order, and where each row begins; fewer than k words are one."""
    data = LOWER_BYTE[data]
    starts, ends, at = split_words(data, offs)
    if not starts.size:
        return np.zeros(0, U64), np.zeros(offs.size, np.int64)
    words = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(offs.size - 1), np.diff(at))
    first, last = at[row], at[row + 1]
    pos = np.arange(starts.size)
    ok = (pos + k <= last) | (pos == first)
    pos, row = pos[ok], row[ok]
    h = run_hashes(words, pos, np.minimum(pos + k, last[ok]), prefix_sums(words))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(h.size, bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(offs.size))


def _node(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's set; 0 for the empty set."""
    return np.where(np.diff(at) > 0, run_hashes(h, at[:-1], at[1:]) | U64(1), U64(0)) if h.size else np.zeros(at.size - 1, U64)


def set_fingerprints(h: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """rows x words: a bit is set if it is set in over half of a set's hashes; zero for the empty set.

    The later words take mixed hashes.  Bits are counted by bytes: how often each value of each byte occurs in a row.
    """
    out = np.zeros((at.size - 1, words * 8), np.uint8)
    for low in range(0, at.size - 1, _ROWS):
        edges = at[low : low + _ROWS + 1]
        part, size = h[edges[0] : edges[-1]], np.diff(edges)
        row = np.repeat(np.arange(size.size) << 8, size)
        for w in range(words):
            for k, byte in enumerate(part.view(np.uint8).reshape(-1, 8).T):
                counts = np.bincount(row + byte, minlength=size.size << 8).reshape(-1, 256) @ _BITS
                out[low : low + size.size, 8 * w + k] = np.packbits(2 * counts > size[:, None], axis=1, bitorder="little")[:, 0]
            part = mix(part + U64(0x9E3779B97F4A7C15))
    return out.view(U64)


def parity_maps(h: np.ndarray, at: np.ndarray) -> pa.Array:
    """Each row's parity map; a map of half the slots is the exclusive or of the two halves."""
    size = np.diff(at)
    slots = np.clip(1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), LEAST_SLOTS, MOST_SLOTS)
    begin = np.concatenate([[0], np.cumsum(slots)])
    row = np.repeat(np.arange(size.size), size)
    odd = np.bincount(begin[row] + (h & (slots[row] - 1).astype(U64)).astype(np.int64), minlength=begin[-1]) & 1
    data = np.packbits(odd.astype(bool), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), size.size, [None, pa.py_buffer((begin >> 3).astype(np.int32)), pa.py_buffer(data)])


def may_be_alike(u: np.ndarray, v: np.ndarray, size: np.ndarray, maps: tuple[np.ndarray, np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """Of pairs of rows u, v: whether their sets' sizes and parity maps allow the similarity.

    maps: all maps' 64-bit words, and where each row's begin and how many there are.
    """
    words, begin, width = maps
    least, both = np.minimum(size[u], size[v]), size[u] + size[v]
    ok = least >= similarity * (both - least)
    most = both * ((1 - similarity) / (1 + similarity)) + 1e-6
    narrow = np.minimum(width[u], width[v])
    for w in np.unique(narrow[ok]):
        here = np.flatnonzero(ok & (narrow == w))
        for i in range(0, here.size, max(1, _MAP_BLOCK // int(w))):
            k = here[i : i + max(1, _MAP_BLOCK // int(w))]
            x = np.zeros((k.size, int(w)), U64)
            for side in (u[k], v[k]):
                for fold in range(int((width[side] // w).max())):
                    wide = np.flatnonzero(width[side] > fold * w)
                    x[wide] ^= words[begin[side[wide], None] + fold * w + np.arange(w)]
            ok[k] = np.bitwise_count(x).sum(1) <= most[k]
    return ok


def fingerprint_rows(k: int, words: int) -> Callable:
    """id, digest, text -> id, digest, node, f0, f1, ..., size, map; node: a hash of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in chunks(batch.column("text")):
                h, at = _sets(data, offs, k)
                marks = set_fingerprints(h, at, words).view(np.int64)
                part = batch.slice(a, b - a)
                cols = [pa.array(np.ascontiguousarray(marks[:, w])) for w in range(words)]
                cols += [pa.array(np.diff(at)), parity_maps(h, at)]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("digest"), pa.array(_node(h, at).view(np.int64)), *cols], ["id", "digest", "node", *[f"f{w}" for w in range(words)], "size", "map"])

    return run


def set_rows(k: int) -> Callable:
    """text -> node, set"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in chunks(batch.column("text")):
                h, at = _sets(data, offs, k)
                sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_node(h, at).view(np.int64)), sets], ["node", "set"])

    return run


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of pairs u, v those whose sets have the similarity; sets: node, set."""
    one = sets.select(F.col("node").alias("u"), F.col("set").alias("a"))
    two = sets.select(F.col("node").alias("v"), F.col("set").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    sizes = F.least(F.size("a"), F.size("b")) >= similarity * F.greatest(F.size("a"), F.size("b"))
    return pairs.join(one, "u").join(two, "v").where(sizes).where(both / (F.size("a") + F.size("b") - both) >= similarity).select("u", "v")
