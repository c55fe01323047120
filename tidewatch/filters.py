"""Bit filters of 64-bit keys: what doesn't pass is not among the keys.  Their size is bounded whatever the number of keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Bits of a filter at most: 64 MB.
MOST_BITS = 1 << 29
_PAGE = 1 << 16


def _second(keys: np.ndarray) -> np.ndarray:
    """Another hash of hashes."""
    x = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return keys & np.uint64(size - 1), _second(keys) & np.uint64(size - 1)


def key_filter(keys: DataFrame, n: int) -> Broadcast:
    """A broadcast filter of the ``n`` longs in the one column of ``keys``; tasks fill pages of 8 KB, the driver lays them out."""
    size = 1 << min(MOST_BITS.bit_length() - 1, max(_PAGE.bit_length() - 1, (16 * n).bit_length()))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.unique(np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), size))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both // _PAGE), pa.array((both % _PAGE).astype(np.int32))], ["page", "bit"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, np.ndarray] = {}
        for batch in batches:
            page, bit = batch.column("page").to_numpy(), batch.column("bit").to_numpy()
            for k in np.unique(page).tolist():
                mine.setdefault(k, np.zeros(_PAGE, bool))[bit[page == k]] = True
        for k, page in mine.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.packbits(page).tobytes()], pa.binary())], ["page", "bits"])

    got = keys.mapInArrow(bits, "page long, bit int").repartition("page").mapInArrow(pages, "page long, bits binary").toArrow()
    out = np.zeros((size // _PAGE, _PAGE // 8), np.uint8)
    for k, page in zip(got["page"].to_pylist(), got["bits"].to_pylist()):
        out[k] = np.frombuffer(page, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out.ravel())


def passing(rows: DataFrame, column: str, bits: Broadcast) -> DataFrame:
    """Rows whose key may be among the filter's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = bits.value
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for at in _places(batch.column(column).to_numpy().view(np.uint64), mine.size * 8):
                ok &= (mine[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0
            yield batch.filter(pa.array(ok))

    return rows.mapInArrow(run, rows.schema)
