"""Duplicates: first seen over an order, and suppression for a time to live."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.tables import written


def first_seen(df: DataFrame, key: Column, order: list[Column], place: Column) -> DataFrame:
    """``df`` with is_duplicate and first_place: where the key's first row by ``order`` stands.

    The first place is an aggregate joined back, so that a key that most rows share costs no single task.
    """
    rows = df.withColumns({"_key": key, "_order": F.struct(*order), "_place": place})
    first = rows.groupBy("_key").agg(F.min(F.struct("_order", "_place")).alias("_first"))
    joined = rows.join(first, rows["_key"].eqNullSafe(first["_key"])).drop(first["_key"])
    return joined.withColumns({"is_duplicate": F.struct("_order", "_place") != F.col("_first"), "first_place": F.col("_first._place")}).drop("_key", "_order", "_place", "_first")


#: A piece's map from the last time kept before it to the last time kept in it is sent in rows of so many steps.
STEPS_A_ROW = 50_000


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int]]:
    """key, first row and end of each run of equal keys."""
    runs, low = pc.run_end_encode(batch.column("_key")), 0
    for key, high in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
        yield key, low, high
        low = high


def step_map(at: np.ndarray, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted times: (upto, last): if the first row that may be kept is the first of a time up to ``upto``, ``last`` is kept last.

    Only rows that some time kept before could leave to be first count: those within ``ttl`` of the first, and the next.
    Which row follows which is found for all rows at once, and followed by doubling.  Rows of one outcome are one step.
    """
    n = at.size
    follows = np.append(np.searchsorted(at, at + ttl), n)
    last = np.arange(n + 1)
    while (open_ := np.flatnonzero(follows[:n] < n)).size:
        last[open_] = last[follows[open_]]
        follows[:n] = follows[follows[:n]]
    starts = at[: min(n, int(np.searchsorted(at, at[0] + ttl)) + 1)]
    ends = at[last[: starts.size]]
    change = np.append(np.flatnonzero((ends[1:] != ends[:-1])), starts.size - 1)
    return starts[change], ends[change]


def _edge_maps(ttl: int):
    """Pieces of sorted rows -> maps of the first and the last key of each, which other pieces may share."""
    names = ["_key", "first_at", "part", "upto", "last"]

    def rows(key: str, times: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        upto, last = step_map(np.unique(np.concatenate(times)), ttl)
        low = int(times[0][0])
        for part, i in enumerate(range(0, upto.size, STEPS_A_ROW)):
            lists = [pa.array([x[i : i + STEPS_A_ROW]], pa.list_(pa.int64())) for x in (upto, last)]
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([low]), pa.array([part], pa.int32()), *lists], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, key, times, first = None, None, [], False
        for batch in batches:
            at, of = batch.column("_at").to_numpy(), batch.column("_piece").to_pylist()
            cuts = [0, *[i for i in range(1, len(of)) if of[i] != of[i - 1]], len(of)] if len(of) and of[0] != of[-1] else [0, len(of)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if of[a] != piece:
                    if times:
                        yield from rows(key, times)
                    piece, key, times, first = of[a], None, [], True
                for k, low, high in _runs(batch.slice(a, b - a)):
                    if k != key:
                        if times and first:
                            yield from rows(key, times)
                        first, key, times = key is None, k, []
                    times.append(np.unique(at[a + low : a + high]))
        if times:
            yield from rows(key, times)

    return run


def _carried(ttl: int):
    """Maps by key and time -> key, first_at and the last time kept before, for each piece but a key's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, piece, kept, found = None, None, None, False
        for batch in batches:
            out: list[tuple[str, int, int]] = []
            for k, first_at, upto, last in zip(*(batch.column(c) for c in ("_key", "first_at", "upto", "last"))):
                k, first_at = k.as_py(), first_at.as_py()
                if k != key:
                    key, piece, kept, found = k, None, None, False
                if first_at != piece:
                    if kept is not None:
                        out.append((key, first_at, kept))
                    piece, found = first_at, False
                if not found:
                    step = int(np.searchsorted(upto.values.to_numpy(), first_at if kept is None else kept + ttl))
                    if step < len(upto.values):
                        kept, found = last.values[step].as_py(), True
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["_key", "first_at", "kept"])

    return run


def _kept_rows(ttl: int, carried):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last_piece, last_key, last_at = carried.value, None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            all_at, of = batch.column("_at").to_numpy(), batch.column("_piece").to_pylist()
            keep = []
            for key, low, high in _runs(batch):
                while low < high:  # a key's rows of one piece
                    end = high if of[high - 1] == of[low] else next(i for i in range(low, high) if of[i] != of[low])
                    at, i = all_at[low:end], 0
                    if key != last_key or of[low] != last_piece:
                        last_key, last_piece = key, of[low]
                        if (kept := before.get((key, int(at[0])))) is not None:
                            i = int(np.searchsorted(at, kept + ttl))
                    else:
                        i = int(np.searchsorted(at, last_at + ttl))
                    while i < at.size:
                        keep.append(low + i)
                        last_at = int(at[i])
                        i = int(np.searchsorted(at, last_at + ttl))
                    low = end
            yield batch.select(["_row"]).take(pa.array(keep, pa.int64()))

    return run


def ttl_dedupe(events: DataFrame, key: str, ts: str, ttl_seconds: int) -> DataFrame:
    """Rows that are kept if a key is suppressed for ``ttl_seconds`` from its last kept row, which a repeat doesn't renew.

    Whether a row is kept depends on which was kept before, so this is a scan, done in parallel: rows are dealt out by
    ranges of key and time, and a key that has most rows lies in many pieces.  A piece gives the map from the last time
    kept before it to the last time kept in it; the maps of a key are applied one after another, and each piece then
    keeps its rows from the time that was carried to it.  A piece sends maps of its first and its last key, so the times
    carried are two a piece at most.

    Rows of one key and time are one before they are dealt out, the least by its columns in order.  Null keys and null
    times are never suppressed.
    """
    ttl = max(ttl_seconds * 1_000_000, 1)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = events.select(F.col(key).cast("string").alias("_key"), at.alias("_at"), F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("_row"))
    known = rows.where("_key is not null and _at is not null").groupBy("_key", "_at").agg(F.min("_row").alias("_row"))
    dealt = written(known.repartitionByRange("_key", "_at").sortWithinPartitions("_key", "_at"), "ttl-ranges")
    # a file is read in blocks, each of which is in order
    piece = F.concat_ws("|", F.input_file_name(), F.input_file_block_start().cast("string"))
    dealt = dealt.withColumn("_piece", piece)
    maps = dealt.select("_key", "_at", "_piece").mapInArrow(_edge_maps(ttl), "_key string, first_at long, part int, upto array<long>, last array<long>")
    in_order = maps.repartition("_key").sortWithinPartitions("_key", "first_at", "part")
    carried = {(r[0], r[1]): r[2] for r in in_order.mapInArrow(_carried(ttl), "_key string, first_at long, kept long").collect()}
    shared = events.sparkSession.sparkContext.broadcast(carried)
    kept = dealt.mapInArrow(_kept_rows(ttl, shared), dealt.select("_row").schema)
    return kept.select("_row.*").unionByName(rows.where("_key is null or _at is null").select("_row.*"))
