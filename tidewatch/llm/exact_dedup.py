"""Exact deduplication by content sort.

Texts are normalised (A-Z lower-cased, null as empty), sorted inside each input partition so that equal texts of one
partition collapse to one representative before anything is shuffled, then range-partitioned by sampled splitters,
sorted externally, and neighbours compared in full.  A group of copies that holds a third of all rows therefore reaches
its range as one row per input partition.

Splitters are a 32-byte prefix with the text's digest, so that what sampling sends to the driver stays small even when
texts are long; rows that are equal share both, hence a range, and the sort inside the range is on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import lean, lower_ascii, materialize

PREFIX_BYTES = 32
_RUN_BITS = 33


def _starts(norm: pa.Array, last: pa.Scalar | None) -> np.ndarray:
    """Which rows differ from the row before them; ``last`` is the row before the batch."""
    first = np.ones(len(norm), bool)
    if len(norm) > 1:
        first[1:] = ~pc.equal(norm.slice(1), norm.slice(0, len(norm) - 1)).to_numpy(zero_copy_only=False)
    if last is not None and len(norm):
        first[0] = norm[0].as_buffer() != last.as_buffer()
    return first


def _local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one partition -> the same rows with a run number; the first row of a run has its size and text."""
    base = TaskContext.get().partitionId() << _RUN_BITS
    runs, last, held, names = -1, None, None, ["doc_id", "sha", "run", "n", "norm"]

    def rows(batch, take, run, n, with_text):
        at = pa.array(take)
        norm = batch.column("norm").take(at) if with_text else pa.nulls(len(take), pa.string())
        cols = [batch.column("doc_id").take(at), batch.column("sha").take(at), pa.array(base + run), n, norm]
        return pa.RecordBatch.from_arrays(cols, names)

    for batch in batches:
        if not batch.num_rows:
            continue
        norm = batch.column("norm")
        first = _starts(norm, last)
        last = norm[len(norm) - 1]
        run = runs + np.cumsum(first)
        runs = int(run[-1])
        at = np.flatnonzero(first)
        if (more := np.flatnonzero(~first)).size:
            yield rows(batch, more, run[more], pa.nulls(more.size, pa.int64()), False)
        ends = np.append(at, len(norm))
        if held is not None:
            held[2] += int(ends[0])
            if at.size:
                yield rows(held[0], np.array([0]), np.array([held[1]]), pa.array([held[2]], pa.int64()), True)
                held = None
        if at.size:
            size = np.diff(ends)
            if at.size > 1:
                yield rows(batch, at[:-1], run[at[:-1]], pa.array(size[:-1], pa.int64()), True)
            held = [batch.slice(int(at[-1]), 1), runs, int(size[-1])]
    if held is not None:
        yield rows(held[0], np.array([0]), np.array([held[1]]), pa.array([held[2]], pa.int64()), True)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted representatives of one range -> for each run its group's first run, id and size.

    One group's run numbers are held until it ends: at most one for each input partition.
    """
    last, open_runs, head, total = None, [], None, 0
    names = ["run", "keep_run", "keep_id", "group_size"]

    def close():
        run = np.concatenate(open_runs)
        fill = [pa.array(np.full(run.size, head[0])), pa.array([head[1]] * run.size, pa.int64()), pa.array(np.full(run.size, total))]
        return pa.RecordBatch.from_arrays([pa.array(run), *fill], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        norm, run, n = batch.column("norm"), batch.column("run").to_numpy(), batch.column("n").to_numpy()
        first = _starts(norm, last)
        last = norm[len(norm) - 1]
        at = np.flatnonzero(first)
        upto = int(at[0]) if at.size else len(norm)
        if upto:
            open_runs.append(run[:upto])
            total += int(n[:upto].sum())
        if not at.size:
            continue
        if open_runs:
            yield close()
        size = np.add.reduceat(n, at)
        if at.size > 1:
            whole = np.diff(at)
            lead = np.repeat(at[:-1], whole)
            end = int(at[-1])
            yield pa.RecordBatch.from_arrays([pa.array(run[at[0]:end]), pa.array(run[lead]), batch.column("doc_id").take(pa.array(lead)), pa.array(np.repeat(size[:-1], whole))], names)
        k = int(at[-1])
        open_runs, head, total = [run[k:]], (int(run[k]), batch.column("doc_id")[k].as_py()), int(size[-1])
    if open_runs:
        yield close()


def _first_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> the first row of each run of equal texts."""
    last = None
    for batch in batches:
        if batch.num_rows:
            norm = batch.column("norm")
            first = _starts(norm, last)
            last = norm[len(norm) - 1]
            yield batch.filter(pa.array(first))


def _order(keep: str):
    if keep not in ("max", "min"):
        raise ValueError("keep must be 'max' or 'min'")
    return F.col("doc_id").desc_nulls_last() if keep == "max" else F.col("doc_id").asc_nulls_last()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and are equal to empty ones.  Exactly one row of each group is kept, the one with the
    smallest (``keep='min'``) or largest id; null ids come last, and among rows that repeat an id an arbitrary one is
    kept.  An empty table gives no rows; other columns are ignored.
    """
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm")).withColumn("sha", F.unhex(F.sha2("norm", 256)))
    local = rows.sortWithinPartitions("norm", _order(keep)).mapInArrow(_local_runs, "doc_id long, sha binary, run long, n long, norm string")
    local = materialize(local, "exact-runs")
    heads = local.where("n is not null").select("norm", "run", "doc_id", "n", "sha")
    ranged = heads.repartitionByRange(F.substring("norm", 1, PREFIX_BYTES), F.col("sha")).drop("sha").sortWithinPartitions("norm", _order(keep), "run")
    groups = ranged.mapInArrow(_groups, "run long, keep_run long, keep_id long, group_size long")
    return local.select("doc_id", "sha", "run", F.col("n").isNotNull().alias("head")).join(groups, "run").select(
        "doc_id", "keep_id", "group_size", (F.col("head") & (F.col("run") == F.col("keep_run"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they are; which row stays is as in ``exact_groups``.

    Whole rows travel through the one range shuffle, copies collapsed before it, and nothing is joined back.
    """
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(norm.alias("norm"), F.col(id_col).cast("long").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    shape = rows.schema
    local = rows.sortWithinPartitions("norm", _order(keep)).mapInArrow(lean(_first_of_runs), shape)
    ranged = local.repartitionByRange(F.substring("norm", 1, PREFIX_BYTES), F.sha2("norm", 256)).sortWithinPartitions("norm", _order(keep))
    return ranged.mapInArrow(lean(_first_of_runs), shape).select("row.*")
