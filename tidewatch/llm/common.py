"""Shared pieces of the training-data operators: normalisation, splits, and tables cut off from their lineage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.tables import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: White space between words, as a Java and DuckDB character class.
BLANK = r"[\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is; null stays null."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text in order, repeats included; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 2,000 rows unless the session says otherwise: texts are long, and a task holds several batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "2000")


def give_back() -> None:
    """Free memory of this process goes back to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: as ``run``, and the worker, which lives on for other tasks, gives free memory back at the end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor costs nothing.

    The folder's name is unique, so concurrent runs don't meet; whoever owns the shared folder clears it.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/tidewatch/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
