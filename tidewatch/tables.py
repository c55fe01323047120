"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where that is unset and everything runs on one machine, else an error."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="tidewatch-")
    return _own_dir


def new_folder(spark: SparkSession, tag: str) -> str:
    """A name of its own in the shared folder, so that concurrent runs don't meet."""
    return f"{shared_dir(spark)}/tidewatch/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table of the shared folder: lineage ends there, and a lost executor costs nothing."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(rows: DataFrame, piece: list[str], restart: int = 0) -> DataFrame:
    """Rows as they are read, with ``_place``: 1, 2, .. in the order of their pieces, without one task that sees them all.

    ``piece``: columns of what is read in one go and in order, say a file's block; they order the pieces, and ``restart``
    of them name what is numbered by itself.  Pieces are counted first: a row each reaches the driver, 16 bytes and its
    names.  A row's place in its piece is told by Spark's own row ids, which rise by one in a task.
    """
    spark = rows.sparkSession
    own = rows.withColumn("_id", F.monotonically_increasing_id())
    counts = own.groupBy(*piece).agg(F.count("*").alias("n"), F.min("_id").alias("first")).orderBy(*piece).collect()
    before, last, total = [], None, 0
    for r in counts:
        if (name := tuple(r[c] for c in piece[:restart])) != last:
            last, total = name, 0
        before.append((*[r[c] for c in piece], total - r["first"] + 1))
        total += r["n"]
    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in piece)
    offsets = spark.createDataFrame(before, f"{fields}, _shift long")
    same = None
    for c in piece:
        same = (own[c] == offsets[c]) if same is None else same & (own[c] == offsets[c])
    joined = own.join(F.broadcast(offsets), same).withColumn("_place", F.col("_id") + F.col("_shift"))
    return joined.select(*[own[c] for c in rows.columns], "_place")


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its 1-based place in ``order``, a total one: rows are dealt out by ranges of it, sorted, written and counted."""
    keys = [f"_k{i}" for i in range(len(order))]
    dealt = df.withColumns(dict(zip(keys, order))).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys).withColumn("_part", F.spark_partition_id())
    table = written(dealt, "ranked")
    rows = placed(table.withColumn("_block", F.col("_metadata.file_block_start")), ["_part", "_block"])
    return rows.select(*df.columns, F.col("_place").alias(name))
