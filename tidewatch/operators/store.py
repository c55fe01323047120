"""Tables kept by upserts: snapshots of a stream by first-writer and last-writer columns, merges, and foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import STREAM_START

#: Columns that the first write of a row fixes, and those that the last write sets.
EVENT_FIRST = ["trace_id", "host_id", "agent_id", "source_type", "event_type", "ts", "raw"]
EVENT_LAST = ["severity", "normalized", "tags", "ingested_at"]
FINDING_FIRST = ["event_id", "trace_id", "host_id"]
FINDING_LAST = ["score", "severity", "rule_hits", "explanation", "analyzed_at"]


def first_last(writes: DataFrame, key: str, order: str, first: list[str], last: list[str]) -> DataFrame:
    """One row per key: ``first`` columns as first written, ``last`` columns as last written, by ``order``."""
    first, last = ([c for c in cols if c in writes.columns] for cols in (first, last))
    aggs = [F.min_by(F.struct(*first), order).alias("_f")] * bool(first) + [F.max_by(F.struct(*last), order).alias("_l")] * bool(last)
    return writes.groupBy(key).agg(*aggs).select(key, *["_f.*"] * bool(first), *["_l.*"] * bool(last))


def upsert(current: DataFrame, writes: DataFrame, key: str, order: str, first: list[str], last: list[str]) -> DataFrame:
    """``current`` after ``writes``: rows that were there keep their first-writer columns."""
    new = first_last(writes, key, order, first, last)
    had = current.select(key, F.lit(True).alias("_had"), F.struct(*[c for c in current.columns if c != key]).alias("_c"))
    both = had.join(new.select(key, F.lit(True).alias("_has"), F.struct(*[c for c in new.columns if c != key]).alias("_n")), key, "full_outer")
    pick = []
    for c in current.columns:
        if c == key:
            pick.append(F.col(key))
        elif c in last:
            pick.append(F.when(F.col("_has"), F.col(f"_n.{c}")).otherwise(F.col(f"_c.{c}")).alias(c))
        else:
            pick.append(F.when(F.col("_had"), F.col(f"_c.{c}")).otherwise(F.col(f"_n.{c}")).alias(c))
    return both.select(*pick)


def hosts(seen: DataFrame, host: str = "host_id", at: str = "ts") -> DataFrame:
    """host_id, first_seen_at, last_seen_at."""
    return seen.groupBy(F.col(host).alias("host_id")).agg(F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"))


def latest(history: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each key's last row, ties broken by the other columns; an aggregate, so rows combine before they are shuffled."""
    rest = [c for c in history.columns if c != key]
    ties = [c for c in rest if c not in order]
    return history.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("_r")).select(key, "_r.*")


def heartbeat_table(history: DataFrame) -> DataFrame:
    """agent_id with its last heartbeat, always online."""
    return latest(history, "agent_id", ["seen_at"]).withColumn("status", F.lit("online"))


def checkpoints(moves: DataFrame) -> DataFrame:
    """stream_name, consumer_name and the furthest position that each reached, compared as numbers."""
    at = F.struct(F.split_part("stream_id", F.lit("-"), F.lit(1)).cast("long"), F.split_part("stream_id", F.lit("-"), F.lit(2)).cast("long"))
    got = moves.groupBy("stream_name", "consumer_name").agg(F.max_by("stream_id", at).alias("last_stream_id"))
    return got.withColumn("last_stream_id", F.coalesce("last_stream_id", F.lit(STREAM_START)))


def split_by_key(rows: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose parent is there, and rows that a foreign key would reject (null keys among them)."""
    there = parents.select(F.col(parent_key or key).alias("_p")).distinct()
    same = rows[key] == there["_p"]
    return rows.join(there, same, "left_semi"), rows.join(there, same, "left_anti")


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    return children.join(deleted.select(key).distinct(), key, "left_anti")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that a primary key would reject, with their counts."""
    return df.groupBy(*keys).count().where("count > 1")
