"""Append-only streams as folders of JSON lines, and generators of synthetic events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import STREAM_START
from tidewatch.schemas import STREAM_ENTRY


def read_stream(spark: SparkSession, folder: str, schema: str = STREAM_ENTRY, files_per_trigger: int = 1) -> DataFrame:
    """New entries only, from the first on; positions are kept in the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def position(stream_id: Column) -> Column:
    """A position as two numbers; as text, "10-0" would come before "9-0"."""
    part = lambda i: F.coalesce(F.split_part(stream_id, F.lit("-"), F.lit(i)).try_cast("long"), F.lit(0).cast("long"))
    return F.struct(part(1).alias("ms"), part(2).alias("seq"))


def entries_after(entries: DataFrame, checkpoint: str = STREAM_START, limit: int | None = None, inclusive: bool = False) -> DataFrame:
    """Entries behind a checkpoint in stream order; inclusive: the entry at it too."""
    at, start = position(F.col("stream_id")), position(F.lit(checkpoint))
    rows = entries.where(at >= start if inclusive else at > start).orderBy(at)
    return rows if limit is None else rows.limit(limit)


def checkpoint_of(checkpoints: DataFrame, stream: str, consumer: str) -> str:
    row = checkpoints.where((F.col("stream_name") == stream) & (F.col("consumer_name") == consumer)).select("last_stream_id").first()
    return row[0] if row else STREAM_START


def synthetic_events(numbers: DataFrame, host_id: str = "host-local", agent_id: str = "agent-local", source_type: str = "simulator") -> DataFrame:
    """n -> an event: every third an egress, every fifth of high severity and running nc."""
    n = F.col("n")
    egress, high = n % 3 == 0, n % 5 == 0
    return numbers.select(
        "n",
        F.md5(F.concat(F.lit("event:"), n.cast("string"))).alias("event_id"),
        F.md5(F.concat(F.lit("trace:"), n.cast("string"))).alias("trace_id"),
        F.lit(host_id).alias("host_id"), F.lit(agent_id).alias("agent_id"), F.lit(source_type).alias("source_type"),
        F.when(egress, "network_egress").otherwise("process_exec").alias("event_type"),
        F.when(high, "high").otherwise("medium").alias("severity"),
        (n + 1000).alias("pid"), F.lit(1).cast("long").alias("ppid"),
        F.when(high, "/usr/bin/nc").otherwise("/usr/bin/curl").alias("command"),
        F.when(high, "nc").otherwise("curl").alias("process_name"),
        F.when(egress, "egress").otherwise("none").alias("network_direction"),
        F.array(F.lit("linux"), F.lit("server"), F.lit("runtime")).alias("tags"),
    )


def rate_events(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """The generator as a stream."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return synthetic_events(rate.select((F.col("value") + 1).alias("n")))


def heartbeats(events: DataFrame, every: int = 5) -> DataFrame:
    return events.where(F.col("n") % every == 0).select("n", "agent_id", "host_id", "source_type", F.lit("online").alias("status"))


def host_startup(spark: SparkSession, host_id: str, agent_id: str) -> DataFrame:
    """The one event of an agent that starts."""
    row = spark.range(1).select(F.md5(F.lit(f"{host_id}|{agent_id}|startup")).alias("event_id"), F.md5(F.lit(f"{host_id}|{agent_id}|trace")).alias("trace_id"))
    fixed = {"host_id": host_id, "agent_id": agent_id, "source_type": "logs", "event_type": "host_startup", "severity": "low", "message": "host agent started", "collector": "host-agent"}
    return row.select("*", *[F.lit(v).alias(c) for c, v in fixed.items()], F.array(F.lit("host"), F.lit("startup")).alias("tags"))
