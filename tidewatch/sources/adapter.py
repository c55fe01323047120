"""The benchmark tables seen as telemetry: a deterministic view of ``events`` with the security schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(pairs: list[tuple[Column, str]], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for when, value in reversed(pairs):
        out = F.when(when, F.lit(value)).otherwise(out)
    return out


def security_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, trace_id, host_id, agent_id, source_type, event_type, severity, ts, command: an event for each row."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kind, value, n = F.col("event_type"), F.col("value"), F.col("event_id")
    return e.select(
        n.cast("string").alias("event_id"),
        F.md5(n.cast("string")).alias("trace_id"),
        F.concat(F.lit("host-"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("host_id"),
        F.concat(F.lit("agent-"), (F.col("user_id") % 16).cast("string")).alias("agent_id"),
        _cases([(n % 3 == 0, "ebpf"), (n % 3 == 1, "logs")], "simulator").alias("source_type"),
        _cases([(kind.isin("view", "click"), "network_egress"), (kind.isin("purchase", "signup"), "process_exec")], "host_startup").alias("event_type"),
        _cases([(value < 20, "low"), (value < 60, "medium"), (value < 150, "high")], "critical").alias("severity"),
        "ts",
        _cases(
            [(k < 10, "/usr/bin/nc"), (k < 15, "/bin/nc"), (k < 18, "/usr/bin/netcat"), (k < 22, "curl --token topsecret"), (k < 26, "mysql --password=x")], "/usr/bin/curl"
        ).alias("command"),
    )


def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id and messages (role, content) in turn order."""
    c = table(spark, sf_dir, "conversations")
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return c.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))
