"""Dead letters: made, parsed, routed and replayed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.telemetry import now_text
from tidewatch.sources.streams import entries_after


def dead_letters(failed: DataFrame, stream: str, reason: Column, now: Column | None = None) -> DataFrame:
    """failed (stream_id, payload) -> a JSON dead letter each, the payload under its field ``event``."""
    item = F.struct(F.lit(stream).alias("stream"), "stream_id", reason.alias("reason"), F.create_map(F.lit("event"), F.col("payload")).alias("payload"), (now_text() if now is None else now).alias("ts"))
    return failed.select("stream_id", F.to_json(item).alias("dlq"))


def parsed(entries: DataFrame, dlq: str = "dlq") -> DataFrame:
    """entries (stream_id, dlq) -> source_stream, payload (map) and reason: null if the entry can be replayed.

    The payload's nulls are dropped, strings stay, other values become compact JSON text.
    """
    raw = F.trim(F.coalesce(F.col(dlq), F.lit("")))
    item = F.try_parse_json(raw)
    source = F.trim(F.coalesce(F.try_variant_get(item, "$.stream", "string"), F.lit("")))
    payload = F.map_filter(F.from_json(F.get_json_object(raw, "$.payload"), "map<string,string>"), lambda _, v: v.isNotNull())
    is_object = F.ltrim(F.get_json_object(raw, "$.payload")).startswith("{")
    reason = (
        F.when(raw == "", "missing dlq field")
        .when(item.isNull(), "dlq entry is not valid JSON")
        .when(~raw.startswith("{"), "dlq entry must be object")
        .when(source == "", "dlq entry missing source stream")
        .when(~F.coalesce(is_object, F.lit(False)), "dlq payload must be object")
        .when(~F.map_contains_key(payload, "event"), "dlq payload missing event field")
    )
    return entries.select("*", source.alias("source_stream"), payload.alias("payload"), reason.alias("reason"))


def destination(source: Column, forced: str | None, fallback: str, dlq_stream: str) -> Column:
    """The forced stream, else the source unless it is the dead-letter stream itself, else the fallback."""
    if (forced or "").strip():
        return F.lit(forced.strip())
    name = F.trim(source)
    return F.when((name != "") & (name != dlq_stream), name).otherwise(F.lit(fallback))


def replay_plan(entries: DataFrame, start: str = "0-0", limit: int = 100, forced: str | None = None, fallback: str = "security_events", dlq_stream: str = "security_dlq") -> DataFrame:
    """What a replay would do with each entry from ``start`` on, itself included; nothing is written."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    rows = parsed(entries_after(entries, start, limit, inclusive=True))
    return rows.withColumn("destination", F.when(F.col("reason").isNull(), destination(F.col("source_stream"), forced, fallback, dlq_stream)))


def replay(plan: DataFrame, folder: str, execute: bool = False, delete: bool = False) -> DataFrame:
    """Counters of a replay; with ``execute``, eligible payloads are appended to ``folder/destination=D``.

    Each destination is written by itself, so one that fails counts as failed and the others go on; ``delete`` counts
    what was replayed as deleted, and ``remaining`` is then what is left.  Entries carry their dead letter's position, so
    that a replay run twice is undone by a dedupe on it.
    """
    ready = plan.where("reason is null").select("destination", F.col("stream_id").alias("replayed_from"), F.element_at("payload", "event").alias("payload"))
    lost: list[str] = []
    if execute:
        for name in [r.destination for r in ready.select("destination").distinct().collect()]:  # streams, not entries
            try:
                ready.where(F.col("destination") == name).drop("destination").write.mode("append").json(f"{folder}/destination={name}")
            except Exception:  # noqa: BLE001  a destination that can't be written is counted
                lost.append(name)
    ok = F.col("reason").isNull()
    failed = ok & F.col("destination").isin(lost) if lost else F.lit(False)
    done = ok & ~failed if execute else F.lit(False)
    count = lambda c, name: F.count_if(c).alias(name)
    return plan.agg(
        F.count("*").alias("scanned"), count(ok, "eligible"), count(done, "replayed"), count(~ok, "skipped"), count(failed, "failed"), count(done & F.lit(delete), "deleted"),
    )


def remaining(entries: DataFrame, plan: DataFrame) -> DataFrame:
    """The dead letters that stay when replayed ones are deleted."""
    return entries.join(plan.where("reason is null").select("stream_id"), "stream_id", "left_anti")
