"""Column expressions of the telemetry path: defaults, redaction, rules, severity, score, projections.

All are built-in expressions, so batch and streaming share one plan and nothing leaves whole-stage code generation.
A JSON null counts as a missing key: both get the default.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import SEVERITIES

#: Commands of high risk, matched whole.
HIGH_RISK_COMMANDS = ("/usr/bin/nc", "/bin/nc", "/usr/bin/netcat")
#: Words that have a command redacted.
SECRET_WORDS = ("token", "password")
REDACTED = "[redacted]"
NO_HIT = "no high-signal heuristics matched"
#: Score of a severity without hits, and of a severity not listed.
BASE_SCORE = {"low": 0.15, "medium": 0.45, "high": 0.75, "critical": 0.95}
OTHER_SCORE = 0.2
ALERT_SCORE = 0.8


def utc_text(ts: Column) -> Column:
    """RFC 3339, UTC, whole seconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def now_text() -> Column:
    return utc_text(F.current_timestamp())


def stable_id(*parts: Column) -> Column:
    """An id that a rerun gives again, where a random one would make reruns differ."""
    return F.md5(F.concat_ws("|", *parts))


def with_defaults(events: DataFrame, host_id: str = "unknown-host", now: Column | None = None) -> DataFrame:
    """Missing fields of events filled; an event without an id gets the digest of what it says."""
    said = F.to_json(F.struct(*events.columns))
    fill = {
        "event_id": stable_id(F.lit("event"), said), "trace_id": stable_id(F.lit("trace"), said), "host_id": F.lit(host_id), "agent_id": F.lit("unknown-agent"),
        "source_type": F.lit("logs"), "event_type": F.lit("unknown"), "severity": F.lit("low"), "ts": now_text() if now is None else now,
        "tags": F.array().cast("array<string>"),
    }
    return events.withColumns({c: F.coalesce(F.col(c), v) for c, v in fill.items() if c in events.columns})


def redact(command: Column) -> Column:
    """The whole command gives way if it has a word of a secret, in any case; null stays null."""
    low = F.lower(command)
    found = F.contains(low, F.lit(SECRET_WORDS[0])) | F.contains(low, F.lit(SECRET_WORDS[1]))
    return F.when(found, F.lit(REDACTED)).otherwise(command)


def severity_rank(severity: Column) -> Column:
    """1 to 4; a severity not listed ranks like low."""
    out = F.lit(1)
    for i, s in enumerate(SEVERITIES[1:], 2):
        out = F.when(severity == s, i).otherwise(out)
    return F.coalesce(out, F.lit(1))


def promote(current: Column, target: str) -> Column:
    """The target if it ranks above the current severity, which keeps ties."""
    return F.when(severity_rank(current) < severity_rank(F.lit(target)), F.lit(target)).otherwise(current)


@dataclass(frozen=True)
class Rule:
    """A named predicate over (event_type, command), what it says, and the severity it lifts an event to."""

    name: str
    matches: Callable[[Column, Column], Column]
    says: Callable[[Column, Column], Column]
    lifts_to: str


RULES = (
    Rule("network_egress_activity", lambda kind, _: kind == "network_egress", lambda kind, _: F.lit("network egress activity observed"), "medium"),
    Rule("suspicious_exec", lambda _, cmd: cmd.isin(*HIGH_RISK_COMMANDS), lambda _, cmd: F.concat(F.lit("high-risk binary executed: "), cmd), "high"),
)


def apply_rules(events: DataFrame, command: Column, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """rule_hits, derived_severity and explanation; rules fire in order, each on the severity the last one left."""
    kind = F.coalesce(F.col("event_type"), F.lit("unknown"))
    cmd = F.coalesce(command, F.lit(""))
    severity, hits, parts = F.coalesce(F.col("severity"), F.lit("low")), [], []
    for r in rules:
        hit = r.matches(kind, cmd)
        hits.append(F.when(hit, F.lit(r.name)))
        parts.append(F.when(hit, r.says(kind, cmd)))
        severity = F.when(hit, promote(severity, r.lifts_to)).otherwise(severity)
    said = F.array_join(F.array_compact(F.array(*parts)), "; ")
    return events.withColumns({"rule_hits": F.array_compact(F.array(*hits)), "derived_severity": severity, "explanation": F.when(said == "", F.lit(NO_HIT)).otherwise(said)})


def risk_score(severity: Column, hits: Column, source_type: Column) -> Column:
    """Base of the severity, 0.05 a hit up to 0.2, 0.03 for ebpf; 0.99 at most, three digits."""
    base = F.lit(OTHER_SCORE)
    for s, v in BASE_SCORE.items():
        base = F.when(severity == s, v).otherwise(base)
    more = F.least(F.lit(0.2), F.size(hits) * 0.05) + F.when(source_type == "ebpf", 0.03).otherwise(0.0)
    return F.round(F.least(F.lit(0.99), base + more), 3)


def findings(events: DataFrame, analyzed_at: Column | None = None) -> DataFrame:
    """Defaulted, redacted events with a ``command`` column -> one analysis each."""
    ruled = apply_rules(events, F.col("command"))
    return ruled.select(
        stable_id(F.lit("analysis"), F.col("event_id")).alias("analysis_id"), "event_id", "trace_id", "host_id",
        risk_score(F.col("derived_severity"), F.col("rule_hits"), F.col("source_type")).alias("score"),
        F.col("derived_severity").alias("severity"), "rule_hits", "explanation",
        (now_text() if analyzed_at is None else analyzed_at).alias("analyzed_at"),
    )


def is_alert() -> Column:
    return (F.col("score") >= ALERT_SCORE) | F.col("severity").isin("high", "critical")


def alerts(analyses: DataFrame, created_at: Column | None = None) -> DataFrame:
    title = F.concat(F.lit("Security finding ("), F.col("severity"), F.lit(")"))
    made = now_text() if created_at is None else created_at
    return analyses.where(is_alert()).select(stable_id(F.lit("alert"), F.col("analysis_id")).alias("alert_id"), "analysis_id", "event_id", "trace_id", "host_id", "severity", title.alias("title"), made.alias("created_at"))


def lifecycle(events: DataFrame, stream_id: Column, attempt: Column, outcome: Column) -> DataFrame:
    """What is logged about an event: never its raw payload."""
    own = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("event_id", "trace_id", "host_id", "event_type", "severity")]
    return events.select(*own, stream_id.alias("stream_id"), attempt.alias("attempt"), outcome.alias("outcome"))


def log_line(name: str, df: DataFrame) -> DataFrame:
    """One JSON text per row, keys sorted, the event's name among them."""
    cols = {**{c: F.col(c) for c in df.columns}, "event": F.lit(name)}
    return df.select(F.to_json(F.struct(*[cols[c].alias(c) for c in sorted(cols)])).alias("line"))


def metrics(counted: DataFrame, seconds: Column) -> DataFrame:
    """Outcome rows (outcome) -> counters and events processed per second, one second at least."""
    count = lambda o: F.count_if(F.col("outcome") == o)
    return counted.agg(
        count("processed").alias("processed"), count("retried").alias("retried"), count("deduped").alias("deduped"), count("dlq").alias("dlq_published"), count("error").alias("pipeline_errors"),
        F.round(count("processed") / F.greatest(F.lit(1.0), F.max(seconds)), 3).alias("throughput_per_sec"),
    )
