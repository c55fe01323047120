"""Read queries with pages, parameters checked as the endpoints check them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.telemetry import utc_text
from tidewatch.schemas import SEVERITIES


class QueryError(ValueError):
    """A request that is turned down: what an error envelope carries."""

    def __init__(self, code: str, message: str, details: dict | None = None):
        super().__init__(message)
        self.envelope = {"error_code": code, "message": message} | ({"details": details} if details else {})


def bounded_int(raw: str | None, default: int, least: int, most: int, name: str) -> int:
    text = (raw or "").strip()
    if not text:
        return default
    try:
        value = int(text)
    except ValueError:
        raise QueryError("invalid_query", f"{name} must be an integer", {"field": name}) from None
    if not least <= value <= most:
        raise QueryError("invalid_query", f"{name} must be between {least} and {most}", {"field": name})
    return value


def limit_offset(limit: str | None, offset: str | None, default: int, most: int, furthest: int = 10_000) -> tuple[int, int]:
    return bounded_int(limit, default, 1, most, "limit"), bounded_int(offset, 0, 0, furthest, "offset")


@dataclass(frozen=True)
class Page:
    rows: list
    limit: int
    offset: int
    returned: int
    has_more: bool


def page_frame(df: DataFrame, limit: int, offset: int) -> DataFrame:
    return df.offset(offset).limit(limit)


def page(df: DataFrame, limit: int, offset: int) -> Page:
    """One row more than asked tells whether there are more; a page is at most 250 rows."""
    got = df.offset(offset).limit(limit + 1).collect()
    rows = [r.asDict(True) for r in got[:limit]]
    return Page(rows, limit, offset, len(rows), len(got) > limit)


RECENT_COLUMNS = ["analysis_id", "event_id", "host_id", "score", "severity", "explanation", "analyzed_at"]


def recent_findings(findings: DataFrame) -> DataFrame:
    """All findings, whatever their severity, newest first; Spark keeps only a page's rows when a limit follows."""
    return findings.select(*RECENT_COLUMNS).orderBy(F.desc("analyzed_at"), F.desc("analysis_id"))


def event_search(events: DataFrame, host_id: str | None = None, event_type: str | None = None, severity: str | None = None) -> DataFrame:
    """Events by optional equalities, newest first.

    A severity is valid in any case but is compared as it is written, so that ``HIGH`` is accepted and matches nothing
    that is stored in lower case.
    """
    asked = {"host_id": host_id, "event_type": event_type, "severity": severity}
    asked = {c: (v or "").strip() for c, v in asked.items()}
    if asked["severity"] and asked["severity"].lower() not in SEVERITIES:
        raise QueryError("invalid_query", "severity must be one of " + ", ".join(SEVERITIES), {"field": "severity"})
    out = events
    for c, v in asked.items():
        if v:
            out = out.where(F.col(c) == v)
    return out.orderBy(F.desc("ts"), F.desc("event_id"))


def agent_status(heartbeats: DataFrame, agent_id: str) -> DataFrame:
    return heartbeats.where(F.col("agent_id") == agent_id).limit(1)


def checkins(bodies: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Accepted check-ins, and bodies without an agent or a host."""
    from tidewatch.schemas import CHECKIN

    rows = bodies.select(F.col(body).alias("body"), F.from_json(body, CHECKIN).alias("c"))
    blank = lambda c: F.trim(F.coalesce(F.col(f"c.{c}"), F.lit(""))) == ""
    bad = blank("agent_id") | blank("host_id")
    ok = rows.where(~bad).select(
        F.trim("c.agent_id").alias("agent_id"), F.trim("c.host_id").alias("host_id"),
        F.when(blank("source_type"), "unknown").otherwise(F.trim("c.source_type")).alias("source_type"),
        F.coalesce("c.capabilities", F.array().cast("array<string>")).alias("capabilities"),
    )
    return ok, rows.where(bad).select("body", F.lit("agent_id and host_id are required").alias("message"))


def rendered(df: DataFrame) -> DataFrame:
    """Times as the endpoints write them."""
    times = [c for c, t in df.dtypes if t.startswith("timestamp")]
    return df.withColumns({c: utc_text(F.col(c)) for c in times}) if times else df


def require_positive(**values: float) -> None:
    for name, v in values.items():
        if v <= 0:
            raise QueryError("invalid_argument", f"{name} must be positive", {"field": name})
