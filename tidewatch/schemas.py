"""Schemas of stream payloads and tables."""

from __future__ import annotations

EVENT = (
    "event_id string, trace_id string, host_id string, agent_id string, source_type string, event_type string, severity string, ts string, "
    "raw struct<pid:bigint,ppid:bigint,command:string,message:string>, "
    "normalized struct<process_name:string,network_direction:string,collector:string>, tags array<string>"
)
ANALYSIS = "analysis_id string, event_id string, trace_id string, host_id string, score double, severity string, rule_hits array<string>, explanation string, analyzed_at string"
ALERT = "alert_id string, analysis_id string, event_id string, trace_id string, host_id string, severity string, title string, created_at string"
DLQ = "stream string, stream_id string, reason string, payload map<string,string>, ts string"
HEARTBEAT = "agent_id string, host_id string, source_type string, status string, seen_at string"
CHECKIN = "agent_id string, host_id string, source_type string, capabilities array<string>"
CHAT = "messages array<struct<role:string,content:string>>, meta struct<task:string,source_ids:array<string>,source_book:string,split:string,synthesized:boolean>"
#: An entry of an append-only stream: its position "<ms>-<seq>" and the JSON text of its one field.
STREAM_ENTRY = "stream_id string, payload string"
#: The severities in order.
SEVERITIES = ("low", "medium", "high", "critical")
