"""Every query of the telemetry and corpus side, each over its whole tables, with the SQL that expresses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import telemetry as tel
from tidewatch.functions import text as tx
from tidewatch.operators import api, audit, buckets, dedupe, dlq, evalrun, generate, leak, records, split, stats, store
from tidewatch.sources import knowledge
from tidewatch.sources.adapter import chat_records, security_events, table
from tidewatch.sources.streams import heartbeats, synthetic_events
from tidewatch.tables import new_folder, ranked

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The adapter's view, and findings over it, as SQL.
EVENTS_SQL = """
    ev AS (
        SELECT event_id::VARCHAR AS event_id, md5(event_id::VARCHAR) AS trace_id,
               'host-' || lpad(user_id::VARCHAR, 4, '0') AS host_id, 'agent-' || (user_id % 16)::VARCHAR AS agent_id,
               CASE event_id % 3 WHEN 0 THEN 'ebpf' WHEN 1 THEN 'logs' ELSE 'simulator' END AS source_type,
               CASE WHEN event_type IN ('view', 'click') THEN 'network_egress' WHEN event_type IN ('purchase', 'signup') THEN 'process_exec' ELSE 'host_startup' END AS event_type,
               CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'medium' WHEN value < 150 THEN 'high' ELSE 'critical' END AS severity,
               ts,
               CASE WHEN k < 10 THEN '/usr/bin/nc' WHEN k < 15 THEN '/bin/nc' WHEN k < 18 THEN '/usr/bin/netcat'
                    WHEN k < 22 THEN 'curl --token topsecret' WHEN k < 26 THEN 'mysql --password=x' ELSE '/usr/bin/curl' END AS command
        FROM (SELECT *, (props::JSON ->> '$.k')::INT AS k FROM events)
    ),
    clean AS (
        SELECT * REPLACE (CASE WHEN lower(command) LIKE '%token%' OR lower(command) LIKE '%password%' THEN '[redacted]' ELSE command END AS command) FROM ev
    ),
    hit AS (
        SELECT *, event_type = 'network_egress' AS h1, command IN ('/usr/bin/nc', '/bin/nc', '/usr/bin/netcat') AS h2 FROM clean
    ),
    ruled AS (
        SELECT *, CASE WHEN h2 AND severity IN ('low', 'medium') THEN 'high' WHEN h1 AND severity = 'low' THEN 'medium' ELSE severity END AS derived, h1::INT + h2::INT AS n_hits FROM hit
    ),
    fnd AS (
        SELECT md5('analysis|' || event_id) AS analysis_id, event_id, trace_id, host_id,
               round(least(0.99::DOUBLE, CASE derived WHEN 'low' THEN 0.15::DOUBLE WHEN 'medium' THEN 0.45::DOUBLE WHEN 'high' THEN 0.75::DOUBLE ELSE 0.95::DOUBLE END
                     + least(0.2::DOUBLE, n_hits * 0.05::DOUBLE) + CASE WHEN source_type = 'ebpf' THEN 0.03::DOUBLE ELSE 0::DOUBLE END), 3) AS score,
               derived AS severity,
               concat_ws(',', CASE WHEN h1 THEN 'network_egress_activity' END, CASE WHEN h2 THEN 'suspicious_exec' END) AS rule_hits,
               CASE WHEN n_hits = 0 THEN 'no high-signal heuristics matched'
                    ELSE concat_ws('; ', CASE WHEN h1 THEN 'network egress activity observed' END, CASE WHEN h2 THEN 'high-risk binary executed: ' || command END) END AS explanation,
               ts AS analyzed_at, source_type, event_type
        FROM ruled
    )
"""


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLE_SQL[key] = sql
        return fn

    return add


def ev(sql: str) -> str:
    return f"WITH {EVENTS_SQL} {sql}"


def _clean(spark, d) -> DataFrame:
    return security_events(spark, d).withColumn("command", tel.redact(F.col("command")))


def _findings(spark, d) -> DataFrame:
    """Findings analysed at their event's time, so that two engines agree."""
    return tel.findings(_clean(spark, d), F.col("ts"))


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_hits", F.array_join("rule_hits", ","))


# --- telemetry ---------------------------------------------------------------------------------------------------


@query(ev("SELECT * FROM ev"))
def normalize_events(spark, d):
    return tel.with_defaults(security_events(spark, d), "host-0000", F.col("ts"))


@query(ev("SELECT event_id, command FROM clean"))
def redact_commands(spark, d):
    return _clean(spark, d).select("event_id", "command")


@query(ev("SELECT event_id, rule_hits, severity AS derived_severity, explanation FROM fnd"))
def rule_hits(spark, d):
    return _flat(tel.apply_rules(_clean(spark, d), F.col("command"))).select("event_id", "rule_hits", "derived_severity", "explanation")


@query(ev("SELECT * EXCLUDE (source_type, event_type) FROM fnd"))
def score_findings(spark, d):
    return _flat(_findings(spark, d))


@query(ev("SELECT md5('alert|' || analysis_id) AS alert_id, analysis_id, event_id, trace_id, host_id, severity, 'Security finding (' || severity || ')' AS title, strftime(analyzed_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM fnd WHERE score >= 0.8 OR severity IN ('high', 'critical')"))
def alerts(spark, d):
    return tel.alerts(_findings(spark, d), tel.utc_text(F.col("analyzed_at")))


@query(ev("SELECT analysis_id, event_id, host_id, score, severity, explanation, analyzed_at FROM fnd ORDER BY analyzed_at DESC, analysis_id DESC LIMIT 20 OFFSET 40"))
def recent_findings_page(spark, d):
    return api.page_frame(api.recent_findings(_findings(spark, d)), 20, 40)


_SEARCH = "SELECT event_id, trace_id, host_id, agent_id, source_type, event_type, severity, ts, command FROM ev"


@query(ev(f"{_SEARCH} ORDER BY ts DESC, event_id DESC LIMIT 50"))
def event_search_all(spark, d):
    return api.page_frame(api.event_search(security_events(spark, d)), 50, 0)


@query(ev(f"{_SEARCH} WHERE host_id = 'host-0007' AND event_type = 'network_egress' AND severity = 'high' ORDER BY ts DESC, event_id DESC LIMIT 50"))
def event_search_filtered(spark, d):
    return api.page_frame(api.event_search(security_events(spark, d), " host-0007 ", "network_egress", "high"), 50, 0)


@query(ev(f"{_SEARCH} WHERE event_type = 'process_exec' ORDER BY ts DESC, event_id DESC LIMIT 250 OFFSET 250"))
def event_search_page2(spark, d):
    return api.page_frame(api.event_search(security_events(spark, d), event_type="process_exec"), 250, 250)


@query(ev(f"{_SEARCH} WHERE severity = 'HIGH'"))
def event_search_upper_severity(spark, d):
    return api.event_search(security_events(spark, d), severity="HIGH")


@query(ev("SELECT agent_id, host_id, source_type, ts AS seen_at, 'online' AS status FROM (SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY ts DESC, host_id DESC, source_type DESC) AS r FROM ev) WHERE r = 1"))
def agent_latest_status(spark, d):
    return store.heartbeat_table(security_events(spark, d).select("agent_id", "host_id", "source_type", F.col("ts").alias("seen_at")))


@query(ev("SELECT agent_id, host_id, source_type, ts AS seen_at, 'online' AS status FROM ev WHERE agent_id = 'agent-7' ORDER BY ts DESC, host_id DESC, source_type DESC LIMIT 1"))
def agent_status_lookup(spark, d):
    return api.agent_status(agent_latest_status(spark, d), "agent-7")


@query(ev("SELECT host_id, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM ev GROUP BY host_id"))
def hosts_upsert(spark, d):
    return store.hosts(security_events(spark, d))


def _writes(spark, d):
    """Events written under twenty-times reused ids, so that upserts meet."""
    e = security_events(spark, d)
    return e.withColumns({"pos": F.col("event_id").cast("long"), "event_id": F.concat(F.lit("e"), (F.col("event_id").cast("long") % 500).cast("string"))})


_WRITES = "w AS (SELECT * REPLACE ('e' || (event_id::BIGINT % 500)::VARCHAR AS event_id), event_id::BIGINT AS pos FROM ev)"


@query(f"WITH {EVENTS_SQL}, {_WRITES} SELECT event_id, arg_min(trace_id, pos) AS trace_id, arg_min(host_id, pos) AS host_id, arg_min(ts, pos) AS ts, arg_max(severity, pos) AS severity FROM w GROUP BY event_id")
def events_upsert_merge(spark, d):
    return store.first_last(_writes(spark, d), "event_id", "pos", store.EVENT_FIRST, store.EVENT_LAST).select("event_id", "trace_id", "host_id", "ts", "severity")


@query(f"WITH {EVENTS_SQL}, {_WRITES} SELECT event_id, arg_min(trace_id, pos) AS trace_id, arg_min(host_id, pos) AS host_id, arg_min(ts, pos) AS ts, arg_max(severity, pos) AS severity FROM w GROUP BY event_id", name="events_upsert_incremental")
def events_upsert_incremental(spark, d):
    """The table has three fifths of the ids; the writes that follow update those and insert the others."""
    w = _writes(spark, d).select("event_id", "trace_id", "host_id", "ts", "severity", "pos")
    early = (F.col("pos") < 500) & (F.col("pos") % 5 < 3)
    old = store.first_last(w.where(early), "event_id", "pos", store.EVENT_FIRST, store.EVENT_LAST)
    return store.upsert(old, w.where(~early), "event_id", "pos", store.EVENT_FIRST, store.EVENT_LAST).select("event_id", "trace_id", "host_id", "ts", "severity")


@query(f"WITH {EVENTS_SQL}, {_WRITES} SELECT event_id, arg_min(trace_id, pos) AS trace_id, arg_min(host_id, pos) AS host_id, arg_min(ts, pos) AS ts, arg_max(severity, pos) AS severity FROM w GROUP BY event_id")
def events_upsert_buckets(spark, d):
    """Three versions of a bucketed table: some ids, then the others beside updates of the first, then the rest of the writes."""
    w = _writes(spark, d).select("event_id", "trace_id", "host_id", "ts", "severity", "pos")
    late, some = F.col("pos") >= 500, F.col("pos") % 500 % 3 == 0
    table = buckets.Buckets(spark, new_folder(spark, "events"), {"events": w.drop("pos").schema.toDDL()}, {"events": "event_id"}, 16)
    for version, part in enumerate((w.where(~late & some), w.where((~late & ~some) | (late & some)), w.where(late & ~some))):
        table.upsert(version, "events", part, store.EVENT_FIRST, store.EVENT_LAST)
    return table.read("events")


@query(ev("SELECT f.analysis_id, f.event_id, f.score FROM fnd f WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.event_id = f.event_id AND ev.event_id::BIGINT % 7 <> 0)"))
def findings_fk_reject(spark, d):
    parents = security_events(spark, d).where(F.col("event_id").cast("long") % 7 != 0)
    return store.split_by_key(_findings(spark, d), parents, "event_id")[1].select("analysis_id", "event_id", "score")


@query(ev("SELECT count(*) AS kept FROM fnd WHERE event_id::BIGINT % 7 <> 0"))
def findings_cascade(spark, d):
    gone = security_events(spark, d).where(F.col("event_id").cast("long") % 7 == 0)
    return store.cascade_delete(_findings(spark, d), gone, "event_id").agg(F.count("*").alias("kept"))


@query(f"WITH {EVENTS_SQL}, {_WRITES} SELECT event_id, count(*) AS count FROM w GROUP BY event_id HAVING count(*) > 1")
def primary_key_repeats(spark, d):
    return store.repeated_keys(_writes(spark, d), "event_id")


@query(ev("SELECT event_id, trace_id, host_id, event_type, severity, event_id || '-0' AS stream_id, 1 AS attempt, 'processed' AS outcome FROM ev"))
def lifecycle_projection(spark, d):
    return tel.lifecycle(security_events(spark, d), F.concat("event_id", F.lit("-0")), F.lit(1), F.lit("processed"))


@query(ev("SELECT event_id, '{\"event\":\"finding\",\"event_id\":\"' || event_id || '\",\"severity\":\"' || severity || '\"}' AS line FROM fnd"))
def structured_log(spark, d):
    lines = tel.log_line("finding", _findings(spark, d).select("event_id", "severity"))
    return lines.select(F.get_json_object("line", "$.event_id").alias("event_id"), "line")


@query(ev("SELECT severity, count(*) AS n, round(avg(score), 4) AS avg_score, max(score) AS max_score FROM fnd GROUP BY severity"))
def severity_histogram(spark, d):
    return _findings(spark, d).groupBy("severity").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("avg_score"), F.max("score").alias("max_score"))


@query(ev("SELECT rule, count(*) AS n FROM (SELECT unnest(string_split(rule_hits, ',')) AS rule FROM fnd WHERE rule_hits <> '') GROUP BY rule"))
def rule_hit_counts(spark, d):
    return _findings(spark, d).select(F.explode("rule_hits").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


@query(ev("SELECT source_type, count(*) FILTER (severity = 'low') AS low, count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'critical') AS critical FROM fnd GROUP BY source_type"))
def severity_by_source_pivot(spark, d):
    f = _findings(spark, d).join(security_events(spark, d).select("event_id", "source_type"), "event_id")
    return stats.crosstab(f, "source_type", "severity", ["low", "medium", "high", "critical"])


@query(ev("""SELECT count(*) FILTER (o = 'processed') AS processed, 0::BIGINT AS retried, count(*) FILTER (o = 'deduped') AS deduped, count(*) FILTER (o = 'dlq') AS dlq_published, 0::BIGINT AS pipeline_errors,
    round(count(*) FILTER (o = 'processed') / 60.0::DOUBLE, 3) AS throughput_per_sec
    FROM (SELECT CASE WHEN event_id::BIGINT % 50 = 0 THEN 'dlq' WHEN event_id::BIGINT % 10 = 0 THEN 'deduped' ELSE 'processed' END AS o FROM ev)"""))
def worker_metrics(spark, d):
    n = F.col("event_id").cast("long")
    o = security_events(spark, d).select(F.when(n % 50 == 0, "dlq").when(n % 10 == 0, "deduped").otherwise("processed").alias("outcome"), F.lit(60.0).alias("s"))
    return tel.metrics(o, F.col("s"))


@query(ev("SELECT host_id, count(*) AS n, max(score) AS top_score, first(event_id ORDER BY score DESC, event_id::BIGINT DESC) AS worst_event FROM fnd GROUP BY host_id"))
def host_risk(spark, d):
    order = F.struct("score", F.col("event_id").cast("long"))
    return _findings(spark, d).groupBy("host_id").agg(F.count("*").alias("n"), F.max("score").alias("top_score"), F.max_by("event_id", order).alias("worst_event"))


_TTL = """
    WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS k, event_id, ts FROM events),
    kept AS (
        SELECT k, min(ts) AS ts FROM e GROUP BY k
        UNION ALL
        SELECT k, ts FROM (SELECT e.k, e.ts, row_number() OVER (PARTITION BY e.k ORDER BY e.ts) AS r FROM e JOIN kept ON e.k = kept.k AND e.ts >= kept.ts + INTERVAL 7200 SECOND) WHERE r = 1
    )
    SELECT e.k AS key, min(e.event_id) AS event_id FROM e JOIN kept ON e.k = kept.k AND e.ts = kept.ts GROUP BY e.k, e.ts
"""


@query(_TTL)
def ttl_dedupe(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), "event_id", "ts")
    return dedupe.ttl_dedupe(e, "key", "ts", 7200).select("key", "event_id")


@query("""SELECT n, CASE WHEN n % 3 = 0 THEN 'network_egress' ELSE 'process_exec' END AS event_type, CASE WHEN n % 5 = 0 THEN 'high' ELSE 'medium' END AS severity,
    n + 1000 AS pid, CASE WHEN n % 5 = 0 THEN '/usr/bin/nc' ELSE '/usr/bin/curl' END AS command, CASE WHEN n % 5 = 0 THEN 'nc' ELSE 'curl' END AS process_name,
    CASE WHEN n % 3 = 0 THEN 'egress' ELSE 'none' END AS network_direction, 'linux,server,runtime' AS tags FROM (SELECT event_id + 1 AS n FROM events)""")
def rate_generator(spark, d):
    g = synthetic_events(table(spark, d, "events").select((F.col("event_id") + 1).alias("n")))
    return g.select("n", "event_type", "severity", "pid", "command", "process_name", "network_direction", F.array_join("tags", ",").alias("tags"))


@query("SELECT event_id + 1 AS n, 'agent-local' AS agent_id, 'host-local' AS host_id, 'simulator' AS source_type, 'online' AS status FROM events WHERE (event_id + 1) % 5 = 0")
def heartbeat_generator(spark, d):
    return heartbeats(synthetic_events(table(spark, d, "events").select((F.col("event_id") + 1).alias("n"))))


_CHECKIN = "SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '  ' ELSE 'agent-' || c_custkey END AS agent_id, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'host-' || c_nationkey END AS host_id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE lower(c_mktsegment) END AS source_type FROM customer"


@query(f"SELECT agent_id, host_id, CASE WHEN source_type = '' THEN 'unknown' ELSE source_type END AS source_type FROM ({_CHECKIN}) WHERE trim(agent_id) <> '' AND trim(host_id) <> ''")
def agent_checkins(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(
        F.when(k % 11 == 0, "  ").otherwise(F.concat(F.lit("agent-"), k.cast("string"))).alias("agent_id"),
        F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("host-"), F.col("c_nationkey").cast("string"))).alias("host_id"),
        F.when(k % 5 == 0, "").otherwise(F.lower("c_mktsegment")).alias("source_type"),
    )
    return api.checkins(c.select(F.to_json(F.struct("*")).alias("body")))[0].drop("capabilities")


# --- dead letters ------------------------------------------------------------------------------------------------


def _dlq_entries(spark, d):
    n, k = F.col("event_id"), F.col("event_id") % 6
    item = lambda **kv: F.to_json(F.struct(*[v.alias(c) for c, v in kv.items()]), {"ignoreNullFields": "false"})
    body = F.struct(F.col("event_type").alias("event"), n.alias("n"), F.lit(None).cast("string").alias("gone"))
    raw = (
        F.when(k == 0, "").when(k == 1, "{bad").when(k == 2, "[1]")
        .when(k == 3, item(stream=F.lit(" "), payload=body)).when(k == 4, item(stream=F.lit("security_events"), payload=F.struct(n.alias("n"))))
        .otherwise(item(stream=F.when(n % 12 == 5, "security_dlq").otherwise("security_events"), payload=body))
    )
    return table(spark, d, "events").select(F.concat(n.cast("string"), F.lit("-0")).alias("stream_id"), raw.alias("dlq"))


_REASONS = "CASE event_id % 6 WHEN 0 THEN 'missing dlq field' WHEN 1 THEN 'dlq entry is not valid JSON' WHEN 2 THEN 'dlq entry must be object' WHEN 3 THEN 'dlq entry missing source stream' WHEN 4 THEN 'dlq payload missing event field' END"


@query(f"""SELECT event_id::VARCHAR || '-0' AS stream_id, {_REASONS} AS reason,
    CASE WHEN event_id % 6 IN (3, 5) THEN event_type END AS event, CASE WHEN event_id % 6 IN (3, 4, 5) THEN event_id::VARCHAR END AS n FROM events""")
def dlq_parse(spark, d):
    p = dlq.parsed(_dlq_entries(spark, d))
    return p.select("stream_id", "reason", F.try_element_at("payload", F.lit("event")).alias("event"), F.try_element_at("payload", F.lit("n")).alias("n"))


@query("SELECT event_id::VARCHAR || '-0' AS stream_id, CASE WHEN event_id % 12 = 5 THEN 'fallback' ELSE 'security_events' END AS destination FROM events WHERE event_id % 6 = 5")
def dlq_route(spark, d):
    p = dlq.parsed(_dlq_entries(spark, d)).where("reason is null")
    return p.select("stream_id", dlq.destination(F.col("source_stream"), None, "fallback", "security_dlq").alias("destination"))


@query("SELECT count(*) AS scanned, count(*) FILTER (event_id % 6 = 5) AS eligible, 0::BIGINT AS replayed, count(*) FILTER (event_id % 6 <> 5) AS skipped, 0::BIGINT AS failed, 0::BIGINT AS deleted FROM (SELECT * FROM events WHERE event_id >= 100 ORDER BY event_id LIMIT 500)")
def dlq_replay(spark, d):
    return dlq.replay(dlq.replay_plan(_dlq_entries(spark, d), "100-0", 500), "", execute=False)


@query("SELECT count(*) AS scanned, count(*) FILTER (event_id % 6 = 5) AS eligible, count(*) FILTER (event_id % 6 = 5) AS replayed, count(*) FILTER (event_id % 6 <> 5) AS skipped, 0::BIGINT AS failed, count(*) FILTER (event_id % 6 = 5) AS deleted FROM events")
def dlq_replay_execute(spark, d):
    entries = _dlq_entries(spark, d)
    return dlq.replay(dlq.replay_plan(entries, "0-0", 1 << 30), new_folder(spark, "replayed"), execute=True, delete=True)


@query("SELECT event_id::VARCHAR || '-0' AS stream_id FROM events WHERE event_id % 6 <> 5")
def dlq_remaining(spark, d):
    entries = _dlq_entries(spark, d)
    return dlq.remaining(entries, dlq.replay_plan(entries, "0-0", 1 << 30)).select("stream_id")


# --- corpus ------------------------------------------------------------------------------------------------------


@query("SELECT coalesce(lang, 'TOTAL') AS task, count(*) AS n, sum(t)::BIGINT AS tokens, max(t) AS max_tokens, (sum(t) // count(*))::BIGINT AS avg_tokens FROM (SELECT lang, floor(length(text) / 3.8::DOUBLE)::BIGINT AS t FROM documents) GROUP BY ROLLUP (lang)")
def task_rollup_total(spark, d):
    docs = table(spark, d, "documents").select(F.col("lang").alias("task"), tx.estimated_tokens(F.length("text")).alias("n_tokens"))
    return stats.task_totals(docs)


@query("SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(source) = 0 THEN 'source' ELSE 'all' END AS dimension, CASE WHEN grouping(lang) = 0 THEN lang WHEN grouping(source) = 0 THEN source END AS value, count(*) AS n, sum(t)::BIGINT AS tokens FROM (SELECT lang, source, floor(length(text) / 3.8::DOUBLE)::BIGINT AS t FROM documents) GROUP BY GROUPING SETS ((lang), (source), ())")
def grouping_sets_profile(spark, d):
    docs = table(spark, d, "documents").select("lang", "source", tx.estimated_tokens(F.length("text")).alias("t"))
    return stats.profile(docs, ["lang", "source"], "t")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def source_distribution(spark, d):
    return stats.most_common(table(spark, d, "documents"), "source")


@query("SELECT doc_id, floor(length(text) / 3.8::DOUBLE)::BIGINT AS tokens, floor(length(text) / 3.85::DOUBLE)::BIGINT AS tokens_synthesis FROM documents")
def token_estimate(spark, d):
    n = F.length("text")
    return table(spark, d, "documents").select("doc_id", tx.estimated_tokens(n).alias("tokens"), tx.estimated_tokens(n, tx.CHARS_PER_TOKEN_SYNTHESIS).alias("tokens_synthesis"))


@query("""SELECT lang, round(h, 2) AS a100_hours, round(h * 2.79, 2) AS a100_usd, round(h * 0.6, 2) AS h100_hours, round(h * 0.6 * 3.99, 2) AS h100_usd
    FROM (SELECT lang, (sum(t) * 3000 / 7000.0::DOUBLE / 3600)::DOUBLE AS h FROM (SELECT lang, floor(length(text) / 3.8::DOUBLE)::BIGINT AS t FROM documents) GROUP BY lang)""")
def training_cost(spark, d):
    docs = table(spark, d, "documents").groupBy("lang").agg(F.sum(tx.estimated_tokens(F.length("text"))).alias("t"))
    return docs.select("lang", *[c.alias(n) for n, c in stats.training_cost(F.col("t"), 3000).items()])


_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(text, '\(Citation:[^)]+\)', '', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT doc_id, {_CLEAN} AS cleaned FROM documents")
def text_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, CASE WHEN length(s) <= 120 THEN s ELSE regexp_replace(substr(s, 1, 119), ' [^ ]*$', '') || '…' END AS short FROM (SELECT doc_id, {_CLEAN} AS s FROM documents)")
def text_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.truncate(F.col("text"), 120).alias("short"))


@query(r"SELECT doc_id, len(w)::BIGINT AS n_words, array_to_string(list_transform(w, lambda x: lower(x)), ' ') AS words FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_''\-]*') AS w FROM documents)")
def word_tokens(spark, d):
    w = table(spark, d, "documents").select("doc_id", tx.word_tokens(F.col("text")).alias("w"))
    return w.select("doc_id", F.size("w").cast("long").alias("n_words"), F.array_join("w", " ").alias("words"))


@query(r"SELECT doc_id, len(w)::BIGINT AS n_words, sha256(array_to_string(list_transform(w, lambda x: lower(x)), ' ')) AS words_sha256 FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_''\-]*') AS w FROM documents)")
def word_tokens_whole(spark, d):
    w = table(spark, d, "documents").select("doc_id", tx.word_tokens(F.col("text")).alias("w"))
    return w.select("doc_id", F.size("w").cast("long").alias("n_words"), F.sha2(F.array_join("w", " "), 256).alias("words_sha256"))


_GRAMS = r"""
    w AS (SELECT doc_id AS id, list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_''\-]*'), lambda x: lower(x)) AS w FROM documents),
    v AS (SELECT item_id AS id, list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_''\-]*'), lambda x: lower(x)) AS w FROM benchmark),
    a AS (SELECT DISTINCT id, array_to_string(w[i + 1 : i + 13], ' ') AS g FROM (SELECT id, w, unnest(range(0, len(w) - 12)) AS i FROM w WHERE len(w) >= 13)),
    b AS (SELECT DISTINCT id, array_to_string(w[i + 1 : i + 13], ' ') AS g FROM (SELECT id, w, unnest(range(0, len(w) - 12)) AS i FROM v WHERE len(w) >= 13)),
    s AS (SELECT a.id AS text_id, b.id AS chunk_id, count(*) AS n_shared FROM a JOIN b USING (g) GROUP BY 1, 2)
"""


def _shared(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("text_id"), "text")
    return leak.shared_shingles(docs, table(spark, d, "benchmark").select(F.col("item_id").alias("chunk_id"), "text"))


@query(f"WITH {_GRAMS} SELECT * FROM s")
def ngram_leak_13(spark, d):
    return _shared(spark, d)


@query(f"WITH {_GRAMS} SELECT (SELECT count(*) FROM documents) AS records, count(DISTINCT text_id) AS leaks, round(100.0::DOUBLE * count(DISTINCT text_id) / (SELECT count(*) FROM documents), 2) AS leak_rate FROM s")
def leak_rate(spark, d):
    leaks = _shared(spark, d).agg(F.countDistinct("text_id").alias("leaks"))
    n = table(spark, d, "documents").agg(F.count("*").alias("records"))
    both = n.select("records", F.lit(0).cast("long").alias("leaks")).unionByName(leaks.select(F.lit(0).cast("long").alias("records"), "leaks")).agg(F.sum("records").alias("records"), F.sum("leaks").alias("leaks"))
    return both.withColumn("leak_rate", F.round(F.col("leaks") * 100.0 / F.greatest("records", F.lit(1)), 2))


@query(f"WITH {_GRAMS} SELECT text_id, max(n_shared) AS most FROM s GROUP BY text_id ORDER BY most DESC, text_id LIMIT 5")
def leak_first_examples(spark, d):
    return _shared(spark, d).groupBy("text_id").agg(F.max("n_shared").alias("most")).orderBy(F.desc("most"), "text_id").limit(5)


#: A document as a record that names, in order, pieces of two documents and of itself; pieces are 6 to 30 words long.
_CHUNKS = r"""
    w AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_''\-]*'), lambda x: lower(x)) AS w FROM documents),
    c AS (SELECT doc_id AS chunk_id, w[4 : 9 + (doc_id % 25)::INT] AS c FROM w),
    named AS (
        SELECT doc_id, w, unnest([doc_id + 1, doc_id + 2, doc_id]) AS chunk_id, unnest([0, 1, 2]) AS place FROM w WHERE doc_id % 4 <> 3
    ),
    pairs AS (SELECT named.doc_id, place, chunk_id, ' ' || array_to_string(w, ' ') || ' ' AS t, c FROM named JOIN c USING (chunk_id)),
    runs AS (SELECT doc_id, place, chunk_id, n, max(contains(t, ' ' || array_to_string(c[i + 1 : i + n], ' ') || ' ')) AS has
             FROM (SELECT *, unnest(range(0, len(c) - n + 1)) AS i FROM (SELECT *, unnest(range(4, 26)) AS n FROM pairs) WHERE len(c) >= n) GROUP BY ALL),
    lcs AS (SELECT pairs.doc_id AS text_id, pairs.place, pairs.chunk_id, coalesce(max(n) FILTER (has), 0)::INT AS lcs FROM pairs LEFT JOIN runs USING (doc_id, place, chunk_id) GROUP BY ALL)
"""


def _records(spark, d) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").withColumn("w", tx.word_tokens(tx.first_words(F.col("text"), 33)))
    k = F.col("doc_id")
    chunk = docs.select(k.cast("string").alias("chunk_id"), F.array_join(F.slice("w", F.lit(4), F.greatest(6 + k % 25, F.lit(0)).cast("int")), " ").alias("text"))
    valid = F.when(k % 5 == 0, '<reasoning>x</reasoning> <answer>{"a": [1]}</answer>').when(k % 5 == 1, "<reasoning></reasoning><answer>{bad</answer>").when(k % 5 == 2, "</answer><answer>{}<reasoning></reasoning>").otherwise("<answer>1</answer>")
    names = F.when(k % 4 != 3, F.array((k + 1).cast("string"), (k + 2).cast("string")))
    recs = docs.select(k.alias("text_id"), "text", valid.alias("answer_text"), F.when(k % 3 != 0, F.concat(F.lit("kind-"), (k % 3).cast("string"))).alias("synthesis"), names.alias("source_ids"), F.when(k % 4 != 3, k.cast("string")).alias("source_chunk"))
    return recs, chunk


@query(f"WITH {_CHUNKS} SELECT text_id, chunk_id::VARCHAR AS chunk_id, lcs FROM lcs")
def longest_common_run(spark, d):
    return leak.longest_of_named(*_records(spark, d)).select("text_id", "chunk_id", "lcs")


@query(f"""WITH {_CHUNKS}, l AS (SELECT text_id, min(place) FILTER (lcs >= 13) AS leak FROM lcs GROUP BY 1),
    s AS (SELECT text_id, max(lcs) AS lcs, any_value(leak) AS leak FROM lcs JOIN l USING (text_id) WHERE leak IS NULL OR place <= leak GROUP BY 1),
    r AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '?' ELSE 'kind-' || doc_id % 3 END AS kind, doc_id % 5 = 0 AS valid, lcs, leak FROM documents LEFT JOIN s ON text_id = doc_id),
    k AS (SELECT kind, count(*) AS n, count(leak) AS leaks FROM r GROUP BY kind)
    SELECT count(*) AS total, count(*) FILTER (valid) AS structurally_valid, round(100.0::DOUBLE * count(*) FILTER (valid) / count(*), 2) AS structural_validity_pct,
           count(lcs) AS with_source_chunk, count(leak) AS verbatim_leaked, round(100.0::DOUBLE * count(leak) / greatest(count(lcs), 1), 2) AS leak_rate_pct, max(lcs) AS max_lcs_words_observed,
           (SELECT '{{' || string_agg('"' || kind || '":' || n, ',' ORDER BY kind) || '}}' FROM k) AS totals_by_synthesis, (SELECT '{{' || string_agg('"' || kind || '":' || leaks, ',' ORDER BY kind) FILTER (leaks > 0) || '}}' FROM k) AS leaks_by_synthesis
    FROM r""")
def leak_audit(spark, d):
    return leak.audit(*_records(spark, d))


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_doc, doc_id <> min(doc_id) OVER (PARTITION BY sha256(text)) AS is_duplicate FROM documents")
def exact_duplicates_first_seen(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    got = dedupe.first_seen(docs, F.sha2("text", 256), [F.col("doc_id")], F.col("doc_id"))
    return got.select("doc_id", F.col("first_place").alias("first_doc"), "is_duplicate")


_MD5 = "('0x' || substr(md5({}), 1, 2))::INT % 100"


@query(f"SELECT doc_id, CASE WHEN {_MD5.format('doc_id::VARCHAR')} < 14 THEN 'eval' ELSE 'train' END AS split FROM documents")
def stable_split_md5(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.stable_split(F.col("doc_id").cast("string"), 14).alias("split"))


@query("SELECT doc_id, CASE WHEN r <= greatest(50, n // 10) THEN 'eval' ELSE 'train' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('13:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents)")
def holdout_topn_by_hash(spark, d):
    return split.holdout(table(spark, d, "documents").select("doc_id"), "doc_id", 13)


@query("SELECT doc_id, CASE WHEN r <= (n * 0.9::DOUBLE)::BIGINT THEN 'train' ELSE 'eval' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents)")
def ratio_split(spark, d):
    return split.ratio_split(table(spark, d, "documents").select("doc_id"), "doc_id", 42, 0.1, whole=round)


@query("SELECT item_id FROM (SELECT item_id FROM benchmark ORDER BY md5('5:' || item_id), item_id LIMIT 12) ORDER BY item_id")
def sample_cases(spark, d):
    return split.sample(table(spark, d, "benchmark").select("item_id"), "item_id", 12, 5, "item_id")


@query("SELECT doc_id, md5('42:' || doc_id) AS place FROM documents ORDER BY place, doc_id")
def seeded_shuffle(spark, d):
    return split.shuffled(table(spark, d, "documents").select("doc_id", tx.seeded(F.col("doc_id"), 42).alias("place")), "doc_id", 42)


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('3:' || doc_id), doc_id) AS case_index FROM documents")
def case_index(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return ranked(docs, [tx.seeded(F.col("doc_id"), 3), F.col("doc_id")], "case_index")


#: Quotas as in ``split.quotas``, where what is missing or over is less than the number of groups.
_STRATA = """
    WITH g AS (SELECT lang AS grp, count(*) AS n FROM documents GROUP BY 1),
    t AS (SELECT sum(n) AS total, least(round_even(sum(n) * 0.05::DOUBLE, 0), sum(n - 1)) AS wanted FROM g),
    s AS (SELECT grp, n, wanted, wanted * n / total AS share, least(n - 1, greatest(CASE WHEN n > 1 THEN 1 ELSE 0 END, floor(wanted * n / total))) AS got FROM g, t),
    d AS (SELECT *, wanted - sum(got) OVER () AS missing, row_number() OVER (ORDER BY share - got DESC, n DESC, grp) AS up, row_number() OVER (PARTITION BY got > 0 ORDER BY share - floor(share), got, grp) AS down FROM s),
    q AS (SELECT grp, got + CASE WHEN missing >= up THEN 1 WHEN -missing >= down AND got > 0 THEN -1 ELSE 0 END AS quota FROM d)
    SELECT grp, doc_id, CASE WHEN r <= quota THEN 'eval' ELSE 'train' END AS split
    FROM (SELECT lang AS grp, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id), doc_id) AS r FROM documents) JOIN q USING (grp)
"""


@query(_STRATA)
def stratified_split(spark, d):
    return split.stratified_split(table(spark, d, "documents").select("doc_id", F.col("lang").alias("grp")), "grp", "doc_id", 7)


@query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def role_histogram(spark, d):
    return stats.role_histogram(chat_records(spark, d))


@query("SELECT conv_id, turn, role AS \"from\", CASE WHEN role = 'system' THEN 'replaced' ELSE text END AS value FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations)")
def chat_to_sharegpt(spark, d):
    c = table(spark, d, "conversations")
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    rows = c.groupBy("conv_id").agg(turns.alias("t")).withColumn("conversations", records.conversations(F.col("t"), "replaced"))
    return rows.select("conv_id", F.explode(F.arrays_zip(F.col("t.turn").alias("turn"), F.col("conversations").alias("c"))).alias("x")).select("conv_id", "x.turn", "x.c.from", "x.c.value")


@query("""SELECT item_id, substr(sha256('["' || replace(replace(text, '"', '\\"'), chr(10), '\\n') || '"]'), 1, 20) AS id FROM benchmark""")
def content_sha_ids(spark, d):
    return table(spark, d, "benchmark").select("item_id", tx.content_id(20, F.col("text")).alias("id"))


@query("SELECT doc_id, phrase FROM (SELECT doc_id, lower(text) AS t, unnest(['this ', 'the passage says', 'page ', 'that the', 'worthless']) AS phrase FROM documents) WHERE contains(t, phrase)")
def forbidden_phrase_lint(spark, d):
    check = audit.phrases(("this ", "the passage says", "page ", "that the", "worthless"))
    return table(spark, d, "documents").select("doc_id", F.array("text").alias("contents")).select("doc_id", F.explode(check.finds()).alias("phrase"))


_STYLES = "CASE p_partkey % 5 WHEN 0 THEN 'mitre-T' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') WHEN 1 THEN 'owasp-2021-a' || lpad((p_partkey % 100)::VARCHAR, 2, '0') WHEN 2 THEN 'CVE-2024-1' WHEN 3 THEN 'concept-' || replace(p_name, ' ', '-') ELSE 'sigma-' || p_brand END"


@query("SELECT s AS source_id, regexp_full_match(s, '" + "|".join(audit.STYLES_STRICT) + f"') AS canonical FROM (SELECT {_STYLES} AS s FROM part)")
def source_id_style(spark, d):
    k = F.col("p_partkey")
    s = (
        F.when(k % 5 == 0, F.concat(F.lit("mitre-T"), F.lpad((k % 10000).cast("string"), 4, "0")))
        .when(k % 5 == 1, F.concat(F.lit("owasp-2021-a"), F.lpad((k % 100).cast("string"), 2, "0"))).when(k % 5 == 2, "CVE-2024-1")
        .when(k % 5 == 3, F.concat(F.lit("concept-"), F.replace("p_name", F.lit(" "), F.lit("-")))).otherwise(F.concat(F.lit("sigma-"), F.col("p_brand")))
    )
    return table(spark, d, "part").select(s.alias("source_id")).withColumn("canonical", F.col("source_id").rlike(audit.one_of(audit.STYLES_STRICT)))


@query("SELECT o_orderkey, list_aggregate(list_filter(['a', 'b', 'o_orderkey', 'o_orderstatus'], lambda x: x NOT IN ('o_orderkey', 'o_custkey', 'o_orderstatus')), 'string_agg', ',') AS missing FROM orders")
def required_keys_except(spark, d):
    doc = table(spark, d, "orders").select("o_orderkey", F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus")).alias("doc"))
    return doc.select("o_orderkey", F.array_join(audit.missing_keys(("a", "b", "o_orderkey", "o_orderstatus"), "doc"), ",").alias("missing"))


# --- evaluation, lookups and splits over the business tables -------------------------------------------------------


def _results(spark, d):
    """An order as one model's answer to a case: the priority is the model, some fail, some answers parse."""
    k = F.col("o_orderkey")
    content = F.when(k % 4 == 0, "no tags").when(k % 4 == 1, '<answer>{"summary": 1, "actions": []}</answer>').when(k % 4 == 2, "<reasoning>r</reasoning><answer>{bad</answer>").otherwise("<reasoning>r</reasoning>\n<answer> [1] </answer>")
    rows = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("label"), (k % 100).alias("case_id"), k.alias("row_id"), F.when(k % 17 == 0, "timeout").alias("error"), content.alias("content"),
        (F.col("o_custkey") % 50 / F.lit(4.0)).alias("latency_seconds"), (k % 1000).alias("completion_tokens"), (k % 300).alias("prompt_tokens"), (k % 1000 + k % 300).alias("total_tokens"), F.when(k % 3 == 0, "length").when(k % 3 == 1, "stop").alias("finish_reason"),
    )
    return evalrun.score_content(rows)


_RESULTS = """r AS (SELECT o_orderpriority AS label, o_orderkey % 100 AS case_id, o_orderkey % 17 = 0 AS bad, o_orderkey % 4 = 1 AS valid, (o_custkey % 50) / 4.0::DOUBLE AS lat, o_orderkey % 1000 AS tok, o_orderkey % 300 AS prompt, o_orderkey % 4 AS k4,
    CASE o_orderkey % 3 WHEN 0 THEN 'length' WHEN 1 THEN 'stop' ELSE 'unknown' END AS reason FROM orders)"""


@query(f"""WITH {_RESULTS}, f AS (SELECT label, '{{' || string_agg('"' || reason || '":' || n, ',' ORDER BY reason) || '}}' AS finish_reasons FROM (SELECT label, reason, count(*) AS n FROM r WHERE NOT bad GROUP BY 1, 2) GROUP BY label)
    SELECT label, count(*) AS cases, count(*) FILTER (bad) AS errors, count(*) FILTER (valid AND NOT bad) AS valid_json, round(avg(lat) FILTER (NOT bad), 3) AS avg_latency, max(lat) FILTER (NOT bad) AS max_latency, (sum(tok) FILTER (NOT bad))::BIGINT AS completion_tokens, (sum(prompt) FILTER (NOT bad))::BIGINT AS prompt_tokens, (sum(tok + prompt) FILTER (NOT bad))::BIGINT AS total_tokens,
    count(*) FILTER (NOT bad AND k4 >= 2) AS valid_reasoning_tags, count(*) FILTER (NOT bad AND k4 >= 1) AS valid_answer_tags, any_value(finish_reasons) AS finish_reasons
    FROM r JOIN f USING (label) GROUP BY label""")
def eval_summary(spark, d):
    return evalrun.summary(_results(spark, d))


@query("SELECT o_orderkey AS row_id, o_orderkey % 4 >= 2 AS reasoning_open, o_orderkey % 4 > 0 AS answer_open, o_orderkey % 4 = 1 AS answer_json_valid, CASE WHEN o_orderkey % 4 = 1 THEN 'actions,summary' ELSE '' END AS answer_keys FROM orders")
def response_scores(spark, d):
    return _results(spark, d).select("row_id", "reasoning_open", "answer_open", "answer_json_valid", F.array_join("answer_keys", ",").alias("answer_keys"))


def _judged(spark, d):
    k = F.col("l_orderkey")
    li = table(spark, d, "lineitem").select((k % 500).alias("case_id"), F.concat(F.lit("model-"), (F.col("l_linenumber") % 4).cast("string")).alias("label"), F.col("l_quantity").alias("q"))
    return li.groupBy("case_id", "label").agg(F.max("q").alias("score"))


@query("""WITH j AS (SELECT l_orderkey % 500 AS case_id, 'model-' || (l_linenumber % 4) AS label, max(l_quantity) AS score FROM lineitem GROUP BY 1, 2),
    w AS (SELECT label, count(*) AS wins FROM (SELECT label, row_number() OVER (PARTITION BY case_id ORDER BY score DESC, label) AS r FROM j) WHERE r = 1 GROUP BY label)
    SELECT j.label, round(avg(score), 2) AS avg_score, coalesce(any_value(w.wins), 0) AS wins FROM j LEFT JOIN w USING (label) GROUP BY j.label""")
def case_winner(spark, d):
    return evalrun.winners(_judged(spark, d))


@query("SELECT b.item_id, m.label FROM benchmark b, (SELECT 'model-' || r_regionkey AS label FROM region) m")
def model_case_cross(spark, d):
    models = table(spark, d, "region").select(F.concat(F.lit("model-"), F.col("r_regionkey").cast("string")).alias("label"))
    return evalrun.model_cases(models, table(spark, d, "benchmark").select("item_id"))


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 20")
def technique_inner_lookup(spark, d):
    n = table(spark, d, "nation").where("n_nationkey < 20")
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("SELECT c_custkey, coalesce(n_name, c_nationkey::VARCHAR) AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def mitigation_left_lookup(spark, d):
    n = table(spark, d, "nation").where("n_nationkey < 20")
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.coalesce("n_name", F.col("c_nationkey").cast("string")).alias("nation"))


@query("SELECT s_suppkey, coalesce(n, 0) AS n_parts FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY l_suppkey) ON s_suppkey = l_suppkey")
def aggregated_left_lookup(spark, d):
    n = table(spark, d, "lineitem").where("l_quantity > 45").groupBy("l_suppkey").agg(F.count("*").alias("n_parts"))
    return table(spark, d, "supplier").join(n, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", F.coalesce("n_parts", F.lit(0)).alias("n_parts"))


@query("SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') THEN 'eval' ELSE 'train' END AS split FROM orders")
def train_eval_semi_anti(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    chosen = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return o.join(chosen, "o_custkey", "left_semi").select("o_orderkey", F.lit("eval").alias("split")).unionByName(o.join(chosen, "o_custkey", "left_anti").select("o_orderkey", F.lit("train").alias("split")))


@query("SELECT 'document' AS kind, doc_id AS id, source FROM documents UNION ALL SELECT 'benchmark', item_id, NULL FROM benchmark")
def corpus_union(spark, d):
    return records.merge(
        table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "source"),
        table(spark, d, "benchmark").select(F.lit("benchmark").alias("kind"), F.col("item_id").alias("id")),
    )


@query("SELECT source, '{' || string_agg('\"' || lang || '\":' || n, ',' ORDER BY lang) || '}' AS histogram FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY source")
def histogram_json(spark, d):
    return stats.histogram_json(table(spark, d, "documents"), "source", "lang")


_FILES = "f AS (SELECT source || '.jsonl' AS file, lang AS task, floor(length(text) / 3.8::DOUBLE)::BIGINT AS t FROM documents)"


def _file_records(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(F.concat("source", F.lit(".jsonl")).alias("file"), F.col("lang").alias("task"), tx.estimated_tokens(F.length("text")).alias("n_tokens"))


@query(f"""WITH {_FILES}, h AS (SELECT file, '{{' || string_agg('"' || task || '":' || n, ',' ORDER BY task) || '}}' AS tasks FROM (SELECT file, task, count(*) AS n FROM f WHERE task IS NOT NULL GROUP BY 1, 2) GROUP BY file)
    SELECT file, CASE WHEN file < 'm' THEN 'early' ELSE 'other' END AS domain, count(*) AS records, sum(t)::BIGINT AS tokens, any_value(tasks) AS tasks FROM f LEFT JOIN h USING (file) GROUP BY file""")
def file_registry(spark, d):
    rows = _file_records(spark, d)
    topics = rows.select("file").distinct().where("file < 'm'").withColumn("domain", F.lit("early"))
    return stats.registry(rows, topics).select("file", "domain", "records", "tokens", "tasks")


@query(f"WITH {_FILES} SELECT file, count(*) AS records, sum(t)::BIGINT AS tokens, length(file)::BIGINT AS bytes, sha256(file) AS sha256 FROM f GROUP BY file")
def file_infos(spark, d):
    rows = _file_records(spark, d)
    digests = rows.select("file").distinct().select("file", F.length("file").cast("long").alias("bytes"), F.sha2("file", 256).alias("sha256"))
    return stats.file_info(rows, digests)


@query("SELECT coalesce(lang, 'unknown') AS lang, count(*) AS n FROM documents GROUP BY 1 ORDER BY 1")
def count_by_key(spark, d):
    return stats.count_by(table(spark, d, "documents"), F.col("lang"), "lang")


# --- audits of records -------------------------------------------------------------------------------------------


def _audit_lines(spark, d) -> DataFrame:
    """A conversation as a line of one of five files, spoilt in one of thirteen ways by its number."""
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.coalesce(F.min("text"), F.lit("")).alias("t"))
    n, text = F.col("conv_id"), lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    k, number = n % 13, n.cast("string")
    answer = (
        F.when(k == 4, '{"summary":').when(k == 12, '{"summary":1,"evidence":1}').when(k == 11, '{"summary":1,"evidence":2,"hypotheses":3,"actions":0}')
        .otherwise(text('{"summary":1,"evidence":2,"hypotheses":3,"actions":', number, ".5}"))
    )
    reasoning = text("<reasoning>", F.repeat(F.lit("r"), (5 + n % 30).cast("int")), "</reasoning>")
    said = F.when(k == 3, text(reasoning, " nothing")).otherwise(text(reasoning, "\n<answer> ", answer, " </answer>"))
    asked = F.when(k == 11, text(F.col("t"), " The passage says")).otherwise(F.col("t"))
    message = lambda role, content: F.struct(role.alias("role"), content.alias("content"))
    three = F.array(message(F.when(k == 2, "user").otherwise("system"), F.lit("s")), message(F.lit("user"), asked), message(F.lit("assistant"), said))
    messages = F.to_json(F.slice(three, F.lit(1), F.when(k == 1, 2).otherwise(3)))
    ids = F.when(k == 9, "[]").when(k == 10, '["odd id","mitre-T1059.001"]').otherwise(text('["concept-', number, '"]'))
    book, split = F.when(k == 7, "other").otherwise(text("c", (n % 5).cast("string"))), F.when(k == 8, "false").otherwise("true")
    meta = F.when(k == 5, "3").when(k == 6, text('{"source_ids":', ids, ',"source_book":"', book, '","synthesized":true}')).otherwise(
        text('{"task":"t","source_ids":', ids, ',"source_book":"', book, '","split":"train","synthesized":', split, "}")
    )
    value = F.when(k == 0, "{bad").otherwise(text('{"messages":', messages, ',"meta":', meta, "}"))
    return c.select(text("c", (n % 5).cast("string"), ".jsonl").alias("file"), (F.floor(n / 5) + 1).alias("line"), value.alias("value"))


def _phrase_sql(phrases: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{p}'" for p in phrases)
    return f"SELECT conv_id, 'phrase', p FROM (SELECT *, unnest([{listed}]) AS p FROM u WHERE k >= 2) WHERE contains(lower('s\n' || q || '\n' || a), p)"


_LINES = """
    u AS (
        SELECT *, CASE k WHEN 11 THEN t || ' The passage says' ELSE t END AS q, 'c' || conv_id % 5 AS book, 'c' || conv_id % 5 || '.jsonl:' || (conv_id // 5 + 1) AS location,
               '<reasoning>' || repeat('r', (5 + conv_id % 30)::INT) || '</reasoning>' || CASE WHEN k = 3 THEN ' nothing' ELSE '<answer></answer>' END AS a,
               CASE k WHEN 4 THEN '{' WHEN 12 THEN 'short' WHEN 11 THEN 'same' ELSE conv_id::VARCHAR END AS answer, CASE k WHEN 9 THEN 'none' WHEN 10 THEN 'odd' ELSE conv_id::VARCHAR END AS ids
        FROM (SELECT conv_id, conv_id % 13 AS k, coalesce(min(text), '') AS t FROM conversations GROUP BY conv_id)
    ),
    w AS (SELECT *, row_number() OVER (ORDER BY book, conv_id) AS place FROM u WHERE k NOT IN (0, 1, 5)),
    rep AS (
        SELECT conv_id, 'repeated_prompt' AS code, first(location) OVER (PARTITION BY q ORDER BY place) AS detail, row_number() OVER (PARTITION BY q ORDER BY place) AS r FROM w
        UNION ALL SELECT conv_id, 'repeated_answer', first(location) OVER (PARTITION BY answer ORDER BY place), row_number() OVER (PARTITION BY answer ORDER BY place) FROM w WHERE k <> 3
        UNION ALL SELECT conv_id, 'repeated_task_sources', first(location) OVER (PARTITION BY ids, k = 6 ORDER BY place), row_number() OVER (PARTITION BY ids, k = 6 ORDER BY place) FROM w
    ),
    one AS (
        SELECT conv_id, 'json' AS code, '' AS detail FROM u WHERE k = 0
        UNION ALL SELECT conv_id, 'messages', '' FROM u WHERE k = 1
        UNION ALL SELECT conv_id, 'roles', 'user,user,assistant' FROM u WHERE k = 2
        UNION ALL SELECT conv_id, 'tags', 'answer' FROM u WHERE k = 3
        UNION ALL SELECT conv_id, 'answer_block', '' FROM u WHERE k = 3
        UNION ALL SELECT conv_id, 'answer_json', '' FROM u WHERE k = 4
        UNION ALL SELECT conv_id, 'meta', '' FROM u WHERE k = 5
        UNION ALL SELECT conv_id, 'meta_fields', 'task,split' FROM u WHERE k = 6
        UNION ALL SELECT conv_id, 'split', '' FROM u WHERE k = 6
        UNION ALL SELECT conv_id, 'source_book', 'other' FROM u WHERE k = 7
        UNION ALL SELECT conv_id, 'synthesized', '' FROM u WHERE k = 8
        UNION ALL SELECT conv_id, 'source_ids', '' FROM u WHERE k = 9
    ),
    strict AS (
        SELECT * FROM one
        UNION ALL SELECT conv_id, 'source_id_style', 'odd id' FROM u WHERE k = 10
        UNION ALL SELECT conv_id, 'answer_keys', 'actions,hypotheses' FROM u WHERE k = 12
        UNION ALL SELECT conv_id, 'reasoning_length', (5 + conv_id % 30)::VARCHAR FROM u WHERE k >= 2 AND conv_id % 30 < 15
        UNION ALL {phrases}
        UNION ALL SELECT conv_id, code, detail FROM rep WHERE r > 1
    )
""".replace("{phrases}", _phrase_sql(audit.PHRASES_STRICT))

_STRICT_CHECKS = lambda: (*audit.STRICT, audit.short_reasoning(20), audit.core_keys(), audit.phrases(audit.PHRASES_STRICT), *audit.id_styles(audit.STYLES_STRICT))


@query(f"WITH {_LINES} SELECT location, code, detail FROM strict JOIN u USING (conv_id)")
def audit_strict(spark, d):
    return audit.strict_audit(audit.parse(_audit_lines(spark, d)), _STRICT_CHECKS(), repeats=True).select("location", "code", "detail")


@query(f"""WITH {_LINES}, n AS (SELECT conv_id, count(*) AS issues FROM strict GROUP BY conv_id)
    SELECT book || '.jsonl' AS file, count(*) AS total_lines, count(*) FILTER (k NOT IN (0, 1, 5)) AS valid_records, coalesce(sum(issues), 0)::BIGINT AS issues FROM u LEFT JOIN n USING (conv_id) GROUP BY book""")
def audit_report(spark, d):
    parsed = audit.parse(_audit_lines(spark, d))
    return audit.report(audit.audited(parsed, _STRICT_CHECKS()), audit.duplicates(parsed))


@query(f"WITH {_LINES} SELECT location, code, CASE WHEN code = 'tags' THEN '' ELSE detail END AS detail FROM one JOIN u USING (conv_id) WHERE code IN ('json', 'messages', 'roles', 'tags', 'meta', 'meta_fields', 'synthesized')")
def audit_basic(spark, d):
    return audit.basic_audit(audit.parse(_audit_lines(spark, d))).select("location", "code", "detail")


@query(f"""WITH {_LINES}, r AS (
        SELECT * FROM one UNION ALL SELECT conv_id, 'source_id_style', 'odd id' FROM u WHERE k = 10 UNION ALL SELECT conv_id, 'answer_keys', 'actions,hypotheses' FROM u WHERE k = 12
        UNION ALL {_phrase_sql(audit.PHRASES_RANGE)})
    SELECT location, code, detail FROM r JOIN u USING (conv_id) WHERE conv_id // 5 + 1 BETWEEN 3 AND 40""")
def audit_range(spark, d):
    return audit.range_audit(audit.parse(_audit_lines(spark, d)), 3, 40).select("location", "code", "detail")


@query(f"""WITH {_LINES} SELECT location, CASE k WHEN 0 THEN 'json' WHEN 1 THEN 'messages' WHEN 2 THEN 'roles' WHEN 3 THEN 'answer_block' WHEN 4 THEN 'answer_json' WHEN 5 THEN 'meta' WHEN 6 THEN 'split' WHEN 7 THEN 'source_book' WHEN 8 THEN 'synthesized' WHEN 9 THEN 'source_ids' END AS error
    FROM (SELECT *, CASE WHEN k > 1 AND k <> 2 AND trim(q) = '' THEN TRUE END AS blank FROM u) WHERE k < 10 AND blank IS NULL UNION ALL SELECT location, 'content' FROM u WHERE k > 2 AND trim(q) = ''""")
def audit_export_errors(spark, d):
    return audit.export_errors(audit.parse(_audit_lines(spark, d)))


# --- generators of records over the knowledge view ---------------------------------------------------------------


_KNOWLEDGE = """
    t AS (
        SELECT p_partkey AS k, 'T' || lpad(p_partkey::VARCHAR, 6, '0') AS id, p_name AS name, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'x' END AS description, p_brand,
               ['execution', 'discovery', 'impact', 'collection'][(p_partkey % 4 + 1)::INT] AS tactic
        FROM part
    ),
    r AS (
        SELECT o_orderkey AS k, 'rule-' || o_orderkey AS rule_id, ['critical', 'High', 'informational', 'odd', NULL][(o_orderkey % 5 + 1)::INT] AS level, o_orderkey % 11 <> 0 AS told, o_orderkey % 13 <> 0 AS readable,
               CASE WHEN o_custkey % 6 = 0 THEN [] ELSE ['T' || lpad((o_custkey % 300)::VARCHAR, 6, '0'), 'T' || lpad((o_custkey % 7 + 100)::VARCHAR, 6, '0')] END AS ids
        FROM orders
    ),
    s AS (
        SELECT event_id AS n, [1, 3, 11, 22, 13][(event_id % 5 + 1)::INT] AS eid, ['Image', 'DestinationHostname', 'TargetFilename', 'QueryName', 'TargetObject'][(event_id % 5 + 1)::INT] AS field, event_id % 4 <> 0 AS included,
               event_id % 9 = 1 AS untold, event_id % 9 = 0 AS brief, CASE WHEN event_id % 10 = 3 THEN [] ELSE ['T' || lpad((user_id % 400)::VARCHAR, 6, '0'), 'T' || lpad((event_id % 3)::VARCHAR, 6, '0')] END AS ids
        FROM events
    )
"""


def _facts(made: DataFrame, **more) -> DataFrame:
    """sources and split_key of records, and columns of their answer (paths) or of a message (expressions)."""
    answer = tx.tagged(F.col("messages")[2]["content"], "answer")
    cols = [(F.get_json_object(answer, v) if isinstance(v, str) else v).alias(c) for c, v in more.items()]
    return made.select(F.array_join("meta.source_ids", ",").alias("sources"), F.col("meta.split_key").alias("split_key"), *cols)


@query(f"""WITH {_KNOWLEDGE} SELECT id AS sources, id AS split_key, name, '["' || upper(tactic[1]) || tactic[2:] || '"]' AS tactics,
    CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 5 <> 0 THEN 1 ELSE 0 END AS pointers, k % 3 AS mitigations FROM t WHERE description <> ''""")
def gen_technique_explanation(spark, d):
    answer = tx.tagged(F.col("messages")[2]["content"], "answer")
    count = lambda path: F.coalesce(F.json_array_length(F.get_json_object(answer, path)), F.lit(0))
    return _facts(generate.explanations(knowledge.techniques(spark, d)), name="$.name", tactics="$.tactics", pointers=count("$.detection_pointers"), mitigations=count("$.top_mitigations"))


@query(f"""WITH {_KNOWLEDGE} SELECT id || ',G' || k % 9 AS sources, id AS split_key, CASE WHEN k % 8 = 1 THEN 'intrusion-set' ELSE 'malware' END AS actor_type,
    'The group ran [redacted' || ']' || ' with ' || trim(repeat('x ', 20)) AS said FROM t WHERE k % 4 = 1""")
def gen_procedure_to_technique(spark, d):
    # ids of six digits are no technique ids of the text's pattern, so they are shortened to four here
    t = knowledge.techniques(spark, d).withColumn("procedure_examples", F.transform("procedure_examples", lambda p: p.withField("procedure", F.regexp_replace(p["procedure"], "T[0-9]+", "T1059"))))
    said = F.regexp_extract(F.col("messages")[1]["content"], r"The group[^\n]*", 0)
    return _facts(generate.procedures(t), actor_type="$.actor_attribution.type", said=said)


@query(f"WITH {_KNOWLEDGE} SELECT rule_id || ',' || id AS sources, id AS split_key, id AS primary_technique, level AS severity, '[\"' || array_to_string(ids, '\",\"') || '\"]' AS every FROM r JOIN t ON ids[1] = id WHERE told AND len(ids) > 0")
def gen_sigma_to_technique(spark, d):
    made = generate.rule_techniques(knowledge.rules(spark, d), knowledge.techniques(spark, d))
    return _facts(made, primary_technique="$.primary_technique", severity="$.severity", every="$.all_techniques")


@query(f"""WITH {_KNOWLEDGE}, n AS (SELECT i, count(*) AS n FROM (SELECT unnest(list_distinct(ids)) AS i FROM r) GROUP BY i)
    SELECT id || ',DS' || k AS sources, id AS split_key, coalesce(n, 0)::VARCHAR AS n_rules FROM t LEFT JOIN n ON i = id WHERE description <> '' AND k % 5 <> 0""")
def gen_technique_to_detection(spark, d):
    return _facts(generate.detections(knowledge.techniques(spark, d), knowledge.rules(spark, d)), n_rules="$.existing_sigma_rules_available")


@query(f"""WITH {_KNOWLEDGE}, e AS (SELECT n, pos, i || coalesce(' (' || name || ')', '') AS said FROM (SELECT n, unnest(ids) AS i, generate_subscripts(ids, 1) AS pos FROM s) LEFT JOIN t ON id = i),
    m AS (SELECT n, string_agg(said, ', ' ORDER BY pos) AS related FROM e GROUP BY n)
    SELECT 'sysmon:' || eid || ':' || field AS sources, CASE WHEN len(ids) > 0 THEN ids[1] ELSE 'sysmon:' || eid || ':' || field || ':v' || n END AS split_key, CASE WHEN included THEN 'true' ELSE 'false' END AS suspicious, coalesce(related, '') AS related
    FROM s LEFT JOIN m USING (n) WHERE NOT untold AND NOT brief""")
def gen_sysmon_rationale(spark, d):
    related = F.regexp_extract(F.col("messages")[2]["content"], r"Related: ([^.]*)\.", 1)
    return _facts(generate.sysmon_rationales(knowledge.sysmon(spark, d), knowledge.techniques(spark, d)), suspicious="$.is_suspicious_pattern", related=related)


@query(f"""WITH {_KNOWLEDGE}, a AS (SELECT *, CASE lower(level) WHEN 'critical' THEN 'critical' WHEN 'high' THEN 'high' WHEN 'informational' THEN 'low' ELSE 'medium' END AS author FROM r JOIN t ON ids[1] = id WHERE told AND readable AND len(ids) > 0)
    SELECT id || ',sysmon:' || eid AS sources, id AS split_key, id AS technique_id, CASE WHEN tactic IN ('execution', 'impact') THEN 'high' ELSE 'medium' END AS severity FROM s JOIN t ON ids[1] = id WHERE included AND NOT untold AND len(ids) > 0
    UNION ALL SELECT id || ',' || rule_id, id, id, CASE WHEN tactic IN ('execution', 'impact') AND author IN ('medium', 'high') THEN 'high' ELSE author END FROM a""")
def gen_event_to_technique(spark, d):
    t = knowledge.techniques(spark, d)
    made = generate.sysmon_triage(knowledge.sysmon(spark, d), t).unionByName(generate.rule_triage(knowledge.rules(spark, d), t))
    return _facts(made, technique_id="$.technique_id", severity="$.severity")


@query(f"""WITH {_KNOWLEDGE}, e AS (SELECT id, k, j, (k + j) % 60 AS m FROM t, (SELECT unnest([0, 1]) AS j) WHERE j < k % 3),
    l AS (SELECT id, string_agg('- M' || m || ' Mitigation ' || m || rtrim(': ' || CASE WHEN m % 2 = 0 THEN 'note ' || k ELSE coalesce('Full ' || s_name, '') END), chr(10) ORDER BY j) AS lines FROM e LEFT JOIN supplier ON s_suppkey = m AND s_suppkey < 40 GROUP BY id)
    SELECT id AS sources, id AS split_key, lines FROM l""")
def gen_mitigation_recommend(spark, d):
    lines = F.regexp_extract(F.col("messages")[2]["content"], r"(?s)First:\n(.*?)\s*</reasoning>", 1)
    return _facts(generate.mitigation_advice(knowledge.techniques(spark, d), knowledge.mitigations(spark, d)), lines=F.regexp_replace(lines, r"(?m) +$", ""))
