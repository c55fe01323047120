import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.config import PipelineConfig, TransformConfig, backoff_seconds, bool_setting
from tidewatch.functions import telemetry as tel
from tidewatch.operators import api, dedupe, dlq, store
from tidewatch.schemas import EVENT
from tidewatch.sources.streams import checkpoint_of, entries_after, heartbeats, host_startup, synthetic_events


def test_config_bounds():
    c = PipelineConfig.load({"RETRY_MAX": "0", "DEDUPE_TTL_SECONDS": "5", "BLOCK_MS": "x", "BATCH_COUNT": "-1", "HOST_ID": " h "})
    assert (c.retry_max, c.dedupe_ttl_seconds, c.block_ms, c.batch_count, c.host_id) == (1, 60, 5000, 1, "h")
    assert TransformConfig.load({"INTERVAL_SECONDS": "1", "RUN_ONCE": "yes"}) == TransformConfig(200, 5, True)
    assert bool_setting({"X": "off"}, "X", True) is False
    assert [backoff_seconds(i) for i in (1, 2, 3)] == [2, 4, 5]


def test_defaults_and_redaction(spark):
    rows = spark.createDataFrame([(json.dumps({"event_type": "process_exec"}),)], "v string").select(F.from_json("v", EVENT).alias("e")).select("e.*")
    r = tel.with_defaults(rows, "host-a").first()
    assert (r.host_id, r.agent_id, r.severity, r.source_type, r.tags) == ("host-a", "unknown-agent", "low", "logs", [])
    assert r.event_id and r.trace_id and r.ts.endswith("Z")
    cmds = spark.createDataFrame([("curl --Token x",), ("echo hello",), (None,)], "c string")
    assert [x[0] for x in cmds.select(tel.redact(F.col("c"))).collect()] == ["[redacted]", "echo hello", None]


def test_score_lattice(spark):
    base = {"low": 0.15, "medium": 0.45, "high": 0.75, "critical": 0.95, "odd": 0.2}
    cases = [(s, ["h"] * n, src) for s, n, src in itertools.product(base, range(3), ("ebpf", "logs"))]
    df = spark.createDataFrame(cases, "s string, h array<string>, src string")
    for r in df.withColumn("v", tel.risk_score(F.col("s"), F.col("h"), F.col("src"))).collect():
        assert r.v == pytest.approx(round(min(0.99, base[r.s] + min(0.2, 0.05 * len(r.h)) + 0.03 * (r.src == "ebpf")), 3))


def test_rules_promote(spark):
    df = spark.createDataFrame([("network_egress", "low", "/bin/nc"), ("x", "critical", "/bin/nc"), ("network_egress", "odd", "ls"), ("x", "low", "/bin/nc -l")], "event_type string, severity string, command string")
    got = tel.apply_rules(df, F.col("command")).collect()
    assert [(r.derived_severity, len(r.rule_hits)) for r in got] == [("high", 2), ("critical", 1), ("medium", 1), ("low", 0)]
    assert got[3].explanation == tel.NO_HIT


def test_metrics_and_log(spark):
    rows = spark.createDataFrame([("processed",)] * 10 + [("dlq",)], "outcome string").withColumn("s", F.lit(5.0))
    m = tel.metrics(rows, F.col("s")).first()
    assert (m.processed, m.dlq_published, m.throughput_per_sec) == (10, 1, 2.0)
    line = tel.log_line("x", spark.createDataFrame([(2, "a")], "z int, b string")).first().line
    assert line == '{"b":"a","event":"x","z":2}'
    e = spark.createDataFrame([("e", "t", "h", "k", "low", "secret")], "event_id string, trace_id string, host_id string, event_type string, severity string, raw string")
    assert "raw" not in tel.lifecycle(e, F.lit("1-0"), F.lit(1), F.lit("processed")).columns


def test_generator(spark):
    g = {r.n: r for r in synthetic_events(spark.createDataFrame([(n,) for n in range(1, 16)], "n long")).collect()}
    assert (g[10].severity, g[10].process_name, len(g[10].tags), g[10].pid) == ("high", "nc", 3, 1010)
    assert g[9].event_type == "network_egress" and g[7].command == "/usr/bin/curl"
    assert heartbeats(synthetic_events(spark.range(1, 16).selectExpr("id as n"))).count() == 3
    assert host_startup(spark, "h", "a").first().event_type == "host_startup"


@pytest.mark.parametrize("limit,offset,want", [("", "", (50, 0)), ("abc", "", None), ("-2", "", None), ("999", "", None), ("42", "12", (42, 12)), ("1", "-1", None)])
def test_page_parameters(limit, offset, want):
    if want:
        assert api.limit_offset(limit, offset, 50, 250) == want
    else:
        with pytest.raises(api.QueryError) as e:
            api.limit_offset(limit, offset, 50, 250)
        assert e.value.envelope["error_code"] == "invalid_query"


def test_search_and_pages(spark):
    df = spark.createDataFrame([(str(i), i, "high", "h", "t") for i in range(7)], "event_id string, ts long, severity string, host_id string, event_type string")
    p = api.page(api.event_search(df), 3, 3)
    assert ([r["ts"] for r in p.rows], p.has_more, p.returned) == ([3, 2, 1], True, 3)
    assert api.event_search(df, severity="HIGH").count() == 0
    with pytest.raises(api.QueryError):
        api.event_search(df, severity="urgent")
    with pytest.raises(api.QueryError):
        api.require_positive(limit=0)


def test_checkins(spark):
    bodies = spark.createDataFrame([('{"agent_id":"a","host_id":"h"}',), ('{"agent_id":" ","host_id":"h"}',), ("{bad",)], "body string")
    ok, bad = api.checkins(bodies)
    assert [(r.agent_id, r.source_type, r.capabilities) for r in ok.collect()] == [("a", "unknown", [])]
    assert bad.count() == 2


def test_dead_letters(spark):
    made = dlq.dead_letters(spark.createDataFrame([("1-0", "{}")], "stream_id string, payload string"), "security_events", F.lit("boom"))
    assert dlq.parsed(made).first().reason is None
    e = spark.createDataFrame([
        ("9-0", '{"stream":"s","payload":{"event":{"a":1},"n":4,"s":"x","z":null}}'), ("10-0", '{"stream":"s","payload":{"n":1}}'), ("2-0", None), ("3-0", "[1]"), ("4-0", '{"stream":"security_dlq","payload":{"event":"e"}}'),
    ], "stream_id string, dlq string")
    p = {r.stream_id: r for r in dlq.parsed(e).collect()}
    assert p["9-0"].payload == {"event": '{"a":1}', "n": "4", "s": "x"}
    assert "missing event" in p["10-0"].reason and p["2-0"].reason == "missing dlq field" and p["3-0"].reason == "dlq entry must be object"
    plan = dlq.replay_plan(e, "3-0", 10)
    assert [r.stream_id for r in plan.collect()] == ["3-0", "4-0", "9-0", "10-0"]
    assert {r.stream_id: r.destination for r in plan.collect()} == {"3-0": None, "4-0": "security_events", "9-0": "s", "10-0": None}
    assert dlq.destination(F.lit("s"), " forced ", "f", "d") is not None
    assert sorted(r.stream_id for r in dlq.remaining(e, plan).collect()) == ["10-0", "2-0", "3-0"]


def test_replay_writes(spark, tmp_path):
    e = spark.createDataFrame([("1-0", '{"stream":"s","payload":{"event":"e"}}')], "stream_id string, dlq string")
    stats = dlq.replay(dlq.replay_plan(e), str(tmp_path / "out"), execute=True).first()
    assert (stats.scanned, stats.eligible, stats.replayed) == (1, 1, 1)
    assert spark.read.json(str(tmp_path / "out")).first().payload == "e"


def test_positions_are_numbers(spark):
    e = spark.createDataFrame([("10-0", "b"), ("9-5", "a"), ("10-1", "c")], "stream_id string, payload string")
    assert [r.payload for r in entries_after(e, "9-5").collect()] == ["b", "c"]
    c = store.checkpoints(spark.createDataFrame([("s", "c", "9-0"), ("s", "c", "10-0")], "stream_name string, consumer_name string, last_stream_id string").withColumnRenamed("last_stream_id", "stream_id"))
    assert checkpoint_of(c, "s", "c") == "10-0" and checkpoint_of(c, "s", "other") == "0-0"


def test_ttl_dedupe(spark):
    times = [0, 10, 59, 60, 100, 119, 121]
    df = spark.createDataFrame([("a", t) for t in times] + [(None, 5), (None, 5)], "k string, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = sorted((r.k or "", r.t) for r in dedupe.ttl_dedupe(df, "k", "ts", 60).collect())
    assert got == [("", 5), ("", 5), ("a", 0), ("a", 60), ("a", 121)]


def test_upsert_keeps_first_writer_columns(spark):
    cols = "event_id string, host_id string, severity string, pos long"
    old = spark.createDataFrame([("a", "h1", "low"), ("b", "h1", "low")], "event_id string, host_id string, severity string")
    new = spark.createDataFrame([("a", "h2", "high", 3), ("c", "h3", "low", 4), ("c", "h4", "high", 5)], cols)
    got = {r.event_id: (r.host_id, r.severity) for r in store.upsert(old, new, "event_id", "pos", ["host_id"], ["severity"]).collect()}
    assert got == {"a": ("h1", "high"), "b": ("h1", "low"), "c": ("h3", "high")}


def test_ttl_dedupe_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.randrange(3000), i) for i in range(600)] + [("hot", t // 3, 1000 + t) for t in range(3000)]
    want, last = set(), {}
    for k, t, i in sorted(rows):
        if k not in last or t >= last[k] + 60:
            want.add(i)
            last[k] = t
    df = spark.createDataFrame(rows, "k string, t long, i long").withColumn("ts", F.timestamp_seconds("t"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = [r.i for r in dedupe.ttl_dedupe(df, "k", "ts", 60).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(want) and set(got) == want  # of equal times the least row


def test_ties_have_one_answer(spark):
    beats = spark.createDataFrame([("a", "h1", "logs", 5), ("a", "h2", "logs", 5), ("a", "h3", "logs", 4)], "agent_id string, host_id string, source_type string, seen_at long")
    for df in (beats, beats.orderBy(F.desc("host_id"))):
        assert store.heartbeat_table(df.coalesce(1)).first().host_id == "h2"


def kept_times(times, ttl):
    out = []
    for t in sorted(set(times)):
        if not out or t >= out[-1] + ttl:
            out.append(t)
    return out


def test_step_map_by_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        at = np.array(sorted(rng.sample(range(200), rng.randrange(1, 60))))
        ttl = rng.choice([1, 2, 7, 30, 500])
        upto, last = dedupe.step_map(at, ttl)
        assert (np.diff(upto) > 0).all() and (last[1:] != last[:-1]).all()
        for kept in range(int(at[0]) - ttl - 3, int(at[0])):
            chain = kept_times([t for t in at.tolist() if t >= kept + ttl], ttl)
            step = int(np.searchsorted(upto, kept + ttl))
            assert (last[step] if step < upto.size else None) == (chain[-1] if chain else None)


def test_ttl_dedupe_of_a_key_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "STEPS_A_ROW", 3)
    rng = random.Random(5)
    rows = [("hot", rng.randrange(40_000)) for _ in range(6000)] + [(f"k{rng.randrange(40)}", rng.randrange(40_000)) for _ in range(800)] + [("hot", 77)] * 500
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for ttl in (1, 50, 3000, 100_000):
            df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k string, t long, i long").selectExpr("k", "timestamp_seconds(t) as ts", "t", "i")
            got = {}
            for r in dedupe.ttl_dedupe(df, "k", "ts", ttl).collect():
                got.setdefault(r.k, []).append(r.t)
            assert {k: sorted(v) for k, v in got.items()} == {k: kept_times([t for x, t in rows if x == k], ttl) for k in {k for k, _ in rows}}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
