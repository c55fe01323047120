import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewatch.functions.telemetry import findings
from tidewatch.operators.buckets import Buckets
from tidewatch.sources.streams import read_stream
from tidewatch.streaming import pipeline as pl

NOW = "2026-01-01T00:00:00Z"


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps({"stream_id": f"{i}-0", "payload": p}) for i, p in rows))


def sample():
    good = [json.dumps({"event_id": f"e{i}", "event_type": "network_egress" if i % 2 else "process_exec", "raw": {"command": "/bin/nc" if i % 3 else "curl --token x"}}) for i in range(9)]
    return list(enumerate([*good, good[0], "{bad", "[1]", None]))


def test_stream_equals_batch_and_retries_are_idempotent(spark, tmp_path):
    rows = sample()
    write(tmp_path / "in", "a", rows)
    entries = read_stream(spark, str(tmp_path / "in"))
    assert pl.run_once(pl.start(entries, str(tmp_path / "out"), str(tmp_path / "ckpt"), now=lambda: F.lit(NOW)))
    batch = spark.createDataFrame([(f"{i}-0", p) for i, p in rows], "stream_id string, payload string")
    good, bad = pl.parse_entries(batch)
    want = findings(pl.normalised(good, now=F.lit(NOW)).dropDuplicates(["event_id"]), F.lit(NOW))
    got = spark.read.json(str(tmp_path / "out" / "analysis"))
    key = lambda df: sorted((r.event_id, r.severity, r.score) for r in df.collect())
    assert key(got) == key(want) and got.count() == 10
    assert spark.read.json(str(tmp_path / "out" / "dlq")).count() == bad.count() == 2
    assert 0 < spark.read.json(str(tmp_path / "out" / "alert")).count() <= 10
    pl.publish_batch(str(tmp_path / "out"), now=lambda: F.lit(NOW))(batch, 0)
    assert spark.read.json(str(tmp_path / "out" / "analysis")).count() == 10


def test_watermark_dedupe_drops_a_replayed_file(spark, tmp_path):
    rows = [(i, str(i % 5)) for i in range(10)]
    write(tmp_path / "in", "a", rows)
    write(tmp_path / "in", "b", rows)
    s = read_stream(spark, str(tmp_path / "in"), files_per_trigger=1).withColumn("ts", F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    q = pl.dedupe_within(s, "ts", 3600, "payload").writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert pl.run_once(q)
    assert spark.table("deduped").count() == 5
    assert pl.rows_moved(q) == 20


def test_loading_rejects_orphans(spark):
    e = spark.createDataFrame([("e1", "h1", "low", 1), ("e1", "h2", "high", 2)], "event_id string, host_id string, severity string, pos long").withColumn("ts", F.col("pos"))
    a = spark.createDataFrame([("a1", "e1", "h1", 0.5, 1), ("a2", "gone", "h1", 0.5, 2)], "analysis_id string, event_id string, host_id string, score double, pos long")
    old = {
        "hosts": spark.createDataFrame([("h1", 0, 0)], "host_id string, first_seen_at long, last_seen_at long"),
        "events": spark.createDataFrame([], "event_id string, host_id string, ts long, severity string"),
        "findings": spark.createDataFrame([], "analysis_id string, event_id string, host_id string, score double"),
    }
    out = pl.load_tables(e, a, old)
    assert (out["events"].first().host_id, out["events"].first().severity) == ("h1", "high")
    assert [r.analysis_id for r in out["findings"].collect()] == ["a1"] and [r.analysis_id for r in out["rejected"].collect()] == ["a2"]
    assert {r.host_id: (r.first_seen_at, r.last_seen_at) for r in out["hosts"].collect()} == {"h1": (0, 1), "h2": (2, 2)}


def analysed(spark, folder):
    return sorted(r.event_id for r in spark.read.json(f"{folder}/analysis").collect())


def test_a_repeat_in_the_next_batch_is_analysed_once(spark, tmp_path):
    one = [json.dumps({"event_id": e, "event_type": "process_exec", "severity": "high"}) for e in "abc"]
    write(tmp_path / "in", "a", list(enumerate(one)))
    write(tmp_path / "in", "b", list(enumerate([one[0], one[2], one[0], json.dumps({"event_id": "d"}), "{bad"])))
    entries = read_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    out, log = str(tmp_path / "out"), pl.ProgressLog()
    spark.streams.addListener(log)
    assert pl.run_once(pl.start(entries, out, str(tmp_path / "ckpt"), now=lambda: F.lit(NOW), ttl_seconds=60))
    spark.streams.removeListener(log)
    assert analysed(spark, out) == ["a", "b", "c", "d"]
    counts = spark.read.json(f"{out}/metrics").groupBy().sum().first().asDict()
    assert (counts["sum(processed)"], counts["sum(deduped)"], counts["sum(dlq_published)"]) == (4, 3, 1)
    assert sum(json.loads(x)["rows"] for x in log.lines) == 8


def events(*ids):
    return list(enumerate(json.dumps({"event_id": e, "event_type": "process_exec"}) for e in ids))


def test_repeats_are_known_after_a_restart_and_forgotten_after_their_time(spark, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    (tmp_path / "in").mkdir()
    entries = read_stream(spark, str(tmp_path / "in"))

    def run(name, *ids):
        write(tmp_path / "in", name, events(*ids))
        q = pl.start(entries, out, ckpt, now=lambda: F.lit(NOW), ttl_seconds=8)
        assert pl.run_once(q)
        return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1]

    began = time.time()
    assert run("a", *[f"e{i}" for i in range(50)]) == 50
    marks = run("b", "e1", "e2", "new", "new")  # another process would find the same checkpoint
    if time.time() - began < 8:
        assert analysed(spark, out) == sorted([*[f"e{i}" for i in range(50)], "new"]) and marks == 51
    time.sleep(max(0, began + 20 - time.time()))
    assert run("c", "e1", "late") <= 3  # all marks but those of the last seconds are gone
    assert analysed(spark, out).count("e1") == 2 and analysed(spark, out).count("late") == 1


def test_a_batch_that_fails_runs_again_from_the_state_before_it(spark, tmp_path):
    out, ckpt, calls = str(tmp_path / "out"), str(tmp_path / "ckpt"), []
    write(tmp_path / "in", "a", events("a", "b", "b"))

    def now():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return F.lit(NOW)

    entries = read_stream(spark, str(tmp_path / "in"))
    q = pl.start(entries, out, ckpt, now=now, ttl_seconds=3600)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)
    assert pl.run_once(pl.start(entries, out, ckpt, now=now, ttl_seconds=3600))
    assert analysed(spark, out) == ["a", "b"]
    m = spark.read.json(f"{out}/metrics").first()
    assert (m.processed, m.deduped, m.dlq_published) == (2, 1, 0)


def test_the_earliest_entry_of_an_event_is_first_and_broken_ones_have_no_state(spark, tmp_path):
    one = lambda n: json.dumps({"event_id": "x", "raw": {"command": n}})
    write(tmp_path / "in", "a", [(10, one("ten")), (9, one("nine")), (11, one("eleven")), (3, "{bad"), (4, "[2]"), (5, None), (6, None)])
    marked = pl.mark_repeats(read_stream(spark, str(tmp_path / "in")), 3600)
    pl.session_state_store(spark)
    q = marked.writeStream.format("memory").queryName("marked").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    for key in pl.STATE_SETTINGS | pl.RUN_ONCE_SETTINGS:
        spark.conf.unset(key)
    assert pl.run_once(q)
    got = {r.stream_id: r.repeat for r in spark.table("marked").collect()}
    assert got == {"9-0": False, "10-0": True, "11-0": True, "3-0": False, "4-0": False, "5-0": False, "6-0": False}
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 3


def test_counters_come_from_one_pass(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def work(row):
        with open(calls, "a") as f:
            f.write(row["event_id"])

    rows = [*events("a", "b", "b", "c"), (9, "{bad")]
    batch = spark.createDataFrame([(f"{i}-0", p) for i, p in rows], "stream_id string, payload string")
    out = str(tmp_path / "out")
    pl.publish_batch(out, now=lambda: F.lit(NOW), work=work)(batch, 0)
    assert sorted(open(calls).read()) == ["a", "b", "c"]
    m = spark.read.json(f"{out}/metrics").first()
    assert (m.processed, m.retried, m.deduped, m.dlq_published, m.pipeline_errors) == (3, 0, 1, 1, 0)


def test_waiting_is_bounded(spark):
    def work(row):
        raise ValueError

    began = time.time()
    got = pl.with_retries(spark.range(30).coalesce(1), work, 3, wait=lambda n: 1, most_wait=2).collect()
    assert time.time() - began < 20 and {r.attempts for r in got} == {3}


def test_rows_that_keep_failing_end_as_dead_letters(spark, tmp_path):
    tried = str(tmp_path / "tried")

    def work(row):
        with open(tried, "a") as f:
            f.write(row["event_id"])
        if row["event_id"] == "b" or (row["event_id"] == "c" and open(tried).read().count("c") < 2):
            raise ValueError("no luck")

    batch = spark.createDataFrame([(f"{i}-0", json.dumps({"event_id": e})) for i, e in enumerate("abc")], "stream_id string, payload string").coalesce(1)
    out = str(tmp_path / "out")
    pl.publish_batch(out, now=lambda: F.lit(NOW), work=work, tries=3, wait=lambda n: 0)(batch, 0)
    assert analysed(spark, out) == ["a", "c"]
    dead = [json.loads(r.dlq) for r in spark.read.json(f"{out}/dlq").collect()]
    assert [(d["stream_id"], d["reason"]) for d in dead] == [("1-0", "failed after 3 attempts: ValueError: no luck")]
    assert sorted(open(tried).read()) == sorted("abbbcc")
    m = spark.read.json(f"{out}/metrics").first()
    assert (m.processed, m.retried, m.dlq_published) == (2, 3, 1)


SCHEMAS = {
    "hosts": "host_id string, first_seen_at long, last_seen_at long",
    "events": "event_id string, host_id string, ts long, severity string",
    "findings": "analysis_id string, event_id string, host_id string, score double",
}
KEYS = {"hosts": "host_id", "events": "event_id", "findings": "analysis_id"}


def test_tables_change_as_one_version(spark, tmp_path):
    shape = "kind string, id string, event_id string, host_id string, severity string, score double, pos long"
    split = lambda b: (b.where("kind = 'e'").selectExpr("event_id", "host_id", "severity", "pos", "pos as ts"), b.where("kind = 'a'").selectExpr("id as analysis_id", "event_id", "host_id", "score", "pos"))
    one = spark.createDataFrame([("e", None, "e1", "h", "low", None, 1), ("a", "a1", "e1", "h", None, 0.5, 1), ("a", "a2", "gone", "h", None, 0.5, 1)], shape)
    two = spark.createDataFrame([("e", None, "e1", "other", "high", None, 2), ("a", "a3", "e1", "h", None, 0.7, 2), ("e", None, "e2", "h", "low", None, 3)], shape)
    three = spark.createDataFrame([("a", "a4", "e1", "h", None, 0.1, 4), ("a", None, "e1", "h", None, 0.1, 4), ("a", "a5", None, "h", None, 0.1, 4)], shape)
    tables = Buckets(spark, str(tmp_path / "tables"), SCHEMAS, KEYS, 8)
    batch = pl.load_batch(tables, split)
    assert tables.current() is None and tables.read("events").count() == 0
    for number, rows in ((0, one), (1, two), (1, two), (2, three)):
        batch(rows, number)
    assert tables.current() == 2 and tables.current(1) == 0
    assert sorted(r.analysis_id for r in tables.read("findings").collect()) == ["a1", "a3", "a4"]
    assert sorted((r.event_id, r.host_id, r.severity) for r in tables.read("events").collect()) == [("e1", "h", "high"), ("e2", "h", "low")]
    assert [r.severity for r in tables.read("events", 0).collect()] == ["low"]
    assert {r.host_id: (r.first_seen_at, r.last_seen_at) for r in tables.read("hosts").collect()} == {"h": (1, 3), "other": (2, 2)}
    assert sorted(r.analysis_id for r in spark.read.json(f"{tables.folder}/rejected").collect()) == ["a2", "a5"]


def test_a_version_counts_from_its_commit(spark, tmp_path):
    tables = Buckets(spark, str(tmp_path / "tables"), SCHEMAS, KEYS, 8)
    rows = lambda *e: spark.createDataFrame([(x, "h", 1, s, 1) for x, s in e], "event_id string, host_id string, ts long, severity string, pos long")
    tables.upsert(0, "events", rows(("a", "low")), ["host_id", "ts"], ["severity"])
    # version 1 wrote its data and was lost before its commit
    rows(("a", "high")).drop("pos").withColumn("bucket", tables.bucket(F.col("event_id"))).write.partitionBy("bucket").parquet(f"{tables.folder}/data/version=1/table=events")
    assert [r.severity for r in tables.read("events").collect()] == ["low"]
    tables.upsert(1, "events", rows(("a", "critical")), ["host_id", "ts"], ["severity"])
    assert [r.severity for r in tables.read("events").collect()] == ["critical"]


def test_an_upsert_rewrites_the_buckets_it_touches(spark, tmp_path):
    tables = Buckets(spark, str(tmp_path / "tables"), SCHEMAS, KEYS, 32)
    writes = lambda ids, s: ids.select(F.concat(F.lit("e"), "id").alias("event_id"), F.md5(F.col("id").cast("string")).alias("host_id"), F.lit(1).alias("ts"), F.lit(s).alias("severity"), F.lit(1).alias("pos"))
    tables.upsert(0, "events", writes(spark.range(50_000), "low"), ["host_id", "ts"], ["severity"])
    tables.upsert(1, "events", writes(spark.range(49_999, 50_002), "high"), ["host_id", "ts"], ["severity"])
    assert 0 < tables.rewritten_bytes(1) < tables.rewritten_bytes(0) * 4 / 32
    changed = [b for (_, b), v in tables.manifest(1).items() if v == 1]
    assert 1 <= len(changed) <= 3
    got = tables.read("events")
    assert (got.count(), got.where("severity = 'high'").count(), got.select("event_id").distinct().count()) == (50_002, 3, 50_002)


def test_the_stream_loads_tables(spark, tmp_path):
    tables = Buckets(spark, str(tmp_path / "tables"), SCHEMAS, KEYS, 4)
    write(tmp_path / "in", "a", events("a", "b"))
    write(tmp_path / "in", "b", events("b", "c"))

    def split(batch):
        good, _ = pl.parse_entries(batch)
        e = good.select("event_id", F.lit("h").alias("host_id"), F.lit("low").alias("severity"), F.split_part("stream_id", F.lit("-"), F.lit(1)).cast("long").alias("pos")).withColumn("ts", F.col("pos"))
        return e, e.select(F.concat(F.lit("f"), "event_id").alias("analysis_id"), "event_id", "host_id", F.lit(0.5).alias("score"), "pos")

    stream = read_stream(spark, str(tmp_path / "in")).writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(pl.load_batch(tables, split)).trigger(availableNow=True)
    assert pl.run_once(stream.start())
    assert sorted(r.event_id for r in tables.read("events").collect()) == ["a", "b", "c"]
    assert tables.read("findings").count() == 3


def test_heartbeats_stream_into_their_table(spark, tmp_path):
    shape = "agent_id string, host_id string, source_type string, seen_at string"
    tables = Buckets(spark, str(tmp_path / "tables"), {"heartbeats": f"{shape}, status string"}, {"heartbeats": "agent_id"}, 4)
    (tmp_path / "in").mkdir()
    for name, rows in (("a", [("x", "h1", "01"), ("y", "h1", "02"), (None, "h9", "09")]), ("b", [("x", "h2", "03"), ("x", "h3", "02"), ("z", "h1", "01")]), ("c", [("x", "h4", "00")])):
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(json.dumps({"agent_id": a, "host_id": h, "source_type": "logs", "seen_at": t}) for a, h, t in rows))
    beats = read_stream(spark, str(tmp_path / "in"), shape)
    assert pl.run_once(beats.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(pl.load_heartbeats(tables)).trigger(availableNow=True).start())
    assert sorted((r.agent_id, r.host_id, r.seen_at, r.status) for r in tables.read("heartbeats").collect()) == [("x", "h2", "03", "online"), ("y", "h1", "02", "online"), ("z", "h1", "01", "online")]
