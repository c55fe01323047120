"""The telemetry path as streams: parse, normalise, dedupe, score, publish; dead letters beside; tables by loading.

A failed row is data, not an exception: it is routed to the dead letters with its reason.  Sinks are folders named by
batch, overwritten when a batch runs again, and ids are digests, so a retried batch writes the same rows once.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.config import backoff_seconds
from tidewatch.functions.telemetry import alerts, findings, redact, with_defaults
from tidewatch.operators.buckets import Buckets, load
from tidewatch.operators.dlq import dead_letters
from tidewatch.operators.store import EVENT_FIRST, EVENT_LAST, FINDING_FIRST, FINDING_LAST, first_last, heartbeat_table, hosts, split_by_key, upsert
from tidewatch.schemas import EVENT
from tidewatch.sources.streams import position


def parse_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """entries (stream_id, payload) -> events beside their entry, and entries that are no JSON object, with the reason.

    A missing payload is an event of defaults.
    """
    text = F.coalesce("payload", F.lit("{}"))
    doc = F.try_parse_json(text)
    rows = entries.withColumns({"_text": text, "_reason": F.when(doc.isNull(), "invalid json").when(~F.ltrim(text).startswith("{"), "payload is not an object")})
    good = rows.where("_reason is null").select("stream_id", "payload", F.from_json("_text", EVENT).alias("e"))
    return good.select("stream_id", "payload", "e.*"), rows.where("_reason is not null").select("stream_id", "payload", F.col("_reason").alias("reason"))


def normalised(events: DataFrame, host_id: str = "unknown-host", now: Column | None = None) -> DataFrame:
    """Defaults filled and the command redacted, before any rule sees it."""
    filled = with_defaults(events, host_id, now)
    return filled.withColumn("raw", F.when(F.col("raw").isNotNull(), F.col("raw").withField("command", redact(F.col("raw.command"))))).withColumn("command", F.col("raw.command"))


def dedupe_within(events: DataFrame, ts: str, ttl_seconds: int, key: str = "event_id") -> DataFrame:
    """One row per key inside the watermark's reach, by event time."""
    return events.withWatermark(ts, f"{ttl_seconds} seconds").dropDuplicatesWithinWatermark([key])


class SeenOnce(StatefulProcessor):
    """Keeps a key's first row and drops what follows until its state expires, counted from that first row."""

    def __init__(self, ttl_seconds: int):
        self.ttl_ms = ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            if len(pdf) and not self.seen.exists():
                self.seen.update((1,))
                yield pdf.head(1)

    def close(self) -> None:
        pass


def dedupe_exact(events: DataFrame, ttl_seconds: int, key: str = "event_id") -> DataFrame:
    """As ``dedupe_within``, by processing time; needs the RocksDB state store."""
    return events.groupBy(key).transformWithStateInPandas(SeenOnce(ttl_seconds), events.schema, "append", "ProcessingTime")


class MarkRepeats(StatefulProcessor):
    """Every row of an event with ``repeat``: false for the earliest entry of an event whose state is gone or never was.

    State is a mark that expires after the time to live, counted from the entry that set it, so what is kept are the
    events of that time and no more.  Entries without an event (no key) have no state.
    """

    def __init__(self, ttl_seconds: int):
        self.ttl_ms = ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "mark boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        known = key[0] is not None and self.seen.exists()
        first = None
        for row in rows:
            if first is not None and key[0] is not None:
                row, first = (first, row) if (row["_ms"], row["_seq"]) < (first["_ms"], first["_seq"]) else (row, first)
                yield Row(stream_id=row["stream_id"], payload=row["payload"], repeat=True)
            elif first is not None:
                yield Row(stream_id=row["stream_id"], payload=row["payload"], repeat=False)
            else:
                first = row
        if first is not None:
            if key[0] is not None and not known:
                self.seen.update((True,))
            yield Row(stream_id=first["stream_id"], payload=first["payload"], repeat=known)

    def close(self) -> None:
        pass


def mark_repeats(entries: DataFrame, ttl_seconds: int, host_id: str = "unknown-host") -> DataFrame:
    """stream_id, payload and repeat of a stream of entries: whether the same event came first less than ``ttl_seconds`` ago.

    Exact, by processing time, across batches and restarts; needs the RocksDB state store.  A repeat doesn't renew the
    time.  Of one batch's entries of an event the one of the lowest position is first.
    """
    text = F.coalesce("payload", F.lit("{}"))
    event = with_defaults(entries.select("stream_id", "payload", F.from_json(text, EVENT).alias("e")).select("stream_id", "payload", "e.*"), host_id, F.lit("")).select("stream_id", "payload", "event_id")
    whole = F.try_parse_json(text).isNotNull() & F.ltrim(text).startswith("{")
    at = position(F.col("stream_id"))
    keyed = event.select("stream_id", "payload", at["ms"].alias("_ms"), at["seq"].alias("_seq"), F.when(whole, F.col("event_id")).alias("_event"), F.when(~whole, F.col("stream_id")).alias("_entry"))
    return keyed.groupBy("_event", "_entry").transformWithState(MarkRepeats(ttl_seconds), "stream_id string, payload string, repeat boolean", "append", "ProcessingTime")


STATE_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: State by processing time asks for another batch without end; one run stops when it has read what is there.
RUN_ONCE_SETTINGS = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def findings_path(folder: str, kind: str, batch: int) -> str:
    return f"{folder}/{kind}/batch={batch}"


def with_retries(rows: DataFrame, work: Callable[[dict], None], tries: int, wait: Callable[[int], float] = backoff_seconds, most_wait: float = 60) -> DataFrame:
    """``rows`` with attempts and error: ``work`` is called on each row until it doesn't raise, at most ``tries`` times.

    ``wait`` gives the seconds to wait after an attempt; a task waits ``most_wait`` seconds in all and then tries again at
    once, so rows that keep failing can't hold up a batch.  error is null for rows that went well.
    """
    shape = T.StructType(list(rows.schema.fields)).add("attempts", "integer").add("error", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = most_wait

        def attempt(row: dict) -> tuple[int, str | None]:
            nonlocal left
            for n in range(1, tries + 1):
                try:
                    work(row)
                    return n, None
                except Exception as e:  # noqa: BLE001  what fails is a row of the result
                    error = f"{type(e).__name__}: {e}"[:500]
                    if n < tries and (pause := min(wait(n), left)) > 0:
                        left -= pause
                        time.sleep(pause)
            return tries, error

        for batch in batches:
            done = [attempt(row) for row in batch.to_pylist()]
            more = [pa.array([n for n, _ in done], pa.int32()), pa.array([e for _, e in done], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "attempts", "error"])

    return rows.mapInArrow(run, shape)


#: What a batch is counted by, with the log's names.
COUNTERS = "processed long, retried long, deduped long, dlq_published long, pipeline_errors long"


def routed(batch: DataFrame, host_id: str = "unknown-host", now: Column | None = None, work: Callable[[dict], None] | None = None, tries: int = 3, wait: Callable[[int], float] = backoff_seconds) -> DataFrame:
    """stream_id, payload, event, outcome (processed, deduped or dlq), attempts and reason of every entry of a batch.

    Where the batch has no ``repeat``, repeats are those within it; the entry of the lowest position is first.
    """
    good, bad = parse_entries(batch)
    events = normalised(good, host_id, now)
    if "repeat" not in batch.columns:
        events = events.withColumn("repeat", F.row_number().over(Window.partitionBy("event_id").orderBy(position(F.col("stream_id")))) > 1)
    fields = [c for c in events.columns if c not in ("stream_id", "payload", "repeat")]
    event, none = F.struct(*fields).alias("event"), F.lit(None).cast("string").alias("reason")
    fresh = events.where(~F.col("repeat")).drop("repeat")
    if work is None:
        done = fresh.select("stream_id", "payload", event, F.lit("processed").alias("outcome"), F.lit(1).alias("attempts"), none)
    else:
        why = F.concat(F.lit("failed after "), F.col("attempts").cast("string"), F.lit(" attempts: "), F.col("error")).alias("reason")
        done = with_retries(fresh, work, tries, wait).select("stream_id", "payload", event, F.when(F.col("error").isNull(), "processed").otherwise("dlq").alias("outcome"), "attempts", why)
    again = events.where("repeat").select("stream_id", "payload", event, F.lit("deduped").alias("outcome"), F.lit(0).alias("attempts"), none)
    broken = bad.select("stream_id", "payload", F.lit(None).cast(done.schema["event"].dataType).alias("event"), F.lit("dlq").alias("outcome"), F.lit(0).alias("attempts"), "reason")
    return done.unionByName(again).unionByName(broken)


def publish_batch(
    folder: str, host_id: str = "unknown-host", now: Callable[[], Column] | None = None,
    work: Callable[[dict], None] | None = None, tries: int = 3, wait: Callable[[int], float] = backoff_seconds,
) -> Callable[[DataFrame, int], None]:
    """What is done with a micro-batch: analyses, alerts, dead letters and counters are written, each in a folder of the batch.

    ``work`` is called on each event that is no repeat, again if it raises; after ``tries`` attempts the entry goes to
    the dead letters.  Counters are observed on the rows as they pass, so nothing is run again to be counted.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        stamp = now() if now else None
        counted = Observation()
        is_ = lambda o: F.count_if(F.col("outcome") == o)
        retried = F.coalesce(F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))), F.lit(0)).cast("long")
        rows = routed(batch, host_id, stamp, work, tries, wait)
        rows = rows.observe(counted, is_("processed").alias("processed"), retried.alias("retried"), is_("deduped").alias("deduped"), is_("dlq").alias("dlq")).persist()
        analyses = findings(rows.where("outcome = 'processed'").select("event.*"), stamp)
        analyses.write.mode("overwrite").json(findings_path(folder, "analysis", number))
        alerts(analyses, stamp).write.mode("overwrite").json(findings_path(folder, "alert", number))
        dead = dead_letters(rows.where("outcome = 'dlq'"), "security_events", F.col("reason"), stamp)
        dead.write.mode("overwrite").json(findings_path(folder, "dlq", number))
        n = counted.get
        spark.createDataFrame([(n["processed"], n["retried"], n["deduped"], n["dlq"], 0)], COUNTERS).write.mode("overwrite").json(findings_path(folder, "metrics", number))
        rows.unpersist()
        batch.unpersist()

    return run


def start(
    entries: DataFrame, folder: str, checkpoint: str, host_id: str = "unknown-host", now: Callable[[], Column] | None = None, every: str | None = None,
    ttl_seconds: int | None = None, **more,
) -> StreamingQuery:
    """Runs once over what is there, or again and again if ``every`` names an interval; more: see ``publish_batch``.

    With ``ttl_seconds``, repeats are known by state of the stream (``mark_repeats``), which its checkpoint keeps: a batch
    that runs again starts from the state before it.  Without, they are those of one batch.
    """
    spark = entries.sparkSession
    own = {}
    if ttl_seconds is not None:
        entries = mark_repeats(entries, ttl_seconds, host_id)
        own = STATE_SETTINGS if every else STATE_SETTINGS | RUN_ONCE_SETTINGS
    before = {key: spark.conf.get(key) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        writer = entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish_batch(folder, host_id, now, **more))
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    finally:
        for key, value in before.items():  # a running query has settings of its own
            spark.conf.set(key, value)


class ProgressLog(StreamingQueryListener):
    """Keeps a line of counters for each micro-batch of every query of a session, the last ``most`` of them."""

    def __init__(self, most: int = 1000):
        self.lines: deque[str] = deque(maxlen=most)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.lines.append(json.dumps({"batch": p.batchId, "event": "stream_progress", "rows": p.numInputRows, "rows_per_second": round(p.processedRowsPerSecond, 3)}, sort_keys=True))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def load_batch(tables: Buckets, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: loads a batch into the tables as a version of the batch's number; running it again changes nothing.

    split: a batch -> its events and its analyses, each with ``pos``.
    """

    def run(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        load(tables, number, *split(batch))
        batch.unpersist()

    return run


def load_heartbeats(tables: Buckets) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: heartbeats (agent_id, host_id, source_type, seen_at) into the table of each agent's last one, always online.

    Only the buckets of the batch's agents are rewritten; an older heartbeat that comes late changes nothing.
    """

    def run(batch: DataFrame, number: int) -> None:
        batch, last = batch.where("agent_id is not null").persist(), tables.current(number)
        own = tables.touched(batch, "agent_id")
        beats = ["agent_id", "host_id", "source_type", "seen_at"]
        both = tables.before("heartbeats", last, own).select(*beats).unionByName(batch.select(*beats))
        tables.commit(number, {"heartbeats": (own, heartbeat_table(both))}, last)
        batch.unpersist()

    return run


def load_tables(events: DataFrame, analyses: DataFrame, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Hosts, events and findings after a batch: events first, then findings whose event is there; others are rejected.

    events and analyses have a column ``pos``, their order in the stream.  The result is written by the caller to new
    folders, all or none of which become current: what one transaction would have done.
    """
    seen = hosts(events)
    old = tables["hosts"]
    all_hosts = old.select("host_id", "first_seen_at", "last_seen_at").unionByName(seen)
    new_hosts = all_hosts.groupBy("host_id").agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
    new_events = upsert(tables["events"], events, "event_id", "pos", EVENT_FIRST, EVENT_LAST)
    ok, rejected = split_by_key(analyses, new_events, "event_id")
    new_findings = upsert(tables["findings"], ok, "analysis_id", "pos", FINDING_FIRST, FINDING_LAST)
    return {"hosts": new_hosts, "events": new_events, "findings": new_findings, "rejected": rejected}


def snapshot(writes: DataFrame, key: str, order: str = "pos") -> DataFrame:
    return first_last(writes, key, order, EVENT_FIRST, EVENT_LAST)


def windowed_counts(events: DataFrame, ts: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts by time window and keys, late rows dropped behind the watermark: an extension."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).count().select(F.col("window.start").alias("window_start"), *keys, "count")


def run_once(query: StreamingQuery, seconds: int = 120) -> bool:
    """Waits for a query that ends by itself; whether it did."""
    done = query.awaitTermination(seconds)
    if not done:
        query.stop()
    return bool(done)


def rows_moved(query: StreamingQuery) -> int:
    return sum(p["numInputRows"] for p in query.recentProgress)


def session_state_store(spark: SparkSession) -> None:
    for key, value in (STATE_SETTINGS | RUN_ONCE_SETTINGS).items():
        spark.conf.set(key, value)
