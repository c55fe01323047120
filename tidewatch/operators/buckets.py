"""Tables in buckets of key hashes: an upsert rewrites the buckets that it touches, and readers see whole versions.

``data/version=V/table=T/bucket=B`` has the rows of a bucket as version V left them; ``commits/of=V`` has a row for each
bucket of each table with the version that wrote it last.  The commit is written after the data, in one piece, and a
version counts from then on; a version that runs again writes the same files anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.operators.store import EVENT_FIRST, EVENT_LAST, FINDING_FIRST, FINDING_LAST, hosts, split_by_key, upsert

_MARKS = "version long, table string, bucket int, written long"


@dataclass(frozen=True)
class Buckets:
    """A folder of tables, each with its schema and its key, all dealt to the same number of buckets."""

    spark: SparkSession
    folder: str
    schemas: Mapping[str, str]
    keys: Mapping[str, str]
    many: int = 64

    def columns(self, table: str) -> list[Column]:
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(self.schemas[table])]

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.many)).cast("int")

    def current(self, before: int | None = None) -> int | None:
        """The last committed version, of those before ``before``."""
        try:
            marks = self.spark.read.schema(_MARKS).json(f"{self.folder}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return marks.where(F.lit(True) if before is None else F.col("version") < before).agg(F.max("version").alias("v")).first().v

    def manifest(self, version: int | None) -> dict[tuple[str, int], int]:
        """The version that wrote each bucket of each table, as of ``version``: ``many`` entries a table at most."""
        if version is None:
            return {}
        rows = self.spark.read.schema(_MARKS).json(f"{self.folder}/commits/of={version}").collect()
        return {(r.table, r.bucket): r.written for r in rows if r.table is not None}

    def read(self, table: str, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """A table as of a version, the last one if none is named, or those of its buckets; no other file is opened."""
        marks = self.manifest(self.current() if version is None else version)
        mine = {b: v for (t, b), v in marks.items() if t == table and (only is None or b in only)}
        paths = [f"{self.folder}/data/version={v}/table={table}/bucket={b}" for b, v in sorted(mine.items())]
        return self.spark.read.schema(self.schemas[table]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[table])

    def before(self, table: str, last: int | None, only: list[int]) -> DataFrame:
        return self.spark.createDataFrame([], self.schemas[table]) if last is None else self.read(table, last, only)

    def touched(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets of the rows' keys: ``many`` numbers at most."""
        return sorted(r.b for r in rows.where(F.col(key).isNotNull()).select(self.bucket(F.col(key)).alias("b")).distinct().collect())

    def commit(self, version: int, changes: Mapping[str, tuple[list[int], DataFrame]], last: int | None) -> None:
        """changes: table -> (buckets, all their rows now, some in each); other buckets stay what they were in ``last``."""
        marks = self.manifest(last)
        for table, (numbers, rows) in changes.items():
            dealt = rows.select(*self.columns(table)).withColumn("bucket", self.bucket(F.col(self.keys[table])))
            dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/data/version={version}/table={table}")
            marks |= {(table, b): version for b in numbers}
        rows = [(version, t, b, v) for (t, b), v in sorted(marks.items())] or [(version, None, None, None)]
        self.spark.createDataFrame(rows, _MARKS).coalesce(1).write.mode("overwrite").json(f"{self.folder}/commits/of={version}")

    def upsert(self, version: int, table: str, writes: DataFrame, first: list[str], late: list[str], order: str = "pos") -> None:
        """One table's writes, committed as ``version``; rows without a key are left out, as a primary key would refuse them."""
        key, last = self.keys[table], self.current(version)
        writes = writes.where(F.col(key).isNotNull())
        numbers = self.touched(writes, key)
        self.commit(version, {table: (numbers, upsert(self.before(table, last, numbers), writes, key, order, first, late))}, last)

    def rewritten_bytes(self, version: int) -> int:
        """Bytes of the files that a version wrote."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.folder}/data/version={version}")
        return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first().n


def load(tables: Buckets, version: int, events: DataFrame, analyses: DataFrame) -> None:
    """Hosts, events and findings after a batch, committed as one version; rejected analyses go to ``rejected/version=V``.

    events and analyses have a column ``pos``, their order in the stream.  Events come first; a finding whose event is
    in none of the buckets is rejected, as a foreign key would.  Only buckets of the batch's keys are read and written.
    """
    last = tables.current(version)
    events, analyses = events.where("event_id is not null").persist(), analyses.where("analysis_id is not null").persist()
    own = tables.touched(events, "event_id")
    new_events = upsert(tables.before("events", last, own), events, "event_id", "pos", EVENT_FIRST, EVENT_LAST).persist()
    elsewhere = [b for b in tables.touched(analyses, "event_id") if b not in own]
    known = new_events.select("event_id").unionByName(tables.before("events", last, elsewhere).select("event_id"))
    ok, rejected = split_by_key(analyses, known, "event_id")
    ok = ok.persist()
    mine = tables.touched(ok, "analysis_id")
    new_findings = upsert(tables.before("findings", last, mine), ok, "analysis_id", "pos", FINDING_FIRST, FINDING_LAST)
    seen = hosts(events).where("host_id is not null").select(*tables.columns("hosts"))
    theirs = tables.touched(seen, "host_id")
    both = tables.before("hosts", last, theirs).unionByName(seen)
    new_hosts = both.groupBy("host_id").agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
    rejected.write.mode("overwrite").json(f"{tables.folder}/rejected/version={version}")
    tables.commit(version, {"events": (own, new_events), "findings": (mine, new_findings), "hosts": (theirs, new_hosts)}, last)
    for df in (events, analyses, new_events, ok):
        df.unpersist()
