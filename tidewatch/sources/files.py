"""Files: JSONL in its strict, tolerant and numbered forms, whole documents, globs, digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.tables import placed


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whichever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def jsonl(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """Strict: a malformed line fails the read, blank lines are skipped."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Malformed lines are dropped, whichever columns are read later."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    struct = T._parse_datatype_string(schema)
    struct = struct.add("_bad", "string")
    row = lines.select(F.from_json("value", struct, {"columnNameOfCorruptRecord": "_bad"}).alias("row"))
    return row.where("row._bad is null").select("row.*").drop("_bad")


def numbered_lines(spark: SparkSession, path: str, blank: bool = False) -> DataFrame:
    """file, line, value of all lines that aren't blank; line counts physical lines from 1, blank ones too.

    Large files are read in blocks by many tasks: a first pass counts the lines of each block, and a line's number is
    its place in the block behind the lines of the blocks before.  With ``blank``, blank lines have rows as well.
    """
    at = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), *at, "value")
    rows = placed(lines, ["_path", "_block"], restart=1).select("file", F.col("_place").alias("line"), F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("value"))
    return rows if blank else rows.where("value <> ''")


def line_range(lines: DataFrame, first: int, last: int) -> DataFrame:
    return lines.where(F.col("line").between(first, last))


#: File names that hold no finished records, by the two rules in use.
JUNK_PARTS = ("fragment", "temp")
JUNK_PREFIXES = ("phi1_fragment", "temp", "fragment")


def without_junk(df: DataFrame, file_col: str = "file", rule: str = "prefix") -> DataFrame:
    """rule ``part``: names with a junk word anywhere go; ``prefix``: names whose stem begins with one."""
    name = F.col(file_col)
    if rule == "part":
        junk = F.lower(name).rlike("|".join(JUNK_PARTS))
    elif rule == "prefix":
        junk = name.rlike("^(?:" + "|".join(JUNK_PREFIXES) + ")")
    else:
        raise ValueError("rule must be 'part' or 'prefix'")
    return df.where(name.endswith(".jsonl") & ~junk)


def json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def json_map(spark: SparkSession, path: str, value_type: str) -> DataFrame:
    """key, value of one JSON object of any keys."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value_type}>")))


def keyed_last(df: DataFrame, key: str, order: str = "line") -> DataFrame:
    """One row per key: the last by ``order``."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_row")).select(key, "_row.*")


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where(F.trim("value") != "").count()


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes, sha256."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def task_files(spark: SparkSession, folder: str, names: list[str], schema: str) -> tuple[DataFrame, list[str]]:
    """Rows of each task's file with its task_type, and the names that had no file."""
    there = [n for n in names if exists(spark, f"{folder}/{n}.jsonl")]
    rows = None
    for n in there:
        part = jsonl(spark, f"{folder}/{n}.jsonl", schema).withColumn("task_type", F.lit(n))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is None:
        rows = spark.createDataFrame([], schema + ", task_type string")
    return rows, [n for n in names if n not in there]
