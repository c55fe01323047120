"""Writers: JSONL, routed by split, arrays, one-row reports, appends that rewrite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, columns: list[str] | None = None, one_file: bool = False) -> None:
    """Compact JSON, one row a line, non-ASCII characters as they are."""
    rows = df.select(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}).alias("value"))
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").text(path)


def write_by_split(df: DataFrame, path: str, split_col: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split_col).json(path)


def append_stream(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def json_array(df: DataFrame, order: Column) -> DataFrame:
    """All rows as one JSON array: for results of a size that one value may have."""
    rows = F.sort_array(F.collect_list(F.struct(order.alias("o"), F.struct(*df.columns).alias("r"))))
    return df.agg(F.to_json(F.transform(rows, lambda x: x["r"])).alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    """A frame of one row, nested as it is, as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_rewrite(existing: DataFrame, more: DataFrame, path: str) -> None:
    """Both, into a folder that must be a new one: Spark can't overwrite what it reads."""
    existing.unionByName(more, allowMissingColumns=True).write.mode("errorifexists").json(path)
