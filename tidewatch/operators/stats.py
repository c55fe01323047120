"""Counts, histograms, totals and costs of corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENS_PER_SECOND = 7000
A100_RATE, H100_RATE, H100_SHARE = 2.79, 3.99, 0.6


def task_totals(df: DataFrame, task: str = "task", tokens: str = "n_tokens") -> DataFrame:
    """Count, sum, maximum and floored mean of tokens of each task, and of all."""
    n, total = F.count("*"), F.coalesce(F.sum(tokens), F.lit(0))
    got = df.rollup(task).agg(n.alias("n"), total.alias("tokens"), F.coalesce(F.max(tokens), F.lit(0)).alias("max_tokens"), F.floor(total / F.greatest(n, F.lit(1))).alias("avg_tokens"), F.grouping(task).alias("_g"))
    return got.withColumn(task, F.when(F.col("_g") == 1, "TOTAL").otherwise(F.coalesce(F.col(task), F.lit("unknown")))).drop("_g")


def profile(df: DataFrame, dims: list[str], tokens: str) -> DataFrame:
    """dimension, value, n, tokens: a histogram for each dimension and the whole, in one pass."""
    sets = [[F.col(d)] for d in dims] + [[]]
    got = df.groupingSets(sets, *[F.col(d) for d in dims]).agg(F.count("*").alias("n"), F.sum(tokens).alias("tokens"), *[F.grouping(d).alias(f"_g{i}") for i, d in enumerate(dims)])
    name, value = F.lit("all"), F.lit(None).cast("string")
    for i, d in enumerate(dims):
        name = F.when(F.col(f"_g{i}") == 0, d).otherwise(name)
        value = F.when(F.col(f"_g{i}") == 0, F.col(d).cast("string")).otherwise(value)
    return got.select(name.alias("dimension"), value.alias("value"), "n", "tokens")


def crosstab(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    return df.groupBy(row).pivot(col, values).count().na.fill(0, values)


def count_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Counts by key, ordered by it; a null key is ``unknown``."""
    return df.groupBy(F.coalesce(key, F.lit("unknown")).alias(name)).agg(F.count("*").alias("n")).orderBy(name)


def most_common(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Counts, largest first; ties by key, where the order of first meeting would depend on partitions."""
    got = df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)
    return got if n is None else got.limit(n)


def histogram_json(df: DataFrame, group: str, key: str) -> DataFrame:
    """group, histogram: counts of each key as a JSON object, keys in order."""
    two = df.groupBy(group, key).agg(F.count("*").alias("n")).where(F.col(key).isNotNull())
    return two.groupBy(group).agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, "n"))))).alias("histogram"))


def registry(records: DataFrame, topics: DataFrame) -> DataFrame:
    """file, domain, records, tokens, tasks of each file with records; a topic that isn't listed is ``other``."""
    got = records.groupBy("file").agg(F.count("*").alias("records"), F.sum("n_tokens").alias("tokens")).join(histogram_json(records, "file", "task").withColumnRenamed("histogram", "tasks"), "file", "left")
    return got.join(topics, "file", "left").withColumn("domain", F.coalesce("domain", F.lit("other")))


def training_cost(tokens: Column, epochs: int) -> dict[str, Column]:
    """Hours and dollars of a run on either accelerator."""
    hours = tokens * epochs / F.lit(TOKENS_PER_SECOND) / 3600.0
    return {"a100_hours": F.round(hours, 2), "a100_usd": F.round(hours * A100_RATE, 2), "h100_hours": F.round(hours * H100_SHARE, 2), "h100_usd": F.round(hours * H100_SHARE * H100_RATE, 2)}


def file_info(records: DataFrame, digests: DataFrame) -> DataFrame:
    """file, records, tokens, bytes, sha256."""
    return records.groupBy("file").agg(F.count("*").alias("records"), F.sum("n_tokens").alias("tokens")).join(digests, "file", "left")


def role_histogram(chats: DataFrame) -> DataFrame:
    return chats.select(F.explode("messages").alias("m")).groupBy(F.col("m.role").alias("role")).agg(F.count("*").alias("n"))
