"""Model evaluation: cases, answers scored, summaries, winners."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import content_id, is_json_object, seeded, tagged


def with_case_ids(cases: DataFrame) -> DataFrame:
    return cases.withColumn("case_id", content_id(16, F.col("system"), F.col("user")))


def parsed_cases(lines: DataFrame) -> DataFrame:
    """lines (file, line, value) -> cases with ``problem``: what keeps a line from being one, null if nothing does.

    A case has a system, a user and an assistant message in this order, each with text; meta, if there, is an object.
    case_id: file, line, and 16 digits of the SHA-256 of the prompt's messages as JSON.
    """
    rec = F.try_parse_json("value")
    of = lambda path: F.get_json_object("value", path)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(rec, path, "variant"))
    problem = F.when(rec.isNull(), "json").when(of("$.messages").isNotNull() & ~of("$.messages").startswith("["), "messages")
    text = []
    for i, role in enumerate(("system", "user", "assistant")):
        said = F.try_variant_get(rec, f"$.messages[{i}].content", "string")
        right = (F.try_variant_get(rec, f"$.messages[{i}].role", "string") == role) & (kind(f"$.messages[{i}].content") == "STRING") & (F.trim(said) != "")
        problem = problem.when(~F.coalesce(right, F.lit(False)), f"message {i}: {role}")
        text.append(said)
    meta = of("$.meta")
    problem = problem.when(meta.isNotNull() & ~meta.startswith("{") & ~meta.isin("", "null", "0", "false", "[]"), "meta")
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    prompt = F.concat(F.lit('[{"content": '), quoted(text[0]), F.lit(', "role": "system"}, {"content": '), quoted(text[1]), F.lit(', "role": "user"}]'))
    case_id = F.concat_ws(":", "file", F.col("line").cast("string"), F.substring(F.sha2(prompt, 256), 1, 16))
    ids = F.coalesce(F.from_json(F.get_json_object(meta, "$.source_ids"), "array<string>"), F.array().cast("array<string>"))
    return lines.select(
        "file", "line", problem.alias("problem"), case_id.alias("case_id"), text[0].alias("system"), text[1].alias("user"), text[2].alias("target"),
        F.get_json_object(meta, "$.source_book").alias("source_book"), F.get_json_object(meta, "$.task").alias("task"), ids.alias("source_ids"),
    )


def load_cases(lines: DataFrame, limit: int, seed: int) -> DataFrame:
    """The cases of numbered lines, in their order: all, or ``limit`` of them that the seed fixes; a line that is none fails the load."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    cases = parsed_cases(lines)
    bad = cases.where("problem is not null").orderBy("file", "line").select("file", "line", "problem").first()
    if bad:
        raise ValueError(f"{bad.file}:{bad.line}: {bad.problem}")
    if cases.isEmpty():
        raise ValueError("no cases")
    return cases.drop("problem").orderBy(seeded(F.col("case_id"), seed), "case_id").limit(limit).orderBy("file", "line")


def model_cases(models: DataFrame, cases: DataFrame) -> DataFrame:
    """Every case for every model, however many there are: the models are the small side and are broadcast."""
    return cases.crossJoin(F.broadcast(models.select("label")))


def score_content(df: DataFrame, content: str = "content") -> DataFrame:
    """Tag flags, whether the answer is a JSON object, its sorted keys, length and digest."""
    c = F.coalesce(F.col(content), F.lit(""))
    answer = tagged(c, "answer")
    has = lambda t: F.contains(c, F.lit(t))
    ok = F.coalesce(is_json_object(answer), F.lit(False))
    return df.withColumns({
        "reasoning_open": has("<reasoning>"), "reasoning_close": has("</reasoning>"), "answer_open": has("<answer>"), "answer_close": has("</answer>"),
        "answer_json_valid": ok, "answer_keys": F.when(ok, F.array_sort(F.json_object_keys(answer))).otherwise(F.array().cast("array<string>")),
        "char_count": F.length(c), "sha256": F.sha2(c, 256),
    })


def run_model(cases: DataFrame, prompt: str, ask: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """``cases`` with content: a callable answers batches of prompts on the executors; a batch that fails has its error in ``error``."""
    out = T.StructType(list(cases.schema.fields)).add("content", "string").add("error", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            try:
                yield pdf.assign(content=ask(pdf[prompt]), error=None)
            except Exception as e:  # noqa: BLE001  a failed call is a row of the result
                yield pdf.assign(content=None, error=str(e)[:500])

    return cases.mapInPandas(run, out)


def summary(results: DataFrame) -> DataFrame:
    """Per label: cases and errors; of rows without an error whole tags, valid answers, latency, tokens, finish reasons as JSON."""
    ok = F.col("error").isNull()
    reasons = results.where(ok).groupBy("label", F.coalesce("finish_reason", F.lit("unknown")).alias("reason")).count()
    reasons = reasons.groupBy("label").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "count"))))).alias("finish_reasons"))
    got = results.groupBy("label").agg(
        F.count("*").alias("cases"), F.count_if(~ok).alias("errors"), F.count_if(ok & F.col("answer_json_valid")).alias("valid_json"),
        F.round(F.avg(F.when(ok, F.col("latency_seconds"))), 3).alias("avg_latency"), F.max(F.when(ok, F.col("latency_seconds"))).alias("max_latency"),
        *[F.count_if(ok & F.col(f"{t}_open") & F.col(f"{t}_close")).alias(f"valid_{t}_tags") for t in ("reasoning", "answer")],
        *[F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens") if c in results.columns],
    )
    return got.join(reasons, "label", "left")


def winners(judged: DataFrame) -> DataFrame:
    """label, average and cases won: of each case the highest score wins, ties go to the label that comes first."""
    best = judged.groupBy("case_id").agg(F.max("score").alias("_top"))
    firsts = judged.join(best, "case_id").where("score = _top").groupBy("case_id").agg(F.min("label").alias("label"))
    won = firsts.groupBy("label").agg(F.count("*").alias("wins"))
    return judged.groupBy("label").agg(F.round(F.avg("score"), 2).alias("avg_score")).join(won, "label", "left").na.fill(0, ["wins"])
