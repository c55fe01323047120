"""Chat records: built, re-shaped for export, merged with their origin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import content_id, tagged

MODES = ("tags", "reasoning_content", "answer_only")


def chat(system: Column, user: Column, assistant: Column) -> Column:
    pairs = [("system", system), ("user", user), ("assistant", assistant)]
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in pairs])


def tagged_answer(reasoning: Column, answer: Column) -> Column:
    return F.concat(F.lit("<reasoning>"), reasoning, F.lit("</reasoning>\n<answer>"), answer, F.lit("</answer>"))


def export_messages(messages: Column, mode: str) -> Column:
    """Messages as they are, with the reasoning moved to a field of its own, or with the answer alone."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    content = messages[2]["content"]
    answer = F.concat(F.lit("<answer>"), tagged(content, "answer"), F.lit("</answer>"))
    reasoning = tagged(content, "reasoning") if mode == "reasoning_content" else F.lit(None).cast("string")
    last = content if mode == "tags" else answer
    each = [(messages[i]["role"], messages[i]["content"], F.lit(None).cast("string")) for i in (0, 1)] + [(F.lit("assistant"), last, reasoning)]
    return F.array(*[F.struct(r.alias("role"), c.alias("content"), x.alias("reasoning_content")) for r, c, x in each])


def conversations(messages: Column, system_prompt: str | None = None) -> Column:
    """The from/value shape, its system prompt replaced if one is given."""
    value = lambda m: F.when((m["role"] == "system") & F.lit(system_prompt is not None), F.lit(system_prompt)).otherwise(m["content"])
    return F.transform(messages, lambda m: F.struct(m["role"].alias("from"), value(m).alias("value")))


def with_ids(records: DataFrame) -> DataFrame:
    """Records with an id made of what they say."""
    return records.withColumn("id", content_id(20, F.to_json("messages")))


def merge(*corpora: DataFrame) -> DataFrame:
    out = corpora[0]
    for c in corpora[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def with_origin(records: DataFrame, **origin: Column) -> DataFrame:
    """Records whose meta has further fields; fields of the same name are replaced."""
    meta = F.col("meta")
    for name, value in origin.items():
        meta = meta.withField(name, value)
    return records.withColumn("meta", meta)
