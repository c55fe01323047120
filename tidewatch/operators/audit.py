"""Contract audits: lists of checks, compiled into one pass over the lines of a corpus.

A check names what it looks at, from which level of a line on, and gives the details it finds, none if the line is in
order.  ``audited`` evaluates a list of checks on every line at once; issues, counts by file and valid records are read
from its result.  Levels: 0 a line that is no JSON, 1 without three messages, 2 without a meta object, 3 whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import CHARS_PER_TOKEN_SYNTHESIS, estimated_tokens, is_json, is_json_object, strip, tagged
from tidewatch.operators.dedupe import first_seen

ROLES = ("system", "user", "assistant")
#: Fields, keys, phrases and identifier styles that the audits ask for or forbid.
META_FIELDS = ("task", "source_ids", "source_book", "split", "synthesized")
CORE_ANSWER_KEYS = ("summary", "evidence", "hypotheses", "actions")
PHRASES_STRICT = ("from the book", "book excerpt", "raw chunk", "parser output", "the chunk talks about", "the passage says")
PHRASES_RANGE = (*PHRASES_STRICT, "page ", "chapter ", "excerpt")
#: Fixed values, as alternatives of one expression; a ``concept-`` name needs no groups of its own, its letters have the hyphen.
STYLES_STRICT = (
    r"owasp-\d{4}-a\d{2}",
    r"mitre-T\d{4}(?:\.\d{3})?",
    r"cve-\d{4}-\d{4,7}",
    r"ghsa-[a-z0-9]{4}-[a-z0-9]{4}-[a-z0-9]{4}",
    r"cisa-kev-cve-\d{4}-\d{4,7}",
    r"gtfobins-[a-z0-9_.+-]+",
    r"lolbas-[a-z0-9_.+-]+",
    r"sigma-[A-Za-z0-9_.:-]+",
    r"concept-[a-z0-9_.+-]+",
)
STYLES_RANGE = (
    r"owasp-\d{4}-a\d{2}",
    r"owasp-masvs-[a-z0-9_.+-]+",
    r"mitre-T\d{4}(?:\.\d{3})?",
    r"mitre-mobile-T\d{4}(?:\.\d{3})?",
    r"cisa-kev-cve-\d{4}-\d{4,7}",
    r"gtfobins-[a-z0-9_.+-]+",
    r"lolbas-[a-z0-9_.+-]+",
    r"sigma-[A-Za-z0-9_.:-]+",
    r"concept-[a-z0-9_.+-]+",
)
#: Keys of an export row.
ALLOWED_ROOT_KEYS = ("messages", "tools", "weight")


def one_of(styles: tuple[str, ...]) -> str:
    return "^(?:" + "|".join(styles) + ")$"


@dataclass(frozen=True)
class Check:
    """``finds``: the details of what is wrong, as an array, or whether anything is; asked of lines of ``level`` or more."""

    code: str
    level: int
    finds: Callable[[], Column]
    #: Lines of exactly that level only: what keeps a line from the next one.
    only: bool = False

    def issues(self) -> Column:
        found = self.finds()
        at = F.col("level") == self.level if self.only else F.col("level") >= self.level
        return F.transform(F.when(at, found), lambda d: F.struct(F.lit(self.code).alias("code"), d.alias("detail")))


def when(bad: Column, detail: Column | None = None) -> Column:
    """One detail, empty if there is nothing to say, where ``bad`` holds; null counts as not."""
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.lit("") if detail is None else detail))


def parse(lines: DataFrame) -> DataFrame:
    """lines (file, line, value) with their level and a record's parts."""
    rec = F.try_parse_json("value")
    get = lambda path, kind: F.try_variant_get(rec, path, kind)
    of = lambda path: F.get_json_object("value", path)
    n = F.when(of("$.messages").startswith("["), F.size(F.from_json(of("$.messages"), "array<string>")))
    role, content = ([get(f"$.messages[{i}].{c}", "string") for i in range(3)] for c in ("role", "content"))
    meta = F.when(of("$.meta").startswith("{"), of("$.meta"))
    rows = lines.select(
        "*", F.when(rec.isNull(), 0).when(F.coalesce(n != 3, F.lit(True)), 1).when(meta.isNull(), 2).otherwise(3).alias("level"),
        F.array(*role).alias("roles"), F.array(*[F.coalesce(c, F.lit("")) for c in content]).alias("contents"), meta.alias("meta"),
    )
    ids = F.get_json_object("meta", "$.source_ids")
    return rows.withColumns({
        "answer": tagged(F.col("contents")[2], "answer"), "reasoning": tagged(F.col("contents")[2], "reasoning"),
        "source_ids": F.when(ids.startswith("["), F.from_json(ids, "array<string>")), "id_types": F.when(ids.startswith("["), F.transform(F.from_json(ids, "array<variant>"), F.schema_of_variant)),
        "task": F.get_json_object("meta", "$.task"), "source_book": F.get_json_object("meta", "$.source_book"),
    })


def _location() -> Column:
    return F.concat_ws(":", "file", F.col("line").cast("string"))


def _stem() -> Column:
    return F.regexp_replace("file", r"\.[^.]*$", "")


def _list(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _field(name: str) -> Column:
    return F.coalesce(F.get_json_object("meta", f"$.{name}"), F.lit(""))


def missing_keys(names: tuple[str, ...], doc: str) -> Column:
    """The names that a column of JSON objects lacks, in their order; null if it is none."""
    return F.array_except(_list(names), F.json_object_keys(doc))


def _is_true(name: str) -> Column:
    value = F.try_variant_get(F.try_parse_json("meta"), f"$.{name}", "variant")
    return F.coalesce((F.schema_of_variant(value) == "BOOLEAN") & (_field(name) == "true"), F.lit(False))


NO_JSON = Check("json", 0, lambda: when(F.lit(True)), only=True)
NO_MESSAGES = Check("messages", 1, lambda: when(F.lit(True)), only=True)
NO_META = Check("meta", 2, lambda: when(F.lit(True)), only=True)
WRONG_ROLES = Check("roles", 2, lambda: when(~F.col("roles").eqNullSafe(_list(ROLES)), F.array_join("roles", ",", "?")))
META_FIELD = Check("meta_fields", 3, lambda: when(F.size(missing_keys(META_FIELDS, "meta")) > 0, F.array_join(missing_keys(META_FIELDS, "meta"), ",")))
NOT_SYNTHESIZED = Check("synthesized", 3, lambda: when(~_is_true("synthesized")))

STRICT = (
    NO_JSON, NO_MESSAGES, WRONG_ROLES,
    Check("tags", 2, lambda: F.filter(_list(("reasoning", "answer")), lambda t: ~(F.contains(F.col("contents")[2], F.concat(F.lit("<"), t, F.lit(">"))) & F.contains(F.col("contents")[2], F.concat(F.lit("</"), t, F.lit(">")))))),
    Check("answer_block", 2, lambda: when(F.col("answer").isNull())),
    Check("answer_json", 2, lambda: when(F.col("answer").isNotNull() & ~is_json(F.col("answer")))),
    NO_META, META_FIELD,
    Check("source_book", 3, lambda: when(_field("source_book") != _stem(), _field("source_book"))),
    NOT_SYNTHESIZED,
    Check("split", 3, lambda: when(_field("split") != "train", _field("split"))),
    Check("source_ids", 3, lambda: when(F.coalesce(F.size("source_ids"), F.lit(0)) <= 0)),
)


def short_reasoning(least: int) -> Check:
    return Check("reasoning_length", 2, lambda: when(F.length("reasoning") < least, F.length("reasoning").cast("string")))


def core_keys() -> Check:
    missing = lambda: F.array_sort(missing_keys(CORE_ANSWER_KEYS, "answer"))
    return Check("answer_keys", 2, lambda: when(is_json_object(F.col("answer")) & (F.size(missing()) > 0), F.array_join(missing(), ",")))


def phrases(words: tuple[str, ...]) -> Check:
    return Check("phrase", 2, lambda: F.filter(_list(words), lambda p: F.contains(F.lower(F.array_join("contents", "\n")), p)))


def id_styles(styles: tuple[str, ...]) -> tuple[Check, Check]:
    pairs = lambda: F.arrays_zip(F.col("source_ids").alias("id"), F.col("id_types").alias("type"))
    odd = lambda p: (p["type"] == "STRING") & ~F.regexp_like(p["id"], F.lit(one_of(styles)))
    return (
        Check("source_id_type", 3, lambda: F.transform(F.filter(pairs(), lambda p: p["type"] != "STRING"), lambda p: F.lower(p["type"]))),
        Check("source_id_style", 3, lambda: F.transform(F.filter(pairs(), odd), lambda p: p["id"])),
    )


RANGE = (*STRICT, core_keys(), phrases(PHRASES_RANGE), *id_styles(STYLES_RANGE))


def _basic(check: Check) -> Check:
    """As ``check``, of lines with the right roles only: wrong ones end a record's basic audit."""
    return Check(check.code, check.level, lambda: F.when(F.col("roles").eqNullSafe(_list(ROLES)), check.finds()), check.only)


BASIC = (
    NO_JSON, NO_MESSAGES, WRONG_ROLES,
    _basic(Check("tags", 2, lambda: when(~(F.contains(F.col("contents")[2], F.lit("<reasoning>")) & F.contains(F.col("contents")[2], F.lit("<answer>")))))),
    _basic(NO_META), _basic(META_FIELD), _basic(NOT_SYNTHESIZED),
)


def audited(parsed: DataFrame, checks: tuple[Check, ...] = STRICT) -> DataFrame:
    """``parsed`` with issues: (code, detail) of every check that finds something, in the order of the checks."""
    every = F.flatten(F.array(*[F.coalesce(c.issues(), F.array().cast("array<struct<code:string,detail:string>>")) for c in checks]))
    return parsed.withColumn("issues", every)


def issues(rows: DataFrame) -> DataFrame:
    """location, file, line, code, detail: a row an issue of audited lines."""
    return rows.select(_location().alias("location"), "file", "line", F.explode("issues").alias("i")).select("location", "file", "line", "i.code", "i.detail")


def strict_audit(parsed: DataFrame, checks: tuple[Check, ...] = STRICT, repeats: bool = False) -> DataFrame:
    """Issues of the checks, and with ``repeats`` those of ``duplicates``; wrong roles don't end a record's audit, a wrong level does."""
    found = issues(audited(parsed, checks))
    return found.unionByName(duplicates(parsed)) if repeats else found


def basic_audit(parsed: DataFrame) -> DataFrame:
    return issues(audited(parsed, BASIC))


def range_audit(parsed: DataFrame, first: int, last: int) -> DataFrame:
    """The strict audit of a range of lines, with its own phrases and styles and without duplicates."""
    return issues(audited(parsed.where(F.col("line").between(first, last)), RANGE))


def duplicates(parsed: DataFrame) -> DataFrame:
    """Repeats of a prompt, an answer, or a task with its sources among whole records; detail: the place of the first."""
    whole = parsed.where("level = 3").select("file", "line", "contents", "answer", "task", "source_ids")
    keys = F.array(
        F.struct(F.lit("repeated_prompt").alias("code"), F.sha2(F.col("contents")[1], 256).alias("key")),
        F.struct(F.lit("repeated_answer").alias("code"), F.sha2(strip(F.col("answer")), 256).alias("key")),
        F.struct(F.lit("repeated_task_sources").alias("code"), F.when(F.col("source_ids").isNotNull(), F.to_json(F.struct("task", F.array_sort("source_ids").alias("ids")))).alias("key")),
    )
    rows = whole.select("file", "line", F.explode(keys).alias("k")).select("file", "line", "k.code", "k.key").where("key is not null")
    seen = first_seen(rows, F.struct("code", "key"), [F.col("file"), F.col("line")], _location()).where("is_duplicate")
    return seen.select(_location().alias("location"), "file", "line", "code", F.col("first_place").alias("detail"))


def report(rows: DataFrame, repeats: DataFrame | None = None) -> DataFrame:
    """file, total_lines, valid_records (whole ones, issues aside) and issues of audited lines and, if given, their repeats."""
    counts = rows.select("file", F.lit(1).alias("lines"), (F.col("level") == 3).cast("int").alias("valid"), F.size("issues").alias("found"))
    if repeats is not None:
        counts = counts.unionByName(repeats.select("file", F.lit(0).alias("lines"), F.lit(0).alias("valid"), F.lit(1).alias("found")))
    return counts.groupBy("file").agg(F.sum("lines").alias("total_lines"), F.sum("valid").alias("valid_records"), F.sum("found").alias("issues"))


def export_errors(parsed: DataFrame) -> DataFrame:
    """The first thing that keeps each record from being exported: location, error."""
    error = (
        F.when(F.col("level") == 0, "json").when(F.col("level") == 1, "messages").when(~F.col("roles").eqNullSafe(_list(ROLES)), "roles")
        .when(F.exists("contents", lambda c: F.trim(c) == ""), "content").when(F.col("reasoning").isNull(), "reasoning")
        .when(F.col("answer").isNull(), "answer_block").when(~is_json(F.col("answer")), "answer_json").when(F.col("level") == 2, "meta")
        .when(_field("source_book") != _stem(), "source_book").when(~_is_true("synthesized"), "synthesized").when(_field("split") != "train", "split")
        .when(F.coalesce(F.size("source_ids"), F.lit(0)) <= 0, "source_ids")
    )
    return parsed.select(_location().alias("location"), error.alias("error")).where("error is not null")


def validate_rows(rows: DataFrame, min_reasoning: int = 200, tags: bool = True) -> DataFrame:
    """Export rows (location, value) -> location, n_tokens, issues (codes with their details): keys, roles, contents, answer."""
    msg = "array<struct<role:string,content:string,weight:string,reasoning_content:string>>"
    r = rows.withColumns({"m": F.from_json(F.get_json_object("value", "$.messages"), msg), "extra": F.array_except(F.json_object_keys("value"), _list(ALLOWED_ROOT_KEYS))})
    m, role = F.col("m"), F.transform("m", lambda x: x["role"])
    r = r.withColumn("a", F.when(F.array_contains(role, "assistant"), F.element_at(F.filter(m, lambda x: x["role"] == "assistant"), -1)))
    reasoning = F.coalesce(tagged(F.col("a.content"), "reasoning"), F.trim("a.reasoning_content"))
    answer, a, has = tagged(F.col("a.content"), "answer"), F.col("a").isNotNull(), F.coalesce(F.size(m) > 0, F.lit(False))
    found = {
        "keys": when(F.size("extra") > 0, F.array_join(F.array_sort("extra"), ",")),
        "messages": when(~has),
        "role": when(has & F.exists(m, lambda x: ~F.coalesce(x["role"].isin(*ROLES), F.lit(False)))),
        "content": when(has & F.exists(m, lambda x: x["content"].isNull())),
        "weight": when(has & F.exists(m, lambda x: ~F.coalesce(x["weight"].isin("0", "1"), F.lit(True)))),
        "system_first": when(has & F.array_contains(role, "system") & (F.element_at(role, 1) != "system")),
        "no_role": F.when(has, F.array_except(_list(("user", "assistant")), role)),
    }
    if tags:
        found |= {
            "reasoning": when(a & reasoning.isNull()),
            "reasoning_length": when(a & F.lit(min_reasoning > 0) & (F.length(F.coalesce(reasoning, F.lit(""))) < min_reasoning)),
            "answer_block": when(a & answer.isNull()),
            "answer_json": when(a & answer.isNotNull() & ~is_json(answer)),
            "answer_object": when(a & is_json(answer) & ~is_json_object(answer)),
        }

    def named(code: str, details: Column) -> Column:
        return F.transform(F.coalesce(details, F.array().cast("array<string>")), lambda d: F.when(d == "", F.lit(code)).otherwise(F.concat(F.lit(f"{code}:"), d)))

    chars = F.aggregate(m, F.lit(0), lambda s, x: s + F.length(F.coalesce(x["content"], F.lit(""))) + F.length(F.coalesce(x["reasoning_content"], F.lit(""))))
    return r.select("location", F.coalesce(estimated_tokens(chars, CHARS_PER_TOKEN_SYNTHESIS), F.lit(0).cast("long")).alias("n_tokens"), F.flatten(F.array(*[named(c, d) for c, d in found.items()])).alias("issues"))


def check_manifest(entries: DataFrame, results: DataFrame) -> DataFrame:
    """entries (file, records, sha256) against validated files (file, records, sha256): file, issue; results without an entry are ignored."""
    both = entries.join(results.select("file", F.col("records").alias("_n"), F.col("sha256").alias("_s")), "file", "left")
    every = F.array(F.when(F.col("_n").isNull(), "unknown_file"), F.when(F.col("_n") != F.col("records"), "records"), F.when(F.col("_s") != F.col("sha256"), "sha256"))
    return both.select("file", F.explode(F.array_compact(every)).alias("issue"))


def uncovered(counts: DataFrame, n: str = "n") -> DataFrame:
    """Groups that a coverage table lists without a row of theirs."""
    return counts.where(F.coalesce(F.col(n), F.lit(0)) <= 0)
