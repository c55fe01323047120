"""Column expressions over corpus text: cleaning, extraction, tokens, stable splits, digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode knows it.
_SPACE = r"(?U)\s+"
_EDGES = r"(?U)^\s+|\s+$"
#: Identifiers of techniques, and words.
TECHNIQUE_ID = r"\bT[0-9]{4}(?:\.[0-9]{3})?\b"
WORD = r"[A-Za-z][A-Za-z0-9_'\-]*"
CHARS_PER_TOKEN = 3.8
CHARS_PER_TOKEN_SYNTHESIS = 3.85


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def clean_text(text: Column) -> Column:
    """Citations dropped, markdown links reduced to their labels, white space collapsed; null is empty."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"\(Citation:[^)]+\)", "")
    plain = F.regexp_replace(plain, r"\[([^\]]+)\]\([^)]+\)", "$1")
    return strip(F.regexp_replace(plain, _SPACE, " "))


def truncate(text: Column, n: int) -> Column:
    """Cleaned text of at most n characters, cut at its last space and marked; without a space it is cut as it is."""
    s = clean_text(text)
    cut = F.regexp_replace(F.substring(s, 1, n - 1), " [^ ]*$", "")
    return F.when(F.length(s) <= n, s).otherwise(F.concat(cut, F.lit("…")))


def redact_techniques(text: Column) -> Column:
    return F.regexp_replace(text, TECHNIQUE_ID, "[redacted]")


def indent(text: Column, n: int = 2) -> Column:
    """Every line moved n spaces to the right; a final line break goes, an empty text stays empty."""
    lines = F.regexp_replace(text, r"\r\n?", "\n")
    lines = F.regexp_replace(lines, r"\n\z", "")
    return F.when(lines == "", lines).otherwise(F.concat(F.lit(" " * n), F.replace(lines, F.lit("\n"), F.lit("\n" + " " * n))))


def tagged(content: Column, tag: str) -> Column:
    """What stands between the first pair of tags, trimmed; null without one."""
    pattern = rf"(?s)<{tag}>\s*(.*?)\s*</{tag}>"
    return F.when(F.regexp_like(content, F.lit(pattern)), F.regexp_extract(content, pattern, 1))


def has_tags(content: Column, tag: str) -> Column:
    return F.contains(content, F.lit(f"<{tag}>")) & F.contains(content, F.lit(f"</{tag}>"))


def first_answer(content: Column) -> Column:
    """From behind the first opening tag of an answer to the first closing one; empty if that comes before."""
    start = F.instr(content, "<answer>") + F.lit(len("<answer>"))
    return F.substring(content, start, F.greatest(F.instr(content, "</answer>") - start, F.lit(0)))


def without_fence(text: Column) -> Column:
    """The inside of a code fence, if the text is one."""
    return strip(F.regexp_replace(strip(text), r"(?s)^```[A-Za-z]*\s*\n?(.*?)\n?```$", "$1"))


def without_reasoning_channel(text: Column, opened: str = "<think>", closed: str = "</think>") -> Column:
    return strip(F.regexp_replace(text, rf"(?s){opened}.*?{closed}", ""))


def after_marker(text: Column, marker: str) -> Column:
    """What follows the last marker; the whole text without one."""
    return strip(F.substring_index(text, marker, -1))


def resource_tail(name: Column, part: str) -> Column:
    """The last piece of a resource name after ``/part/``; a bare id is itself."""
    return F.substring_index(F.substring_index(strip(name), f"/{part}/", -1), "/", 1)


def base_field(key: Column) -> Column:
    """A field's name without its modifiers."""
    return F.split_part(key, F.lit("|"), F.lit(1))


def word_tokens(text: Column) -> Column:
    """ASCII words, found before they are lower-cased."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), F.lower)


def first_words(text: Column, n: int) -> Column:
    """The text up to the end of its n-th word of ``word_tokens``, or of its last if it has fewer; the rest isn't searched."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), rf"^(?:[^A-Za-z]*+{WORD}+){{0,{n}}}", 0)


def shingles(words: Column, n: int) -> Column:
    """Distinct runs of n words, joined by a space; fewer words have none."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def run_hashes(words: Column, n: int) -> Column:
    """64-bit hash of each run of n words, in order; fewer words have none."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<bigint>"))


def estimated_tokens(chars: Column, per_token: float = CHARS_PER_TOKEN) -> Column:
    return F.floor(chars / F.lit(per_token)).cast("long")


def message_chars(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0), lambda a, m: a + F.length(F.coalesce(m["content"], F.lit(""))))


def stable_split(key: Column, eval_pct: int) -> Column:
    """eval if the first byte of the key's md5, modulo 100, is below the percentage."""
    return F.when(F.conv(F.substring(F.md5(key), 1, 2), 16, 10).cast("int") % 100 < eval_pct, "eval").otherwise("train")


def content_id(length: int, *parts: Column) -> Column:
    return F.substring(F.sha2(F.to_json(F.array(*parts)), 256), 1, length)


def seeded(key: Column, seed: int) -> Column:
    """An order that a seed fixes whatever the partitions; md5, so that other engines can follow it."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def picked(templates: list[str], key: Column) -> Column:
    """One of the templates, by the key's md5."""
    at = F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("int") % len(templates)
    return F.element_at(F.array(*[F.lit(t) for t in templates]), at + 1)


def filled(template: Column, **values: Column) -> Column:
    """A template with each ``{name}`` replaced, in one pass: what a value says is not replaced again; nulls count as empty."""

    def value(part: Column) -> Column:
        out = part
        for name, v in values.items():
            out = F.when(part == F.lit("{" + name + "}"), F.coalesce(v.cast("string"), F.lit(""))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(template, r"(?=\{)|(?<=\})"), value), "")


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def is_json_object(text: Column) -> Column:
    return is_json(text) & F.ltrim(text).startswith("{")


def or_else(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])
