"""Personal data by DataFrame functions only: patterns propose, checksums confirm, context words move the score.

Positions come from splitting a text by the pattern that found the matches: a match starts where the pieces and
matches before it end.  Quantifiers are possessive where nothing after them could make them give back, and a class run
is entered only at its start or where the last match ended (``\\G``); both leave the matches as they are and keep long
runs linear and off the Java stack.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds whose spans are always reported, in the order that breaks ties of a start.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A character without which the pattern cannot match.
_NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
_BYTE_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
#: Words that, near a span, make its kind likelier.
_CONTEXT = {
    "email": "mail|contact|write|e-mail",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|tax",
}
CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
#: Matches folded one after another.
BLOCK = 256
ACCEPT = 0.5


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn."""
    marks = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2),
    )
    return F.aggregate(marks, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces leaves 1 when its rearranged digits are divided by 97."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_BYTE_PART}(?:\.{_BYTE_PART}){{3}}$")
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(m) < 12, False).when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return F.size(_accounts(m)) > 0
    return F.lit(True)


def _accounts(m: Column) -> Column:
    """Of the heads of a match that end before a blank or with it, those of 15 characters or more that pass mod-97.

    A match may run on into the words behind an account number.
    """
    words = F.split(m, " ")
    heads = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))
    return F.filter(heads, lambda h: (F.length(F.replace(h, F.lit(" "), F.lit(""))) >= 15) & mod97(F.replace(h, F.lit(" "), F.lit(""))))


def _length(kind: str, m: Column) -> Column:
    """How much of a match is its span."""
    return F.length(F.element_at(_accounts(m), -1)) if kind == "iban" else F.length(m)


def _score(kind: str, before: Column, after: Column) -> Column:
    near = F.lower(F.concat_ws(" ", before, after)).rlike(rf"\b(?:{_CONTEXT[kind]})\b")
    return F.least(F.lit(1.0), F.lit(_SCORE[kind]) + F.when(near, CONTEXT_GAIN).otherwise(0.0))


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(kind: str, text: Column, found: Column) -> Column:
    """array<struct<start, ord, end, kind, score>> of the matches that pass; ``found``: all matches in order.

    Matches go in blocks of ``BLOCK``, whose starts are sums over blocks, so that a text full of matches costs little
    more than in proportion to them; a match's context is cut from the pieces and matches next to it.
    """
    shape = "array<struct<start:int,ord:int,end:int,kind:string,score:double>>"
    nothing = F.array().cast(shape)
    # no match is shorter than 2 characters, so this many beside one hold its whole context
    beside = CONTEXT_CHARS // 2 + 1

    def with_parts(parts: Column) -> Column:
        pieces, matches = parts["pieces"], parts["matches"]
        many = F.size(matches)
        size = lambda i: F.length(F.get(pieces, i)) + F.length(F.get(matches, i))
        ids = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

        def context(i: Column) -> tuple[Column, Column]:
            joined = lambda low, high: F.array_join(F.transform(ids(low, high), lambda k: F.concat(F.get(matches, k), F.get(pieces, k + 1))), "")
            first = F.greatest(i - beside, F.lit(0))
            before = F.concat(F.get(pieces, first), joined(first, i - 1))
            after = F.concat(F.get(pieces, i + 1), F.array_join(F.transform(ids(i + 1, F.least(i + beside, many - 1)), lambda k: F.concat(F.get(matches, k), F.get(pieces, k + 1))), ""))
            return F.right(before, F.lit(CONTEXT_CHARS)), F.left(after, F.lit(CONTEXT_CHARS))

        def block(lengths: Column, b: Column) -> Column:
            begin = F.aggregate(F.slice(lengths, F.lit(1), b), F.lit(0), lambda a, n: a + n)

            def step(acc: Column, i: Column) -> Column:
                match = F.get(matches, i)
                start = acc["at"] + F.length(F.get(pieces, i))
                end = start + F.length(match)
                span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), (start + _length(kind, match)).alias("end"), F.lit(kind).alias("kind"), _score(kind, *context(i)).alias("score"))
                return F.struct(end.alias("at"), F.when(_valid(kind, match), F.concat(acc["spans"], F.array(span).cast(shape))).otherwise(acc["spans"]).alias("spans"))

            mine = ids(b * BLOCK, F.least((b + 1) * BLOCK, many) - 1)
            return F.aggregate(mine, F.struct(begin.alias("at"), nothing.alias("spans")), step, lambda acc: acc["spans"])

        blocks = F.sequence(F.lit(0), ((many - 1) / BLOCK).cast("int"))
        lengths = F.transform(blocks, lambda b: F.aggregate(ids(b * BLOCK, F.least((b + 1) * BLOCK, many) - 1), F.lit(0), lambda a, i: a + size(i)))
        return F.flatten(_let(lengths, lambda n: F.transform(blocks, lambda b: block(n, b))))

    parts = F.struct(F.split(text, _PATTERNS[kind], -1).alias("pieces"), found.alias("matches"))
    return F.when(F.size(found) > 0, _let(parts, with_parts)).otherwise(nothing)


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``pii``: array<struct<start, ord, end, kind, score>>, by start and then kind.

    Starts and ends count code points, ends exclusive.  Base kinds (email, ip, card, phone) are reported whenever they
    pass their check; iban needs mod-97, and ssn needs a context word within 40 characters to reach the accepted score.
    A null text counts as empty and has no spans; texts of any length are read whole, in time about in proportion to
    their length and matches; rows that repeat are read one by one; an empty table gives no rows; other columns pass
    through, and a column named ``pii`` is replaced.
    """
    keep = [c for c in docs.columns if c != "pii"]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text.alias("text"))
    for kind in KINDS:
        found = F.regexp_extract_all(F.col("text"), F.lit(_PATTERNS[kind]), F.lit(0))
        need = _NEEDS.get(kind)
        none = F.array().cast("array<string>")
        row = row.withColumn(kind, F.when(F.contains(F.col("text"), F.lit(need)), found).otherwise(none) if need else found)
    spans = [_spans(k, F.col("text"), F.col(k)) for k in KINDS]
    every = F.concat(*spans)
    kept = F.filter(every, lambda s: s["kind"].isin(*BASE_KINDS) | (s["score"] >= ACCEPT))
    return row.select("row", F.sort_array(kept).alias("pii")).select("row.*", "pii")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each base kind, the digest of the base spans, and all spans as text, for every row of ``docs``.

    A null or empty text has counts of zero and the digest of the empty text; an empty table gives no rows.
    """
    found = find_pii(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"))


def span_values(found: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for each span of ``find_pii``'s result, with the text it covers."""
    others = [F.col(f"`{c}`") for c in found.columns if c not in ("pii", text_col)]
    rows = found.select(*others, F.col(text_col).alias("_text"), F.explode("pii").alias("_s"))
    value = F.substring(F.col("_text"), F.col("_s.start") + 1, F.col("_s.end") - F.col("_s.start"))
    return rows.select(*others, F.col("_s.kind").alias("kind"), F.col("_s.start").alias("start"), F.col("_s.end").alias("end"), F.col("_s.score").alias("score"), value.alias("value"))


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``; of overlapping spans the first wins."""
    found = find_pii(docs, text_col)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        took = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))
        return F.when(s["start"] >= acc["at"], took).otherwise(acc)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("pii", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.withColumn(text_col, F.when(F.size("pii") > 0, clean).otherwise(F.col(f"`{text_col}`"))).drop("pii")


def any_of(kinds: list[str]) -> Column:
    """Whether ``pii`` has a span of one of ``kinds``."""
    return F.exists("pii", lambda s: reduce(lambda a, b: a | b, [s["kind"] == k for k in kinds]))
