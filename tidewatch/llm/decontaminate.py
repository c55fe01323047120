"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed hashes six of eight neighbouring tokens; the two fixed masks below together hit every stretch of 13 aligned
tokens of which at most two differ, wherever the two fall, so nothing that the check accepts is missed.  Shorter items
have masks of their own length, and errors in proportion: from 7 tokens on one may differ, and of the two masks that
take every other token it spares one.  Seeds of all benchmark items are joined with the seeds of all documents; around
each hit the aligned tokens are compared.

Benchmark seeds are broadcast in blocks of a checked size; a larger benchmark costs more passes, never memory.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize

#: Token offsets of a seed. Every pair of errors in 13 positions leaves one of them untouched somewhere.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
WINDOW = 13
ERRORS = 2
#: Items with fewer tokens than this say too little to be recognised.
LEAST_TOKENS = 4
BROADCAST_SEEDS = 1_000_000


def token_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased letter and digit runs of a text, in order."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _errors(width):
    """Tokens that may differ in a stretch: 2 of 13, 1 of 7 to 12, none of fewer; a number or a column."""
    return width * ERRORS / WINDOW


@dataclass(frozen=True)
class Mask:
    """Token offsets of a seed inside ``span`` tokens; ``size``: the only item size it is for."""

    offsets: tuple[int, ...]
    span: int
    size: int | None = None


def _masks(short: list[int]) -> list[Mask]:
    out = [Mask(m, m[-1] + 1) for m in MASKS]
    for n in short:
        out += [Mask(tuple(range(k, n, 2)), n, n) for k in (0, 1)] if int(_errors(n)) else [Mask(tuple(range(n)), n, n)]
    return out


def _seed_hash(tokens: Column, at: Column, mask: Column, masks: list[Mask]) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("long"))
    for k, m in enumerate(masks):
        out = out.when(mask == k, F.xxhash64(F.lit(k), *[F.get(tokens, at + o) for o in m.offsets]))
    return out


def _seeds(rows: DataFrame, tokens: str, masks: list[Mask]) -> DataFrame:
    """A row for each position and mask that fits: at, mask, span, seed, beside the columns of ``rows``."""
    least = min(m.span for m in masks)
    n = len(masks)
    fits = rows.where(F.size(tokens) >= least)
    every = fits.select("*", F.explode(F.sequence(F.lit(0), (F.size(tokens) - least + 1) * n - 1)).alias("_k"))
    every = every.withColumn("at", (F.col("_k") / n).cast("int")).withColumn("mask", F.col("_k") % n).drop("_k")
    span = F.element_at(F.array(*[F.lit(m.span) for m in masks]), F.col("mask") + 1)
    if len({m.span for m in masks}) > 1:
        every = every.where(F.col("at") + span <= F.size(tokens))
    return every.withColumn("seed", _seed_hash(F.col(tokens), F.col("at"), F.col("mask"), masks)).withColumn("span", span)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and a benchmark item that it repeats: doc_id, digest, item_id, matched, n_seeds, first_token, end_token.

    A pair is reported if somewhere 13 neighbouring tokens of the item stand in the document with at most two of them
    substituted (an item of 7 to 12 tokens: all of them, at most one substituted; of 4 to 6: all of them, unchanged;
    shorter items are never reported).  ``matched`` is
    the most equal tokens of such a stretch, ``digest`` the document text's 64-bit hash, which with doc_id tells rows
    apart that repeat an id.  Null and empty texts on either side match nothing; an empty table on either side gives no
    rows; item ids may be null or repeat.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), token_hashes(F.col(item_text)).alias("item")).where(F.size("item") >= LEAST_TOKENS)
    items = materialize(items.withColumn("item_key", F.monotonically_increasing_id()), "leak-items")
    sizes = items.select(F.size("item").alias("n"))
    short = sorted(r.n for r in sizes.where(F.col("n") < WINDOW).distinct().collect())  # at most nine lengths
    masks = _masks(short)
    seeds = _seeds(items, "item", masks)
    seeds = seeds.where((F.col("mask") < len(MASKS)) | (F.col("span") == F.size("item")) & (F.col("at") == 0)).select("seed", "item_key", F.col("at").alias("item_at"), "mask", "span")
    blocks = max(1, math.ceil(seeds.count() / BROADCAST_SEEDS))

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest"), token_hashes(text).alias("doc"))
    placed = _seeds(rows, "doc", masks).select("doc_id", "digest", "doc", F.col("at").alias("doc_at"), "seed")
    found = None
    for b in range(blocks):
        mine = F.pmod(F.xxhash64("item_key"), F.lit(blocks)) == b
        part = _verified(placed, seeds.where(mine), items.where(mine))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "digest", "item_key", "item_id").agg(
        F.max("matched").alias("matched"), F.count("*").alias("n_seeds"), F.min("doc_at").alias("first_token"), F.max("end").alias("end_token")
    ).drop("item_key")


def _verified(placed: DataFrame, seeds: DataFrame, items: DataFrame) -> DataFrame:
    hits = placed.join(F.broadcast(seeds), "seed").join(F.broadcast(items), "item_key")
    m, n, shift = F.size("item"), F.size("doc"), F.col("doc_at") - F.col("item_at")
    width = F.least(F.lit(WINDOW), m)
    need = width - F.floor(_errors(width)).cast("int")
    low = F.greatest(F.lit(0), F.col("item_at") + F.col("span") - width, -shift)
    high = F.least(F.col("item_at"), m - width, n - width - shift)

    def equal(start: Column) -> Column:
        at = F.sequence(start, start + width - 1)
        return F.aggregate(at, F.lit(0), lambda a, t: a + F.when(F.get(F.col("doc"), t + shift) == F.get(F.col("item"), t), 1).otherwise(0))

    matched = F.when(low <= high, F.array_max(F.transform(F.sequence(low, high), equal)))
    hits = hits.withColumn("matched", matched).where(F.col("matched") >= need)
    return hits.select("doc_id", "digest", "item_key", "item_id", "matched", "doc_at", (F.col("doc_at") + F.col("span")).alias("end"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that repeat no benchmark item, with their columns as they are; see ``find_leaks``."""
    leaks = find_leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_leak_id"), F.col("digest").alias("_leak_digest")).distinct()
    leaks = materialize(leaks, "leaks")
    small = leaks.count() <= BROADCAST_SEEDS
    same = docs[f"`{id_col}`"].eqNullSafe(leaks["_leak_id"]) & (F.xxhash64(F.coalesce(docs[f"`{text_col}`"], F.lit(""))) == leaks["_leak_digest"])
    return docs.join(F.broadcast(leaks) if small else leaks, same, "left_anti")
