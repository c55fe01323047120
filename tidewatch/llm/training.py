"""What the trained classifiers share: splits, bounded samples of labelled rows, hashed character grams, scoring by columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_bucket, small_batches
from tidewatch.llm.textkernel import U64, chunks, code_points

_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 18
#: Texts of a training sample are taken in chunks of so many bytes, as all of their grams count.
SAMPLE_CHUNK = 1 << 18


def held_out(doc_id: Column, modulus: int = 3, remainder: int = 1) -> Column:
    """Whether a row is kept from learning; a null id is not."""
    return F.coalesce(id_bucket(doc_id, modulus) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """id, y, text, more of at most ``per_class`` labelled ids of each class, none of them held out, chosen by their hash.

    Ids whose labels disagree, and labels other than 0 and 1, are left out.  Texts are whole, however long.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z").select("id", "y")
    pick = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class)
    ids = pick(0).unionByName(pick(1))  # at most 2 * per_class rows
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)
    return rows.join(F.broadcast(ids), "id").select("id", "y", "text", *more)


def byte_groups(*sets: str) -> list[list[int]]:
    return [list(s.encode("latin-1")) for s in sets]


def _gram_values(code: np.ndarray, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """A 64-bit value of the gram of each size that begins at each place, built from those of smaller sizes."""
    half = lambda n: 1 << (n - 1).bit_length() - 1  # noqa: E731  the largest power of two below n
    needed = set(sizes)
    for n in range(max(sizes), 1, -1):
        if n in needed:
            needed |= {half(n), n - half(n)}
    have = {1: code}
    for n in sorted(needed - {1}):
        a, many = half(n), max(code.size - n + 1, 0)
        have[n] = have[a][:many] * U64(pow(_BASE, n - a, 1 << 64)) + have[n - a][a : a + many]
    return {n: have[n] for n in sizes}


def gram_keys(data: np.ndarray, offs: np.ndarray, sizes: tuple[int, ...], bits: int, inner: int = 0, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every gram of ``sizes`` characters of one row whose characters from ``inner`` on are not white space.

    White space counts as one kind of character, so with ``inner=1`` a gram may begin with the gap before a word.
    ``wanted``: for each bucket whether it is asked for; the others are left out before anything else is done with them.
    Works in blocks, so that a long text costs little more memory than its grams that are wanted.
    """
    code, offs = code_points(data, offs)
    found = []
    for low in range(0, code.size, _BLOCK):
        part = code[low : low + _BLOCK + max(sizes) - 1]
        blank = (part == 32) | ((part >= 9) & (part <= 13))
        gaps = np.concatenate([[0], np.cumsum(blank, dtype=np.int32)])
        for n, value in _gram_values(np.where(blank, 32, part).astype(U64), sizes).items():
            bucket = ((value[:_BLOCK] * U64(_BASE + 2 * n)) >> U64(64 - bits)).astype(np.int32)
            at = np.flatnonzero(wanted[bucket]) if wanted is not None else np.arange(bucket.size)
            at = at[gaps[at + n] == gaps[at + inner]]
            row = np.searchsorted(offs, low + at, "right") - 1
            ok = low + at + n <= offs[row + 1]
            found.append((row[ok], bucket[at[ok]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]).astype(np.int64)


def row_sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


def scored(rows: DataFrame, model, score: Callable, extra: str, keep: tuple[str, ...] = ("doc_id", "held_out")) -> DataFrame:
    """The columns ``keep`` of ``rows`` and what ``score(model, data, offs, batch rows)`` gives for its column ``text``.

    score: returns arrays for one chunk, in the order of ``extra``'s columns.
    """
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [c.split()[0] for c in extra.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in chunks(batch.column("text")):
                part = batch.slice(a, b - a)
                got = score(shared.value, data, offs, part)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *[pa.array(g) for g in got]], [*keep, *names])

    shape = rows.select(*keep).schema
    for c in extra.split(","):
        shape = shape.add(*c.split())
    return rows.mapInArrow(run, shape)


class Adagrad:
    def __init__(self, shape, rate: float):
        self.sum, self.rate = np.full(shape, 1e-8, np.float32), rate

    def step(self, weights: np.ndarray, at, grad: np.ndarray) -> None:
        self.sum[at] += grad * grad
        weights[at] -= self.rate * grad / np.sqrt(self.sum[at])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lengths_to_offsets(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([a.size for a in arrays])])
