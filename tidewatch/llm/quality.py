"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): low-rank weights for every pair of
features, in time linear in the features that a text has.  Words enter by their frequency, scaled to unit length;
statistics are standardised on the training sample.  Fitted by Adagrad on at most ``SAMPLE_PER_CLASS`` labelled texts
of each class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkernel import U64, chunks, split_words, word_hashes
from tidewatch.llm.training import SAMPLE_CHUNK, Adagrad, byte_groups, held_out, labelled_sample, lengths_to_offsets, row_sums, scored, sigmoid

SAMPLE_PER_CLASS = 3_000
BITS = 16
RANK = 8
THRESHOLD = 0.5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Groups of bytes whose share of a text is a statistic; a byte is in one at most.
_GROUPS = byte_groups(_UPPER, _UPPER.lower(), "0123456789", ".,;:", "!?", "#$%&*@^~_=+<>", "|", "\n", " \t", "\"'()[]{}", "-/\\", "".join(map(chr, range(128, 256))))
_GROUP_OF = np.zeros(256, np.int32)
for _k, _g in enumerate(_GROUPS):
    _GROUP_OF[_g] = _k + 1


_HASH_BITS = 44


def _per_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sorted row << 44 | the upper bits of a hash; rows are fewer than 2**20."""
    return np.sort(rows.astype(U64) << U64(_HASH_BITS) | hashes >> U64(64 - _HASH_BITS))


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    new = np.ones(sorted_.size, bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    return np.flatnonzero(new)


def _statistics(data: np.ndarray, offs: np.ndarray, per: np.ndarray, long: np.ndarray, distinct: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """One row of statistics for each text; per: words, long: lengths of all words, chars: the metadata column n_chars."""
    n = offs.size - 1
    sizes = np.maximum(np.diff(offs), 1)
    kinds = len(_GROUPS) + 1
    group = np.repeat(np.arange(n, dtype=np.int32) * kinds, np.diff(offs))
    group += _GROUP_OF[data]
    shares = np.bincount(group, minlength=n * kinds).reshape(n, kinds)[:, 1:] / sizes[:, None]
    word_row = np.repeat(np.arange(n), per)
    many = np.maximum(per, 1)
    out = [np.bincount(word_row, weights=long, minlength=n) / many, np.bincount(word_row, weights=long > 15, minlength=n) / many, distinct / many]
    line_row, line_hash = _lines(data, offs)
    lines = np.bincount(line_row, minlength=n)
    seen = _per_row(line_row, line_hash)
    seen = np.bincount((seen[_runs(seen)] >> U64(_HASH_BITS)).astype(np.int64), minlength=n)
    out += [seen / np.maximum(lines, 1), np.log1p(lines), np.log1p(per), np.log1p(np.diff(offs)), np.log1p(np.clip(np.nan_to_num(chars), 0, 1e18))]
    return np.concatenate([shares, np.stack(out, 1)], 1).astype(np.float32)


def _lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = data.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    inner = data != 10
    cut = offs[(offs > 0) & (offs < n)]
    before = np.concatenate([[False], inner[:-1]])
    before[cut] = False
    after = np.concatenate([inner[1:], [False]])
    after[cut - 1] = False
    starts, ends = np.flatnonzero(inner & ~before), np.flatnonzero(inner & ~after) + 1
    return np.searchsorted(offs, starts, "right") - 1, word_hashes(data, starts, ends)


def _features(data: np.ndarray, offs: np.ndarray, chars: np.ndarray):
    """Row, bucket and value of word features, in the order of rows, and the statistics."""
    n = offs.size - 1
    starts, ends, at = split_words(data, offs)
    key = _per_row(np.repeat(np.arange(n), np.diff(at)), word_hashes(data, starts, ends))
    distinct = np.bincount((key[_runs(key)] >> U64(_HASH_BITS)).astype(np.int64), minlength=n)
    key >>= U64(_HASH_BITS - BITS)
    lead = _runs(key)
    count, key = np.diff(np.append(lead, key.size)), key[lead].astype(np.int64)
    row, bucket = key >> BITS, key & ((1 << BITS) - 1)
    norm = np.sqrt(row_sums(row, count.astype(np.float64) ** 2, n))
    return row, bucket, (count / np.maximum(norm[row], 1)).astype(np.float32), _statistics(data, offs, np.diff(at), ends - starts, distinct, chars)


def _feature_rows(batches):
    for batch in batches:
        for a, b, data, offs in chunks(batch.column("text"), SAMPLE_CHUNK):
            part = batch.slice(a, b - a)
            row, bucket, value, stats = _features(data, offs, part.column("n_chars").to_numpy())
            edges = np.searchsorted(row, np.arange(b - a + 1))
            cut = lambda x, kind: pa.array([x[i:j].astype(kind).tobytes() for i, j in zip(edges[:-1], edges[1:])], pa.binary())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([part.column("y"), cut(bucket, np.int32), cut(value, np.float32), pa.array([s.tobytes() for s in stats], pa.binary())], ["y", "bucket", "value", "stats"])


def train(sample: DataFrame, epochs: int = 15, seed: int = 0) -> dict | None:
    """The machine's weights from rows (y, text, n_chars); None without rows of both classes."""
    rows = sample.select(F.col("y").cast("int").alias("y"), "text", "n_chars").mapInArrow(_feature_rows, "y int, bucket binary, value binary, stats binary").toArrow()
    y = rows["y"].to_numpy().astype(np.float32)
    if not 0 < y.sum() < y.size:
        return None
    stats = np.stack([np.frombuffer(s, np.float32) for s in rows["stats"].to_pylist()])
    ids = [np.frombuffer(b, np.int32) for b in rows["bucket"].to_pylist()]
    values = [np.frombuffer(v, np.float32) for v in rows["value"].to_pylist()]
    order = np.lexsort((*stats.T, y))  # the order rows arrived in doesn't matter
    y, stats, ids, values = y[order], stats[order], [ids[i] for i in order], [values[i] for i in order]
    mean, scale = stats.mean(0), stats.std(0) + 1e-3
    stats = np.clip((stats - mean) / scale, -6, 6).astype(np.float32)
    size = (1 << BITS) + stats.shape[1]
    dense = np.arange(1 << BITS, size, dtype=np.int32)
    ids = [np.concatenate([i, dense]) for i in ids]
    values = [np.concatenate([v, s]) for v, s in zip(values, stats)]
    rng = np.random.default_rng(seed)
    w0, w, v = np.zeros(1, np.float32), np.zeros(size, np.float32), rng.normal(0, 0.02, (size, RANK)).astype(np.float32)
    steps = Adagrad(1, 0.1), Adagrad(size, 0.05), Adagrad((size, RANK), 0.02)
    share = np.where(y == 1, y.size / (2 * y.sum()), y.size / (2 * (y.size - y.sum()))).astype(np.float32)
    ends = lengths_to_offsets(ids)
    flat, weight = np.concatenate(ids), np.concatenate(values)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(y.size), max(1, y.size // 32)):
            at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in part])
            row = np.repeat(np.arange(part.size), np.diff(ends)[part])
            edges = np.concatenate([[0], np.cumsum(np.diff(ends)[part])])[:-1]
            i, x = flat[at], weight[at]
            vx = v[i] * x[:, None]
            total = np.add.reduceat(vx, edges, axis=0)
            z = w0[0] + np.add.reduceat(w[i] * x, edges) + 0.5 * (total**2 - np.add.reduceat(vx**2, edges, axis=0)).sum(1)
            g = ((sigmoid(z) - y[part]) * share[part] / part.size).astype(np.float32)
            gx = g[row] * x
            grad_v = gx[:, None] * (total[row] - vx)
            spot, where = np.unique(i, return_inverse=True)
            sort = np.argsort(where, kind="stable")
            first = np.searchsorted(where[sort], np.arange(spot.size))
            steps[0].step(w0, slice(0, 1), g.sum(keepdims=True))
            steps[1].step(w, spot, np.add.reduceat(gx[sort], first) + 1e-5 * w[spot])
            steps[2].step(v, spot, np.add.reduceat(grad_v[sort], first, axis=0) + 1e-5 * v[spot])
    return {"w0": float(w0[0]), "w": w, "v": v, "mean": mean, "scale": scale}


def machine(model: dict, row: np.ndarray, bucket: np.ndarray, x: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """The machine's value before the sigmoid, for each row of ``stats``: time linear in the features."""
    n = stats.shape[0]
    stats = np.clip((stats - model["mean"]) / model["scale"], -6, 6)
    w, v = model["w"], model["v"]
    linear = row_sums(row, w[bucket] * x, n) + stats @ w[1 << BITS :]
    pairs = np.zeros(n)
    for f in range(v.shape[1]):
        word = v[bucket, f] * x
        part = stats * v[1 << BITS :, f]
        pairs += (row_sums(row, word, n) + part.sum(1)) ** 2 - row_sums(row, word**2, n) - (part**2).sum(1)
    return model["w0"] + linear + 0.5 * pairs


def _score(model, data, offs, batch):
    return [sigmoid(machine(model, *_features(data, offs, batch.column("n_chars").to_numpy())))]


def _with_chars(docs: DataFrame, text_col: str) -> DataFrame:
    """docs (.., text, n_chars): the metadata column where it is there and not null, else the text's length."""
    chars = F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("double")
    if "n_chars" in docs.columns:
        given = F.col("n_chars").try_cast("double")
        chars = F.coalesce(F.when(~F.isnan(given), given), chars)
    return chars.alias("n_chars")


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``, and its columns are otherwise left out.

    Learns from ``labels`` (doc_id, quality) of rows that are not held out: crc32 of the id's text modulo 3 is not 1.
    Null texts score as empty ones; a null, missing or NaN n_chars is the text's length.  Without labels of both classes
    every score is 0.5.  Rows that repeat an id are scored one by one, texts of any length whole; an empty table gives
    no rows.
    """
    model = fit(docs, labels, id_col, text_col, per_class)
    got = _apply(model, docs, id_col, text_col)
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> dict | None:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), _with_chars(docs, text_col))
    return train(labelled_sample(rows, labels.select(F.col(id_col).alias("id"), "quality"), "quality", per_class, "id", "text", ("n_chars",)))


def _apply(model: dict | None, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(F.col(f"`{id_col}`")).alias("held_out"), F.col(f"`{text_col}`").alias("text"), _with_chars(docs, text_col))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    return scored(rows, model, _score, "score double")


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns as they are; see ``score_quality``.

    Without labels of both classes all rows stay.
    """
    model = fit(docs, labels, id_col, text_col)
    if model is None:
        return docs
    others = F.struct(F.lit(0).alias(""), *[F.col(f"`{c}`") for c in docs.columns if c != text_col])  # a struct needs a field
    rows = docs.select(others.alias("row"), F.col(f"`{text_col}`").alias("text"), _with_chars(docs, text_col))
    kept = scored(rows, model, _score, "score double", ("row", "text")).where(F.col("score") >= threshold)
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
