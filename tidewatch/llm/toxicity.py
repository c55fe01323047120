"""Toxicity: a linear classifier of character n-grams whose features are scaled by naive Bayes log-count ratios.

A text's features are the hashed grams of 4, 6 and 8 characters (code points) of its words, lower-cased (A-Z), a word's
first with the gap before it.  Each is scaled by the logarithm of the ratio of its smoothed frequencies among toxic and
other training texts; grams that say little either way are left at zero, so that long texts don't gather noise, and are
looked up and left out before a text's grams are made distinct.  A logistic regression on the scaled features is fitted
by Adagrad on at most ``SAMPLE_PER_CLASS`` labelled texts of each class, whole; their counts are added up by bucket
on the executors, and only grams that say something reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize
from tidewatch.llm.textkernel import LOWER_BYTE, chunks, distinct
from tidewatch.llm.training import SAMPLE_CHUNK, Adagrad, gram_keys, held_out, labelled_sample, row_sums, scored, sigmoid

SAMPLE_PER_CLASS = 3_000
BITS = 20
GRAMS = (4, 6, 8)
LEAST_RATIO = 2.0
LEAST_TEXTS = 4
THRESHOLD = 0.7


def _spaced(text):
    return F.concat(F.lit(" "), F.coalesce(text, F.lit("")))


def _features(data: np.ndarray, offs: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of the grams that each row has, each once."""
    row, key = gram_keys(LOWER_BYTE[data], offs, GRAMS, BITS, 1, wanted)
    keys = distinct((row << BITS) | key)
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _count_rows(batches):
    for batch in batches:
        for a, b, data, offs in chunks(batch.column("text"), SAMPLE_CHUNK):
            row, key = _features(data, offs)
            bad = batch.column("y").slice(a, b - a).to_numpy()[row] == 1
            bucket, at = np.unique(key, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.bincount(at[bad], minlength=bucket.size)), pa.array(np.bincount(at[~bad], minlength=bucket.size))], ["bucket", "bad", "good"])


def _feature_rows(shared):
    def run(batches):
        for batch in batches:
            for a, b, data, offs in chunks(batch.column("text"), SAMPLE_CHUNK):
                row, key = _features(data, offs, shared.value)
                edges = np.searchsorted(row, np.arange(b - a + 1))
                keys = pa.array([key[x:y].astype(np.int32).tobytes() for x, y in zip(edges[:-1], edges[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("y").slice(a, b - a), keys], ["y", "keys"])

    return run


def log_ratios(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> np.ndarray:
    """Log of the ratio of smoothed frequencies; zero where it is small or few texts have the gram."""
    ratio = (np.log((bad + 1) / (n_bad + 2)) - np.log((good + 1) / (n_good + 2))).astype(np.float32)
    ratio[(np.abs(ratio) < LEAST_RATIO) | (bad + good < LEAST_TEXTS)] = 0
    return ratio


def train(sample: DataFrame, epochs: int = 12, seed: int = 0) -> dict | None:
    """Weights by bucket and a bias, from rows (y, text); None without rows of both classes."""
    sample = materialize(sample.select(F.col("y").cast("int").alias("y"), _spaced(F.col("text")).alias("text")), "toxicity-sample")
    sizes = sample.agg(F.count("*").alias("n"), F.sum("y").alias("bad")).first()
    if not 0 < (sizes.bad or 0) < sizes.n:
        return None
    counts = sample.mapInArrow(_count_rows, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = counts.where(F.col("bad") + F.col("good") >= LEAST_TEXTS).toArrow()  # a row for each bucket at most
    size = 1 << BITS
    bad, good = np.zeros(size), np.zeros(size)
    bad[counts["bucket"].to_numpy()], good[counts["bucket"].to_numpy()] = counts["bad"].to_numpy(), counts["good"].to_numpy()
    ratio = log_ratios(bad, good, sizes.bad, sizes.n - sizes.bad)
    shared = sample.sparkSession.sparkContext.broadcast(ratio != 0)
    rows = sample.mapInArrow(_feature_rows(shared), "y int, keys binary").toArrow()
    y = rows["y"].to_numpy().astype(np.float32)
    used = [np.frombuffer(k, np.int32) for k in rows["keys"].to_pylist()]
    order = sorted(range(y.size), key=lambda i: (y[i], used[i].size, used[i].tobytes()))  # the order rows arrived in doesn't matter
    y, used = y[order], [used[i] for i in order]
    weights, bias = np.full(size, 0.1, np.float32), np.zeros(1, np.float32)
    step, step_bias = Adagrad(size, 0.05), Adagrad(1, 0.1)
    rng = np.random.default_rng(seed)
    share = np.where(y == 1, y.size / (2 * y.sum()), y.size / (2 * (y.size - y.sum()))).astype(np.float32)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(y.size), max(1, y.size // 32)):
            ids = np.concatenate([used[i] for i in part])
            row = np.repeat(np.arange(part.size), [used[i].size for i in part])
            p = sigmoid(row_sums(row, weights[ids] * ratio[ids], part.size) + bias[0])
            g = ((p - y[part]) * share[part] / part.size).astype(np.float32)
            at, where = np.unique(ids, return_inverse=True)
            step.step(weights, at, row_sums(where, g[row] * ratio[ids], at.size).astype(np.float32) + 1e-5 * weights[at])
            step_bias.step(bias, slice(0, 1), g.sum(keepdims=True))
    return {"weights": (weights * ratio).astype(np.float32), "wanted": ratio != 0, "bias": float(bias[0])}


def _score(model, data, offs, batch):
    row, key = _features(data, offs, model["wanted"])
    return [sigmoid(row_sums(row, model["weights"][key], offs.size - 1) + model["bias"])]


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Learns from ``labels`` (doc_id, toxic) of rows that are not held out: crc32 of the id's text modulo 3 is not 1.
    Null texts score as empty ones: by the bias alone.  Without labels of both classes every score is 0.5.  Rows that
    repeat an id are scored one by one, texts of any length whole; an empty table gives no rows; other columns,
    whatever their names, are ignored.
    """
    model = train(labelled_sample(docs, labels, "toxic", per_class, id_col, text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), _spaced(F.col(text_col)).alias("text"))
    if model is None:
        got = rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        got = scored(rows, model, _score, "score double")
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
