"""Language identification: averaged hashed subword embeddings, a linear softmax, and calibrated rejection.

A text is the average of the embeddings of its grams of 2, 3 and 4 characters inside words; embeddings and softmax weights are
trained together by stochastic gradient descent in numpy.  A part of the sample that isn't trained on sets the
softmax's temperature, and the score below which a prediction is marked as rejected.  Scoring multiplies embeddings and
weights once, so that a gram costs one row of a table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize
from tidewatch.llm.textkernel import chunks
from tidewatch.llm.training import SAMPLE_CHUNK, gram_keys, held_out, row_sums, scored

SAMPLE_PER_LANG = 800
BROADCAST_LANGS = 100_000
BITS = 16
DIM = 16
GRAMS = (2, 3, 4)
UNKNOWN = "und"
REJECTED_SHARE = 0.01


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return gram_keys(data, offs, GRAMS, BITS)


def _feature_rows(batches):
    for batch in batches:
        for a, b, data, offs in chunks(batch.column("text"), SAMPLE_CHUNK):
            row, key = _grams(data, offs)
            key, count = np.unique((row << BITS) | key, return_counts=True)
            edges = np.searchsorted(key >> BITS, np.arange(b - a + 1))
            cut = lambda x: pa.array([x[i:j].astype(np.int32).tobytes() for i, j in zip(edges[:-1], edges[1:])], pa.binary())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(a, b - a), cut(key & ((1 << BITS) - 1)), cut(count)], ["lang", "keys", "counts"])


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int) -> DataFrame:
    """lang and text of at most ``per_lang`` ids of each language, chosen by their hash, however many languages there are.

    A language's ids are first thinned by a hash threshold to about twice what is asked for, so that ranking them costs
    one task a bounded number of rows, and no more where a language holds most rows.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    ids = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
    sizes = materialize(ids.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")), "lang-sizes")
    few = sizes.count() <= BROADCAST_LANGS
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    near = ids.join(F.broadcast(sizes) if few else sizes, "lang").where(place * F.col("n") <= 2 * per_lang + 100).select("id", "lang").distinct()
    ids = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(place, "id"))).where(F.col("r") <= per_lang).select("id", "lang")
    text = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.lower(F.col(text_col)).alias("text"))
    return text.join(F.broadcast(ids) if few else ids, ["id", "lang"]).select("lang", "text")  # ids: at most per_lang a language


def train(sample: DataFrame, epochs: int = 6, seed: int = 0) -> dict | None:
    rows = sample.mapInArrow(_feature_rows, "lang string, keys binary, counts binary").toArrow()
    lang = rows["lang"].to_pylist()
    keys = [np.frombuffer(k, np.int32) for k in rows["keys"].to_pylist()]
    counts = [np.frombuffer(c, np.int32) for c in rows["counts"].to_pylist()]
    order = sorted((i for i in range(len(lang)) if keys[i].size), key=lambda i: (lang[i], keys[i].size, keys[i].tobytes(), counts[i].tobytes()))
    if not order:
        return None
    names = sorted({lang[i] for i in order})
    y = np.array([names.index(lang[i]) for i in order])
    keys = [keys[i] for i in order]
    share = [counts[i].astype(np.float32) / counts[i].sum() for i in order]
    rng = np.random.default_rng(seed)
    mix = rng.permutation(y.size)
    tune, fit = mix[: y.size // 5], mix[y.size // 5 :] if y.size >= 10 else mix
    emb = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(names)), np.float32)
    n_steps, done = epochs * max(1, fit.size // 16), 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(fit), max(1, fit.size // 16)):
            rate = 2.0 * (1 - done / n_steps) + 0.05
            done += 1
            sizes = [keys[i].size for i in part]
            edges = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            k, x = np.concatenate([keys[i] for i in part]), np.concatenate([share[i] for i in part])
            h = np.add.reduceat(emb[k] * x[:, None], edges, axis=0)
            p = _softmax(h @ out)
            p[np.arange(part.size), y[part]] -= 1
            p /= part.size
            back = p @ out.T
            out -= rate * (h.T @ p)
            np.subtract.at(emb, k, rate * part.size * np.repeat(back, sizes, axis=0) * x[:, None])
    table = emb @ out
    logits = np.stack([(table[k] * s[:, None]).sum(0) for k, s in zip(keys, share)])
    temperature, reject = 1.0, 0.0
    if tune.size:
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 61))
        loss = [-np.log(_softmax(logits[tune] / t)[np.arange(tune.size), y[tune]] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(logits[tune] / temperature)
        right = p.argmax(1) == y[tune]
        reject = float(np.quantile(p.max(1)[right], REJECTED_SHARE)) if right.any() else 0.0
    return {"table": (table / temperature).astype(np.float32), "names": names, "reject": reject}


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _score(model, data, offs, batch):
    n = offs.size - 1
    row, key = _grams(data, offs)
    total = np.maximum(np.bincount(row, minlength=n), 1)
    logits = np.stack([row_sums(row, model["table"][:, c][key], n) / total for c in range(len(model["names"]))], 1)
    p = _softmax(logits)
    best = p.argmax(1)
    return [pa.array([model["names"][b] for b in best], pa.string()), p[np.arange(n), best]]


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs``.

    Learns from text and non-null ``lang_col`` of rows that are not held out: crc32 of the id's text modulo 3 is not 1.
    A null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text if nothing could be
    learned.  Ties go to the language that comes first in order, as do texts that have letters but no gram.  Rows that
    repeat an id are judged one by one, texts of any length whole; an empty table gives no rows; other columns are
    ignored.
    """
    model = train(training_sample(docs, id_col, text_col, lang_col, per_lang))
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.lower(F.coalesce(text, F.lit(""))).alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    lettered = F.struct("held_out", F.expr(r"text rlike '\\p{L}'").alias("letter")).alias("held")
    got = scored(rows.select(F.struct("doc_id", lettered).alias("doc_id"), "held_out", "text"), model, _score, "lang_pred string, score double")
    letter = F.col("doc_id.held.letter")
    score = F.when(letter, F.col("score")).otherwise(0.0)
    return got.select("doc_id.doc_id", "held_out", F.when(letter, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"), score.alias("score"), (~letter | (score < model["reject"])).alias("rejected"))
