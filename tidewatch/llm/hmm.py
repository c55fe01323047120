"""Language-model scoring by a hidden Markov model.

Counts of all training words are exact.  Every word that is seen ``OWN_COUNT`` times has an emission of its own in every
state, however many such words there are; all rarer words share one emission, and are told apart inside it by their
counts, so the model gives every text a probability.

Baum-Welch runs over all training documents, in segments that overlap by one token, so that every transition counts:
each task adds up expected counts over its segments, the sums meet by word, and only the model, which has a row for each
word of its own, reaches the driver.  It starts from states that mean something: each training text leans to one state,
by signs of its words' hashes, so that texts with the same frequent words lean alike, and the pass that counts the words
counts them by state.
Scoring is the scaled forward recursion over whole documents, many documents at a time.

Words are known by a 64-bit hash.  The counts of the commonest ``COUNT_WORDS`` words, and of all with an emission of
their own, are broadcast; those of the rest are joined.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import lower_ascii, materialize
from tidewatch.llm.textkernel import U64, chunks, split_words, word_hashes
from tidewatch.llm.training import held_out

STATES = 8
#: No bound any more; a test sets it.
OWN_WORDS = 1 << 15
#: Words whose counts are broadcast: at most so many, unless more have an emission of their own.
COUNT_WORDS = 1 << 19
#: Rarer words share the common emission, so that it has the weight that words never seen will need.
OWN_COUNT = 4
SEGMENT = 128
SAMPLE_DOCS = 600
ROUNDS = 2
#: The hash that stands for a document's end.
END = 0x1234_5678_9ABC_DEF1
_PRIOR = 20.0
_LARGE = 64
_CHUNK_BYTES = 4 << 20


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' tokens, each row's words followed by one end, and where each row begins."""
    starts, ends, at = split_words(data, offs)
    out = np.full(starts.size + offs.size - 1, END, U64)
    row = np.repeat(np.arange(offs.size - 1), np.diff(at))
    out[np.arange(starts.size) + row] = word_hashes(data, starts, ends)
    return out, at + np.arange(offs.size)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def leanings(tokens: np.ndarray, at: np.ndarray, states: int) -> np.ndarray:
    """A state for each row: of each of the first bits of its words' hashes, whether more of the words have it than not."""
    out = np.zeros(at.size - 1, np.int64)
    for bit in range((states - 1).bit_length()):
        sign = ((tokens >> U64(63 - bit)) & U64(1)).astype(np.int64) * 2 - 1
        out = 2 * out + (np.add.reduceat(np.where(tokens == U64(END), 0, sign), at[:-1]) > 0)
    return out % states


def _count_rows(states: int) -> Callable:
    """Each word and how often it occurs in texts of each leaning."""
    names = ["word", *[f"s{s}" for s in range(states)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in chunks(batch.column("text"), _CHUNK_BYTES):
                tokens, at = _tokens(data, offs)
                word, where = np.unique(tokens, return_inverse=True)
                where = where * states + np.repeat(leanings(tokens, at, states), np.diff(at))
                n = np.bincount(where, minlength=word.size * states).reshape(-1, states)
                yield pa.RecordBatch.from_arrays([_signed(word), *[pa.array(np.ascontiguousarray(n[:, s])) for s in range(states)]], names)

    return run


def _commonest(counts: DataFrame, most: int) -> float:
    """The least count of which at most ``most`` words have that or more, from a histogram of quarter octaves."""
    bucket = F.floor(F.log2("n") * 4).alias("b")
    sizes = {r.b: r["count"] for r in counts.groupBy(bucket).count().collect()}  # at most 252 rows
    total, least = 0, math.inf
    for b in sorted(sizes, reverse=True):
        if (total := total + sizes[b]) > most:
            break
        least = b
    return least


class Lexicon:
    """Broadcast words: sorted hashes, their counts, and the class of those with an emission of their own."""

    def __init__(self, word: np.ndarray, n: np.ndarray, own_from: float, total: int, distinct: int):
        order = np.argsort(word)
        self.word, self.n = word[order], n[order].astype(np.float64)
        own = (np.floor(np.log2(np.maximum(self.n, 1)) * 4) >= own_from) | (self.word == U64(END))
        self.classes = int(own.sum())
        self.cls = np.where(own, np.cumsum(own) - 1, self.classes).astype(np.int32)
        self.total, self.distinct = total, distinct
        self.rest_total = total - int(self.n[own].sum())
        self.rest_distinct = distinct - int((own & (self.n > 0)).sum())
        self.weight = np.append(self.n[own], self.rest_total) + 1.0
        self.weight /= self.weight.sum()

    def look_up(self, tokens: np.ndarray):
        """Class of each token, its count, and whether that count is known here."""
        tokens, back = np.unique(tokens, return_inverse=True)
        at = np.minimum(np.searchsorted(self.word, tokens), self.word.size - 1)
        hit = self.word[at] == tokens
        return np.where(hit, self.cls[at], self.classes)[back], np.where(hit, self.n[at], 0.0)[back], hit[back]


class Model:
    def __init__(self, start, later, move, emit):
        self.start, self.later, self.move, self.emit = start, later, move, emit.astype(np.float32)  # emit: class x state

    @classmethod
    def first(cls, weight: np.ndarray, states: int, seed: int = 0) -> Model:
        rng = np.random.default_rng(seed)
        emit = weight[:, None] * rng.uniform(0.2, 1.8, (weight.size, states))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        even = np.full(states, 1 / states)
        return cls(even, even.copy(), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    @classmethod
    def leaning(cls, own: np.ndarray, all_: np.ndarray, weight: np.ndarray) -> Model:
        """The start: own: how often each class's word occurs in texts that lean to each state; all_: the same of all words."""
        first = cls.first(weight, all_.size)
        return first.from_counts(all_, all_, first.move * all_.sum(), np.concatenate([own, (all_ - own.sum(0))[None]]), weight)

    def from_counts(self, start, later, move, emit, weight) -> Model:
        norm = lambda x, axis=None: x / x.sum(axis=axis, keepdims=axis is not None)
        return Model(norm(start + 0.1), norm(later + 0.1), norm(move + 0.01, 1), norm(emit + _PRIOR * weight[:, None], 0))


def _segments(cls: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and whether it opens a document, of every segment, longest first.

    A segment has ``SEGMENT`` tokens of its own and, unless a document ends there, the first of the next one.
    """
    size = np.diff(at)
    n = -(-size // SEGMENT)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(at[:-1], n) + k * SEGMENT
    length = np.minimum(SEGMENT + 1, np.repeat(at[1:], n) - begin)
    order = np.argsort(-length, kind="stable")
    return begin[order], length[order], (k == 0)[order]


def expected_counts(model: Model, cls: np.ndarray, at: np.ndarray, sums) -> None:
    """Adds the expected counts of one chunk's segments to ``sums`` (start, later, move, emit, log-likelihood)."""
    start, later, move, emit, loglik = sums
    begin, length, opens = _segments(cls, at)
    states = model.start.size
    for i in range(0, begin.size, 2048):
        b, n, o = begin[i : i + 2048], length[i : i + 2048], opens[i : i + 2048]
        steps, many = int(n[0]), np.searchsorted(-n, -np.arange(int(n[0])), "left")  # active segments at each step
        alpha = np.zeros((steps, b.size, states))
        scale = np.ones((steps, b.size))
        word = np.zeros((steps, b.size), np.int64)
        for t in range(steps):
            m = many[t]
            word[t, :m] = cls[b[:m] + t]
            prior = np.where(o[:m, None], model.start, model.later) if t == 0 else alpha[t - 1, :m] @ model.move
            a = prior * model.emit[word[t, :m]]
            scale[t, :m] = a.sum(1)
            alpha[t, :m] = a / scale[t, :m, None]
        loglik += np.log(scale).sum()
        beta = np.ones((b.size, states))
        for t in range(steps - 1, -1, -1):
            m = many[t]
            gamma = alpha[t, :m] * beta[:m]
            np.divide(gamma, gamma.sum(1, keepdims=True), out=gamma)
            if t == 0:
                start += gamma[o[:m]].sum(0)
                later += gamma[~o[:m]].sum(0)
            else:
                seen = model.emit[word[t, :m]] * beta[:m] / scale[t, :m, None]
                move += model.move * (alpha[t - 1, :m].T @ seen)
                beta[:m] = seen @ model.move.T
            alpha[t, :m] = gamma
        valid = np.arange(b.size)[None, :] < many[:SEGMENT, None]  # what is the next segment's own is left to it
        alpha, word = alpha[:SEGMENT], word[:SEGMENT]
        flat, alpha = word[valid], alpha[valid]
        used, at_used = np.unique(flat, return_inverse=True)
        for s in range(states):
            emit[used, s] += np.bincount(at_used, weights=alpha[:, s], minlength=used.size)


def _empty_sums(classes: int, states: int):
    return np.zeros(states), np.zeros(states), np.zeros((states, states)), np.zeros((classes, states)), np.zeros(1)


def _round_rows(shared, states: int) -> Callable:
    """One task's expected counts, a row a class; rows below zero hold the start, later and move counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, model = shared.value
        sums = _empty_sums(lexicon.classes + 1, states)
        for batch in batches:
            for _, _, data, offs in chunks(batch.column("text"), _CHUNK_BYTES):
                tokens, at = _tokens(data, offs)
                expected_counts(model, lexicon.look_up(tokens)[0], at, sums)
        start, later, move, emit, loglik = sums
        used = np.flatnonzero(emit.sum(1) > 0)
        key = np.concatenate([np.arange(-3 - states, 0), used])
        extra = np.zeros((1, states))
        extra[0, 0] = loglik[0]
        rows = np.concatenate([move, start[None], later[None], extra, emit[used]])
        floats = rows.astype(np.float32)
        large = np.flatnonzero(np.abs(rows).max(1) > _LARGE)  # what a float leaves of a large sum is a row more
        key, floats = np.append(key, key[large]), np.concatenate([floats, (rows[large] - floats[large]).astype(np.float32)])
        yield pa.RecordBatch.from_arrays([pa.array(key), *[pa.array(np.ascontiguousarray(floats[:, s])) for s in range(states)]], ["cls", *[f"s{s}" for s in range(states)]])

    return run


def baum_welch_round(train: DataFrame, lexicon: Lexicon, model: Model) -> tuple[Model, float]:
    """The next model and the log-likelihood (natural) of all segments under this one."""
    states = model.start.size
    shared = train.sparkSession.sparkContext.broadcast((lexicon, model))
    names = [f"s{s}" for s in range(states)]
    rows = train.mapInArrow(_round_rows(shared, states), "cls long, " + ", ".join(f"{c} float" for c in names))
    got = rows.groupBy("cls").agg(*[F.sum(c).alias(c) for c in names]).toArrow()  # a row for each class
    table = np.zeros((lexicon.classes + 4 + states, states))
    table[got["cls"].to_numpy() + 3 + states] = np.stack([got[c].to_numpy() for c in names], 1)
    move, start, later, extra, emit = table[:states], table[states], table[states + 1], table[states + 2], table[states + 3 :]
    return model.from_counts(start, later, move, emit, lexicon.weight), float(extra.sum())


def forward(model: Model, cls: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each whole row: the scaled forward recursion, rows side by side, longest first."""
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    begin, n = at[:-1][order], size[order]
    out = np.zeros(order.size)
    if not order.size:
        return out
    many = np.searchsorted(-n, -np.arange(int(n[0])), "left")
    alpha = np.tile(model.start, (order.size, 1))
    for t, m in enumerate(many.tolist()):
        a = alpha[:m] if t == 0 else alpha[:m] @ model.move
        a = a * model.emit[cls[begin[:m] + t]]
        scale = a.sum(1)
        alpha = a / scale[:, None]
        out[:m] += np.log(scale)
    back = np.empty_like(out)
    back[order] = out
    return back


def _score_rows(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, model = shared.value
        base = math.log10(lexicon.total + lexicon.distinct + 1)
        rest = math.log10(lexicon.rest_total + lexicon.rest_distinct + 1)
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b, data, offs in chunks(batch.column("text"), _CHUNK_BYTES):
                tokens, at = _tokens(data, offs)
                cls, n, hit = lexicon.look_up(tokens)
                lead = at[:-1]
                total = lambda x: np.add.reduceat(x, lead)  # noqa: E731, B023
                logs = np.log10(n + 1)
                other = cls == lexicon.classes
                score = forward(model, cls, at) / math.log(10) + total(np.where(other, logs - rest, 0.0))
                row = np.repeat(np.arange(b - a), np.diff(at))
                unknown = np.stack([row[~hit].astype(U64), tokens[~hit]], 1)
                pair, tf = np.unique(unknown, axis=0, return_counts=True) if unknown.size else (unknown, np.zeros(0, np.int64))
                edges = np.searchsorted(pair[:, 0].astype(np.int64), np.arange(b - a + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(edges), x) for x in (_signed(np.ascontiguousarray(pair[:, 1])), pa.array(tf.astype(np.int64)))]
                part = batch.slice(a, b - a)
                cols = [pa.array(key + np.arange(b - a)), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(at)), pa.array(total((n > 0).astype(np.int64))), pa.array(total(logs - base)), pa.array(score), *lists]
                key += b - a
                yield pa.RecordBatch.from_arrays(cols, ["key", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "words", "tfs"])

    return run


def _release(df: DataFrame) -> None:
    """Lets Spark delete the shuffle files of queries that are done: it does so when their plans are collected."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def sample(train: DataFrame) -> DataFrame:
    """``SAMPLE_DOCS`` distinct texts, chosen by their hash before any text is moved; whole, however long.  ``fit`` takes none."""
    texts = train.select(F.xxhash64("text").alias("h"), "text")
    chosen = texts.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS)
    return texts.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("text").alias("text")).orderBy("h").select("text")


def fit(train: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[Lexicon, Model, DataFrame, list[float]]:
    """Lexicon, model, the counts of words that are not broadcast, and the log-likelihood before each full round.

    train: one column ``text``, lower-cased, no nulls.
    """
    names = [f"s{s}" for s in range(states)]
    counts = train.mapInArrow(_count_rows(states), "word long, " + ", ".join(f"{c} long" for c in names))
    counts = counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in names])
    counts = materialize(counts.select("word", sum(map(F.col, names)).alias("n"), *names), "word-counts")
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), *[F.sum(c).alias(c) for c in names]).first()
    own = 4 * math.log2(OWN_COUNT)
    known = min(_commonest(counts, COUNT_WORDS), own)
    bucket = F.floor(F.log2("n") * 4)
    end = F.col("word") == F.lit(END)
    head = counts.where((bucket >= known) | end)
    got = head.select("word", "n").toArrow()
    word, n = got["word"].to_numpy().view(U64), got["n"].to_numpy()
    if END not in word:
        word, n = np.append(word, U64(END)), np.append(n, 0)
    lexicon = Lexicon(word, n, own, int(whole.n or 0), int(whole.v))
    rest = counts.select("word", "n").where(~((bucket >= known) | end))

    lean = counts.where((bucket >= own) | end).select("word", *[F.col(c).cast("float") for c in names]).toArrow()
    by_state = np.zeros((lexicon.classes + 1, states))
    by_state[lexicon.look_up(lean["word"].to_numpy().view(U64))[0]] = np.stack([lean[c].to_numpy() for c in names], 1)
    model = Model.leaning(by_state[:-1], np.array([float(whole[c] or 0) for c in names]), lexicon.weight)
    gains = []
    for _ in range(rounds):
        model, loglik = baum_welch_round(train, lexicon, model)
        gains.append(loglik)
        _release(train)
    return lexicon, model, rest, gains


def score_lm(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Tokens are the lower-cased (A-Z) words of a text and one end.  Learns from rows that are not held out: crc32 of the
    id's text modulo 7 is not 2; null ids are learned from.  base_score: add-one unigram log10 probability, with one
    type for all words never seen; score: the model's log10 probability of the whole text; n_known: tokens seen in
    training.  A null text counts as empty and has one token, its end.  Rows that repeat an id are scored one by one.
    """
    text = lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(F.col(f"`{id_col}`"), 7, 2).alias("held_out"), text.alias("text"))
    lexicon, model, rest, _ = fit(rows.where("not held_out").select("text"), states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, model))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_score_rows(shared), f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, words array<long>, tfs array<long>")
    scored = materialize(scored, "lm-scores")
    pairs = scored.select("key", F.explode(F.arrays_zip("words", "tfs")).alias("x")).select("key", F.col("x.words").alias("word"), F.col("x.tfs").alias("tf"))
    found = pairs.join(rest, "word").groupBy("key").agg(F.sum("tf").alias("more"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("gain"))
    out = scored.drop("words", "tfs").join(found, "key", "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + gain).alias("base_score"), (F.col("score") + gain).alias("score"),
    )
