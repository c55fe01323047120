import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import hmm
from tidewatch.llm.hmm import Lexicon, Model, expected_counts, fit, forward, score_lm


def tokens(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w] + [None]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def brute(rows):
    c = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = {}
    for d, t in rows:
        w = tokens(t)
        out[d] = (held(d), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    return out


@pytest.mark.parametrize("few", [False, True])
def test_base_score_and_gain(spark, monkeypatch, few):
    if few:  # most words take the join
        monkeypatch.setattr(hmm, "COUNT_WORDS", 200)
        monkeypatch.setattr(hmm, "OWN_WORDS", 50)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(9001, None), (9002, ""), (9003, "Unseenword zzz " * 3), (None, "of the")]
    docs = spark.createDataFrame([(d, t, 0.0) for d, t in rows], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in score_lm(docs).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for d, (h, n, known, total, base) in want.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score <= 0
    if not few:
        mine = [r for r in got.values() if r.held_out]
        assert sum(r.score for r in mine) > sum(r.base_score for r in mine)


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(0)
    p = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(s))
    model = Model(p(3), p(3), p(3, 3), p(3, 4).T)
    cls, at = np.array([0, 3, 1, 2, 2, 1, 0]), np.array([0, 5, 6, 7])
    got = forward(model, cls, at)
    for k in range(3):
        seq = cls[at[k] : at[k + 1]]
        total = sum(model.start[z[0]] * np.prod([model.emit[o, s] for o, s in zip(seq, z)]) * np.prod([model.move[a, b] for a, b in zip(z, z[1:])]) for z in itertools.product(range(3), repeat=len(seq)))
        assert got[k] == pytest.approx(math.log(total))


def test_probabilities_of_texts_add_up():
    """Over all sequences of one length, class by class, the forward probabilities sum to one."""
    lexicon = Lexicon(np.array([5, 9, hmm.END], np.uint64), np.array([7, 3, 2]), 0, 12, 3)
    model = Model.first(lexicon.weight, 4)
    every = np.array(list(itertools.product(range(lexicon.classes + 1), repeat=3)))
    logs = forward(model, every.ravel(), np.arange(0, every.size + 1, 3))
    assert np.exp(logs).sum() == pytest.approx(1)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(1)
    cls = np.concatenate([rng.integers(0, 5, 300), rng.integers(5, 10, 300)])
    at = np.array([0, 150, 300, 450, 600])
    weight = np.full(10, 0.1)
    model, last = Model.first(weight, 2), -math.inf
    for _ in range(8):
        sums = hmm._empty_sums(10, 2)
        expected_counts(model, cls, at, sums)
        assert sums[3].sum() == pytest.approx(600)
        assert sums[4][0] >= last - 1.0
        last = sums[4][0]
        model = model.from_counts(*sums[:4], weight)
    assert last > 600 * math.log(0.1)


def test_partitions_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("lower(text) as text")
    one, two = fit(docs.coalesce(1), rounds=2), fit(docs.repartition(6), rounds=2)
    assert one[3] == pytest.approx(two[3], rel=1e-9)
    assert one[3][1] > one[3][0]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert score_lm(docs).count() == 0
    only = spark.createDataFrame([(next(d for d in range(50) if held(d)), "a b")], "doc_id long, text string")
    r = score_lm(only).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0)


def test_every_word_seen_often_enough_has_an_emission(spark):
    words = [f"w{i}" for i in range(40_000)]  # more than the former cap
    docs = spark.createDataFrame([(" ".join(words[i : i + 1000] * 4),) for i in range(0, 40_000, 1000)] + [("rare rare rare",)], "text string")
    lexicon, model, _, _ = fit(docs, rounds=1)
    assert lexicon.classes == 40_001  # and the end
    assert model.emit.shape == (40_002, hmm.STATES)
    assert lexicon.rest_total == 3


def test_sample_has_distinct_texts(spark, monkeypatch):
    monkeypatch.setattr(hmm, "SAMPLE_DOCS", 5)
    docs = spark.createDataFrame([(t,) for t in "abcdefgh" for _ in range(20)], "text string")
    assert len({r.text for r in hmm.sample(docs).collect()}) == hmm.sample(docs).count() == 5


def test_the_start_counts_all_texts(spark):
    """Without a round over all texts, every word of its own has the counts of all texts that it occurs in, by their leaning."""
    texts = [f"the own{i} own{i} own{i} own{i} of and a{i % 7}" for i in range(2000)]
    lexicon, model, _, gains = fit(spark.createDataFrame([(t,) for t in texts], "text string"), rounds=0)
    assert gains == []
    by_word, total = Counter(), np.zeros(hmm.STATES)
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        words, at = hmm._tokens(data, np.array([0, data.size]))
        lean = int(hmm.leanings(words, at, hmm.STATES)[0])
        total[lean] += words.size
        for w in words.tolist():
            by_word[w, lean] += 1
    want = np.array([[by_word[w, s] for s in range(hmm.STATES)] for w in lexicon.word.tolist()])[lexicon.cls < lexicon.classes]
    assert lexicon.classes > 2000
    want = np.concatenate([want, (total - want.sum(0))[None]]) + hmm._PRIOR * lexicon.weight[:, None]
    assert model.emit == pytest.approx(want / want.sum(0), rel=1e-5)
    assert (total > 0).sum() > 1
