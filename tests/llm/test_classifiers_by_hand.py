"""The classifiers' features and scores computed again in plain Python, from their definitions."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import langid, quality, toxicity
from tidewatch.llm.textkernel import word_hashes
from tidewatch.llm.training import _BASE

TEXTS = ["The quick, brown fox!", "", "日本語 the ÉTÉ naïve\tfoo", "a b c", "zzzzzzzzzz zzzzzzzzzz zzzzzzzzzz", "x" * 50, "Foo foo FOO\nfoo\nfoo", "The quick, brown fox!"]
MASK = (1 << 64) - 1


def bucket(gram, bits):
    value = 0
    for c in gram:
        value = (value * _BASE + ord(c)) & MASK
    return (value * (_BASE + 2 * len(gram)) & MASK) >> 64 - bits


def grams(text, sizes, bits, inner):
    text = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text)
    return [bucket(text[i : i + n], bits) for n in sizes for i in range(len(text) - n + 1) if " " not in text[i + inner : i + n]]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def labelled(spark, texts, labels):
    return spark.createDataFrame([(t, y, 0.0) for t, y in zip(texts, labels)], "text string, y int, n_chars double")




def test_toxicity_by_hand(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_RATIO", 0.3)
    monkeypatch.setattr(toxicity, "LEAST_TEXTS", 2)
    bad = ["you are awful and stupid", "so awful, so stupid 日本語日本語", "stupid awful things"] * 2
    good = ["a lovely day outside", "what a lovely garden 花花花花", "outside it was lovely"] * 2
    model = toxicity.train(labelled(spark, bad + good, [1] * 6 + [0] * 6))
    count = {y: Counter(b for t in texts for b in set(grams(" " + lower(t), (4, 6, 8), toxicity.BITS, 1))) for y, texts in ((1, bad), (0, good))}
    useful = {}
    for b in count[1].keys() | count[0].keys():
        ratio = math.log((count[1][b] + 1) / 8) - math.log((count[0][b] + 1) / 8)
        if abs(ratio) >= 0.3 and count[1][b] + count[0][b] >= 2:
            useful[b] = ratio
    assert set(np.flatnonzero(model["wanted"]).tolist()) == set(useful)
    got = toxicity.log_ratios(np.array([count[1][b] for b in useful]), np.array([count[0][b] for b in useful]), 6, 6)
    assert got.tolist() == pytest.approx(list(useful.values()), rel=1e-5)
    texts = [*bad, *good, *TEXTS]
    data = [(" " + t).encode() for t in texts]
    offs = np.cumsum([0, *map(len, data)])
    scores = toxicity._score(model, np.frombuffer(b"".join(data), np.uint8), offs, None)[0]
    want = [sigmoid(sum(float(model["weights"][b]) for b in set(grams(" " + lower(t), (4, 6, 8), toxicity.BITS, 1))) + model["bias"]) for t in texts]
    assert scores.tolist() == pytest.approx(want, rel=1e-5)
    assert scores[0] > 0.7 > scores[6]


def test_quality_features_and_pairs_by_hand():
    rng = np.random.default_rng(0)
    raw = [t.encode() for t in TEXTS]
    offs = np.cumsum([0, *map(len, raw)])
    data, chars = np.frombuffer(b"".join(raw), np.uint8), np.arange(len(TEXTS)) * 10.0
    row, bucket_, x, stats = quality._features(data, offs, chars)
    size = (1 << quality.BITS) + stats.shape[1]
    model = {"w0": 0.3, "w": rng.normal(size=size), "v": rng.normal(size=(size, 3)), "mean": stats.mean(0), "scale": stats.std(0) + 1e-3}
    got = quality.machine(model, row, bucket_, x, stats)
    for i, t in enumerate(TEXTS):
        words = [w.encode() for w in t.split()]
        hashed = Counter(int(word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) >> 48 for w in words)
        norm = math.sqrt(sum(n * n for n in hashed.values())) or 1
        features = {b: n / norm for b, n in hashed.items()}
        assert {int(b): float(v) for b, v in zip(bucket_[row == i], x[row == i])} == pytest.approx(features)
        n, lines = max(len(raw[i]), 1), [s for s in t.split("\n") if s]
        shares = [sum(b in g for b in raw[i]) / n for g in quality._GROUPS]
        rest = [sum(map(len, words)) / max(len(words), 1), sum(len(w) > 15 for w in words) / max(len(words), 1), len(set(words)) / max(len(words), 1), len(set(lines)) / max(len(lines), 1)]
        rest += [math.log1p(v) for v in (len(lines), len(words), len(raw[i]), chars[i])]
        assert stats[i].tolist() == pytest.approx(shares + rest, rel=1e-5)
        dense = np.clip((stats[i] - model["mean"]) / model["scale"], -6, 6)
        features |= {(1 << quality.BITS) + k: float(v) for k, v in enumerate(dense)}
        items = list(features.items())
        z = model["w0"] + sum(model["w"][b] * v for b, v in items)
        z += sum(float(model["v"][a] @ model["v"][b]) * u * v for k, (a, u) in enumerate(items) for b, v in items[:k])
        assert got[i] == pytest.approx(z, rel=1e-4, abs=1e-4)


def test_quality_learns_the_column_it_scores(spark):
    """Only n_chars tells the classes apart."""
    docs = spark.createDataFrame([(d, "same words in every text", float(10 if d % 2 else 10_000)) for d in range(200)], "doc_id long, text string, n_chars double")
    labels = spark.createDataFrame([(d, d % 2) for d in range(200)], "doc_id long, quality int")
    got = quality.score_quality(docs, labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    odd = docs.selectExpr("doc_id", "text", "case when doc_id = 5 then double('NaN') when doc_id = 6 then double('Infinity') else n_chars end as n_chars")
    assert all(0 <= r.score <= 1 for r in quality.score_quality(odd, labels).collect())


def test_language_by_hand():
    rng = np.random.default_rng(1)
    model = {"table": rng.normal(size=(1 << langid.BITS, 3)).astype(np.float32), "names": ["aa", "bb", "cc"], "reject": 0.5}
    raw = [t.encode() for t in TEXTS]
    names, scores = langid._score(model, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), None)
    for t, name, score in zip(TEXTS, names.to_pylist(), scores):
        keys = grams(t, (2, 3, 4), langid.BITS, 0)
        z = model["table"][keys].sum(0) / max(len(keys), 1) if keys else np.zeros(3)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert name == model["names"][int(p.argmax())]
        assert score == pytest.approx(float(p.max()), rel=1e-4)


def test_long_texts_are_learned_from_and_every_language_too(spark):
    rows = [(d, ("wort " if d % 2 else "mot ") * (40_000 if d < 8 else 20), "de" if d % 2 else "fr") for d in range(60)]
    rows += [(1000 + k, f"{chr(0x4E00 + 7 * k)}{chr(0x4E01 + 7 * k)} " * 8, f"l{k // 6}") for k in range(0, 450 * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_sample(docs, "doc_id", "text", "lang", 10).groupBy("lang").count().collect()
    learned = {lang for d, _, lang in rows if zlib.crc32(str(d).encode()) % 3 != 1}
    assert {r.lang for r in sample} == learned and len(learned) > 400
    assert max(r["count"] for r in sample) <= 10
    labels = spark.createDataFrame([(d, d % 2) for d in range(8)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs.where("doc_id < 60"), labels).collect()}
    assert len(got) == 60
