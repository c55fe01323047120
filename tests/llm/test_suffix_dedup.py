import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import suffix_dedup
from tidewatch.llm.suffix_dedup import cut, dedup_bytes, repeated


def removed(texts, length):
    """By the definition: of each text, which bytes a string covers that starts anywhere else as well."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return raw, out


def check(spark, texts, length, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, dedup_bytes(docs, length=length).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    want = Counter()
    for i, raw, gone in zip(ids, *removed(texts, length)):
        spans = sum(g and not h for g, h in zip(gone, [False, *gone]))
        want[i, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()] += 1
    assert got == want


def corpus(seed, n=60, most=400):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abc é日", k=rng.randrange(10, 120))) for _ in range(8)]
    texts = [None, "", "a" * 300, "ab" * 200, "short", "日本語" * 40]
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abcdefgh ", k=rng.randrange(0, 60))) for _ in range(rng.randrange(1, 6))]
        texts.append("".join(parts)[:most])
    return texts + rng.sample(texts, 10)


@pytest.mark.parametrize("length", [14, 20, 33])
def test_against_the_definition(spark, length):
    check(spark, corpus(length), length)


def test_one_shard_or_many_and_crowded_anchors(spark, monkeypatch):
    texts = corpus(7)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 100)
    check(spark, texts, 20)
    # a common line in many surroundings: its anchors are cut at every string
    rng = random.Random(8)
    monkeypatch.setattr(suffix_dedup, "MOST_BLOCKS", 3)
    around = lambda: "".join(rng.choices("klmnop", k=30))
    check(spark, texts + [around() + "common line" + around() for _ in range(40)] + [around() * 2 + "common line, longer than a string" + around() for _ in range(20)], 20)


def test_table_against_the_definition(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    check(spark, texts, 200)


def test_very_long_text_and_segments(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefghijklmnop ", k=200_000))
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 5_000)
    data = np.frombuffer(long.encode(), np.uint8)
    first, n, _, _ = cut(data, np.array([0, data.size]), 50)
    assert np.array_equal(np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum()), np.arange(data.size - 49))
    check(spark, [long, "x" + long[70_000:70_450] + "y", long[199_900:] * 2], 200)


def test_kernel_against_the_definition():
    rng = random.Random(10)
    for length in (7, 8, 9, 15, 30):
        for _ in range(60):
            letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
            blocks = ["".join(rng.choices(letters, k=rng.randrange(0, 60))).encode() for _ in range(rng.randrange(1, 9))]
            weights = np.array([rng.choice([1, 1, 1, 2]) for _ in blocks])
            seen = Counter()
            for b, w in zip(blocks, weights.tolist()):
                for i in range(len(b) - length + 1):
                    seen[b[i : i + length]] += w
            want = [x for b in blocks for x in [i + length <= len(b) and seen[b[i : i + length]] > 1 for i in range(len(b))] + [False]]
            symbols = np.array([x for b in blocks for x in [*(c + 1 for c in b), 0]], np.int16)
            ends = np.cumsum([len(b) + 1 for b in blocks]) - 1
            assert repeated(symbols, ends, weights, length).tolist() == want


def test_edges(spark):
    text = "the same words over and over again, as long as it takes"
    # null ids, ids that repeat with one text or with two, clashing names
    check(spark, [text, text, "x" + text, "other " + text[:30], None], 20, [None, 1, 1, 2, None])
    docs = spark.createDataFrame([(1, text, "a", 2, "b"), (2, text + "!", "c", 3, "d")], "doc_id long, text string, row string, digest int, `a.b` string")
    rows = dedup_bytes(docs, length=20, with_text=True).orderBy("row.doc_id").collect()
    assert [bytes(r.kept) for r in rows] == [b"", b"!"] and [r.row.row for r in rows] == ["a", "c"] and rows[0].row["a.b"] == "b"
    assert dedup_bytes(docs.limit(0)).count() == 0
    assert dedup_bytes(spark.createDataFrame([(1, None)], "doc_id long, text string")).first().n_bytes == 0
    with pytest.raises(ValueError):
        dedup_bytes(docs, length=10)
