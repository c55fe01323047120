import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tidewatch.llm import lexical_search
from tidewatch.llm.common import LOWER, UPPER
from tidewatch.llm.lexical_search import _heads, search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


def by_hand(items, docs, top):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 50 + 50 * sum(b.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 20 * m)) for t in set(terms(text)) if t in b)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return Counter(out)


def check(spark, items, docs, top):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    assert Counter(map(tuple, search(i, d, top=top).collect())) == by_hand(items, docs, top)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["é日本", "İx", "Żółw", "a", "2024"]
    weights = [1 / (k + 1) for k in range(len(words))]
    text = lambda most: "".join(w.upper() + rng.choice([" ", "\n", "--", "_"]) if rng.random() < 0.2 else w + " " for w in rng.choices(words, weights, k=rng.randrange(0, most)))
    docs = [(k, text(40)) for k in range(n)]
    docs += [(1000 + k, docs[3][1]) for k in range(40)] + [(5, docs[9][1]), (None, docs[9][1]), (2000, None), (2001, ""), (2002, " .,!"), (2003, "w1 " * 5000)]
    items = [(k, text(25)) for k in range(25)] + [(25, docs[3][1]), (26, None), (27, "---"), (28, "nowhere found"), (3, "w1 w2 w3"), (None, "w5")]
    return items, docs


@pytest.mark.parametrize("top", [1, 7, 50])
def test_against_the_definition(spark, top):
    check(spark, *corpus(top, 300), top)


def test_blocks_of_items_and_parts_of_lists(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 150)
    monkeypatch.setattr(lexical_search, "SMALL_TABLE", 0)
    monkeypatch.setattr(lexical_search, "LIST_ROWS", 20)
    check(spark, *corpus(4, 200), 10)


def test_heads_across_batches():
    term, points = [1] * 7 + [2] * 2 + [3] * 5, list(range(14))
    batches = [pa.record_batch({"term": pa.array(term[a:b]), "points": pa.array(points[a:b])}) for a, b in ((0, 2), (2, 5), (5, 9), (9, 9), (9, 14))]
    got = [p for b in _heads(3)(iter(batches)) for p in b.column("points").to_pylist()]
    assert got == [0, 1, 2, 7, 8, 9, 10, 11]


def test_edges(spark):
    docs = spark.createDataFrame([(1, "alpha beta", 5, "x"), (2, "gamma delta", 6, "y"), (3, "epsilon", 7, "z")], "doc_id long, text string, uid int, terms string")
    items = spark.createDataFrame([(1, "Alpha!", 9)], "item_id long, text string, points int")
    assert [(r.item_id, r.rank, r.doc_id) for r in search(items, docs).collect()] == [(1, 1, 1)]
    assert search(items.limit(0), docs).count() == 0 and search(items, docs.limit(0)).count() == 0
    assert search(items, spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string")).count() == 0
