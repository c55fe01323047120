import itertools
import random
import re

from tidewatch.llm.decontaminate import MASKS, _masks, decontaminate, find_leaks


def tokens(t):
    return [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]


def brute(docs, items):
    out = set()
    for (d, t), (k, u) in itertools.product(docs, items):
        a, b = tokens(t), tokens(u)
        if len(b) < 4:
            continue
        w = min(13, len(b))
        need = w - 2 * w // 13  # 2 of 13, 1 of 7 to 12, none of fewer
        if any(sum(x == y for x, y in zip(a[i : i + w], b[j : j + w])) >= need for i in range(len(a) - w + 1) for j in range(len(b) - w + 1)):
            out.add((d, k))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in find_leaks(d, b).collect()}


def test_masks_meet_every_pair_of_errors():
    for bad in itertools.combinations(range(13), 2):
        assert any(not {o + x for x in m} & set(bad) for m in MASKS for o in range(13 - m[-1]))


def test_masks_of_short_items_meet_every_error():
    for n in range(7, 13):
        masks = [m for m in _masks([n]) if m.size == n]
        assert all(any(bad not in m.offsets for m in masks) for bad in range(n))
    assert [m.offsets for m in _masks([5]) if m.size] == [(0, 1, 2, 3, 4)]


def test_substitutions_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(rng.choices(vocab, k=n))) for k, n in enumerate([30, 13, 12, 9, 8, 7, 4, 3, 0, 40])] + [(20, None), (30, None)]
    docs = []
    for i in range(60):
        src = tokens(items[i % 10][1])
        cut = src[: rng.choice([13, 20, len(src)])] if src else []
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            if cut:
                cut[rng.randrange(len(cut))] = "zz"
        docs.append((i, ", ".join([*rng.choices(vocab, k=rng.randrange(12)), *cut, *rng.choices(vocab, k=rng.randrange(12))])))
    docs += [(100, None), (101, ""), (102, items[0][1].upper()), (None, items[0][1]), (102, items[0][1].upper())]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert len(got) > 15


def test_removal_keeps_clean_rows_and_columns(spark):
    item = " ".join(f"t{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, "a"), (2, "clean words only", "b"), (None, item, "c"), (None, None, "d"), (1, "other", "e")], "doc_id long, text string, item string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    left = decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.item for r in left.collect()) == ["b", "d", "e"]
    assert decontaminate(docs, bench.limit(0)).count() == 5
    assert decontaminate(docs.limit(0), bench).count() == 0


def test_planted_items_on_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    got = run(spark, docs, items)
    text = {k: " ".join(tokens(t)) for k, t in docs}
    exact = {(d, k) for d in text for k, u in items if f" {' '.join(tokens(u))} " in f" {text[d]} "}
    assert exact <= got


def test_clashing_columns_and_long_texts(spark):
    item = " ".join(f"t{i}" for i in range(20))
    names = ["span", "mask", "seed", "at", "_leak_id", "digest", "doc", "item_key"]
    docs = spark.createDataFrame([(1, "x y " * 60_000 + item, *names), (2, "x y " * 60_000, *names)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    left = decontaminate(docs, spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]
    assert decontaminate(docs.limit(0), spark.createDataFrame([(5, item)], "item_id long, text string")).count() == 0
