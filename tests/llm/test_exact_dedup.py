import hashlib
import random

import pytest

from tidewatch.llm.exact_dedup import exact_dedup, exact_groups


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sample():
    rng = random.Random(4)
    texts = ["", None, "A", "a", "É", "é", "long " * 30_000, "LONG " * 30_000, "x\n", "x"] + [f"Text {rng.randrange(6)}" for _ in range(60)] + ["hot copy"] * 200
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("keep", ["max", "min"])
def test_groups_against_brute_force(spark, keep):
    rows = sample()
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, norm string").repartition(7)
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    got = {r.doc_id: r for r in exact_groups(docs, keep=keep).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        g = groups[low(t)]
        best = max(g) if keep == "max" else min(g)
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (best, len(g), i == best, hashlib.sha256(low(t).encode()).hexdigest())
    left = exact_dedup(docs, keep=keep)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(max(g) if keep == "max" else min(g) for g in groups.values())


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "A"), (3, "a"), (3, "a"), (None, "alone")], "doc_id long, text string")
    got = exact_groups(docs, keep="max").collect()
    assert sum(r.kept for r in got) == 2
    assert {(r.keep_id, r.group_size) for r in got} == {(3, 4), (None, 1)}
    assert exact_dedup(docs).count() == 2


def test_empty_table_and_wrong_argument(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_groups(docs).count() == 0 and exact_dedup(docs).count() == 0
    with pytest.raises(ValueError):
        exact_groups(docs, keep="any")
