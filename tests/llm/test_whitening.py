import math
import random

import numpy as np
import pytest

from tidewatch.llm import whitening
from tidewatch.llm.whitening import whiten

SHAPE = "vec_id long, embedding array<float>"


def by_hand(rows, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[x - s / n for x, s in zip(r, sums)] for r in fit])
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, x in kept:
        z = (np.array([a - s / n for a, s in zip(x, sums)]) @ vectors) / np.sqrt(values)
        out.setdefault(i, []).append((n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), z, values / np.trace(v)))
    return out


def check(spark, rows, components=4):
    want = by_hand(rows, components)
    got = whiten(spark.createDataFrame(rows, SHAPE).repartition(5), components=components).collect()
    assert len(got) == sum(len(x) for x in want.values()) * min(components, len(rows[0][1]))
    signs = {}
    for r in got:
        hits = [x for x in want[r.vec_id] if x[1] == int(r.deviation)]
        n, _, z, explained = hits[0]
        assert r.n == n and r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(z[r.component - 1]), rel=1e-7, abs=1e-9)
        if abs(r.whitened) > 1e-3:
            signs.setdefault(r.component, set()).add(r.whitened * z[r.component - 1] > 0)
        assert 0 <= r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_against_the_definition(spark):
    rng = np.random.default_rng(1)
    mixed = rng.normal(size=(6, 6))
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6) @ mixed]) for i in range(300)]
    rows += [(900 + i, rows[0][1]) for i in range(100)] + [(5, rows[7][1]), (1001, [-0.0] * 6), (1002, [0.0] * 6)]
    bad = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, [1.0] * 5 + [-float("inf")])]
    check(spark, rows + bad)
    check(spark, rows, 9)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    check(spark, rows)


def test_large_entries_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-(2**24), 2**24)) * 2.0 ** rng.choice([0, 12]), float(rng.randrange(100))]) for i in range(50)]
    got = {(r.vec_id, r.component): int(r.deviation) for r in whiten(spark.createDataFrame(rows, SHAPE)).collect()}
    want = by_hand(rows)
    assert got == {(i, c): want[i][0][1] for i, _ in rows for c in (1, 2)}
    assert max(got.values()) > 2**63
    x = whitening._whole(spark.createDataFrame([(1, [1e300, -1e300])], "a int, v array<double>").toArrow()["v"].combine_chunks())
    assert x.tolist() == [[2**63 - 1, -(2**63)]]


def test_edges(spark):
    shape = "vec_id long, embedding array<float>, n int, v string, `a.b` int"
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0], 3, "x", 4), (None, [1.0, 2.0], 3, "x", 4)], shape)).collect()
    assert len(one) == 4 and {(r.n, r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in one} == {(1, None, None, None, 0)}
    assert whiten(spark.createDataFrame([], SHAPE)).count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, [None])], SHAPE)).count() == 0
    assert whiten(spark.createDataFrame([(1, []), (2, [])], SHAPE)).count() == 0
    # one direction has variance, the other none
    line = whiten(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], SHAPE)).collect()
    assert {r.whitened is None for r in line if r.component == 2} == {True} and all(r.whitened is not None and r.identity_error < 1e-9 for r in line if r.component == 1)
    with pytest.raises(Exception, match="one length"):
        whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SHAPE)).collect()
