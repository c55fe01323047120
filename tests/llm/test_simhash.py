import random
import re

import numpy as np
import pytest
import xxhash

from tidewatch.llm import simhash
from tidewatch.llm.components import least_reachable
from tidewatch.llm.shingles import _sets, may_be_alike, parity_maps, set_fingerprints
from tidewatch.llm.simhash import NEAR, Scheme, bits_for_similarity, near_dedup, near_groups, near_links, similar_groups


def mark(text, k=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower) if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def closure(items, bits):
    """items: (id, mark) -> smallest id reached"""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    f = np.array([m for _, m in items], np.uint64)
    for i in range(len(items)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= bits):
            root[find(i)] = find(i + 1 + int(j))
    best = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return [best.get(find(i)) for i in range(len(items))]


def test_documents_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += [(5000, None), (5001, " "), (5002, "One"), (None, "one"), (5004, "one two"), (5004, "ONE TWO"), (5005, "é x 😀 " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.id, r.f0 % (1 << 64)): r.component_id for r in near_groups(docs).collect()}
    marks = [(d, mark(t)) for d, t in rows]
    assert got == dict(zip(marks, closure(marks, 3)))


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("words,bits,blocks", [(1, 3, 4), (2, 19, 8)])
def test_links_of_clusters_against_brute_force(spark, monkeypatch, small, words, bits, blocks):
    if small:  # every node pair is split again and again
        monkeypatch.setattr(simhash, "NODE_ROWS", 8)
    rng = random.Random(5)
    size = 64 * words
    marks = set()
    for _ in range(40):
        c = rng.getrandbits(size)
        for _ in range(rng.choice([1, 2, 12])):
            m = c
            for b in rng.sample(range(size), rng.randrange(bits + 1)):
                m ^= 1 << b
            marks.add(m)
    marks = sorted(marks)
    split = lambda m: [int(np.uint64(m >> 64 * w & (1 << 64) - 1).astype(np.int64)) for w in range(words)]
    nodes = spark.createDataFrame([(i, *split(m)) for i, m in enumerate(marks)], "node long, " + ", ".join(f"f{w} long" for w in range(words)))
    found = least_reachable(near_links(nodes, Scheme(words, size // blocks, ((size // blocks, bits // blocks), (size, bits))))).collect()
    root = {r.node: r.root for r in found}
    want = {}
    find = list(range(len(marks)))
    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                a, b = find[i], find[j]
                if a != b:
                    find = [min(a, b) if x in (a, b) else x for x in find]
    want = dict(enumerate(find))
    assert {i: root.get(i, i) for i in want} == want


@pytest.mark.parametrize("step", [8, 12])  # 12: a step straddles the end of the front block
def test_links_of_one_block_that_is_split_deeper(spark, monkeypatch, step):
    monkeypatch.setattr(simhash, "NODE_ROWS", 8)
    monkeypatch.setattr(simhash, "STEP_BITS", step)
    rng = random.Random(2)
    marks = []
    for _ in range(300):  # pairs that agree in the first block and have one error in each of the others
        m = 0xBEEF << 48 | rng.getrandbits(48)
        marks += [m, m ^ 1 << rng.randrange(16) ^ 1 << rng.randrange(16, 32) ^ 1 << rng.randrange(32, 48)]
    assert len(set(marks)) == 600 > 4 * simhash.NODE_ROWS
    nodes = spark.createDataFrame([(i, int(np.uint64(m).astype(np.int64))) for i, m in enumerate(marks)], "node long, f0 long")
    got = {r.node: r.root for r in least_reachable(near_links(nodes)).collect()}
    assert [got.get(i, i) for i in range(600)] == closure([(i, m) for i, m in enumerate(marks)], 3)


def test_near_dedup(spark):
    rng = random.Random(1)
    base = [rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(300)]
    near = base[:150] + ["changed"] + base[151:]
    other = [f"q{rng.randrange(900)}" for _ in range(300)]
    docs = spark.createDataFrame([(7, " ".join(base), 1), (3, " ".join(near), 2), (9, " ".join(other), 3), (None, " ".join(base), 4), (10, None, 5), (11, "", 6)], "doc_id long, text string, id int")
    left = near_dedup(docs)
    assert left.columns == docs.columns
    assert sorted(r.id for r in left.collect()) == [2, 3, 5]
    assert near_dedup(docs.limit(0)).count() == 0
    assert bits_for_similarity(0.8, 128) == 19


def test_long_chain_settles(spark):
    edges = spark.range(1, 300).selectExpr("id as u", "id - 1 as v")
    assert least_reachable(edges).where("root = 0").count() == 299


def shingles(text, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard_closure(rows):
    """doc_id -> smallest id reached over pairs of real Jaccard 0.8 or more"""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if root[i] != root[j] and (a == b or (min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) / len(a | b) >= 0.8)):
                x, y = root[i], root[j]
                root = [min(x, y) if z in (x, y) else z for z in root]
    least = {}
    for (d, _), r in zip(rows, root):
        least[r] = min(least.get(r, d), d)
    return {d: least[r] for (d, _), r in zip(rows, root)}


def test_near_dedup_is_exact_jaccard(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(60):  # bases with copies whose similarity lies on both sides of 0.8
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([4, 9, 60, 300, 2000]))]
        rows.append(" ".join(base))
        for share in (0.01, 0.018, 0.02, 0.022, 0.025, 0.03, 0.05):
            copy = list(base)
            for i in rng.sample(range(len(copy)), max(1, int(share * len(copy)))):
                copy[i] = f"x{rng.randrange(10**9)}"
            rows.append(" ".join(copy).upper() if share == 0.02 else " ".join(copy))
    rows += ["", None, " \n", "one", "ONE", "one two", "é x 😀 " * 30]
    rows = list(enumerate(rows))
    want = jaccard_closure(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: r.component_id for r in similar_groups(docs).collect()} == want
    assert sorted(r.doc_id for r in near_dedup(docs).collect()) == sorted(set(want.values()))
    assert 100 < len(set(want.values())) < 400


def test_near_dedup_of_documents_is_exact_jaccard(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: r.component_id for r in similar_groups(docs).collect()} == jaccard_closure(rows)


@pytest.mark.parametrize("size", [4, 9, 40, 400])
def test_recall_of_the_budgets_at_the_least_similarity(size):
    """Of pairs of sets of a similarity of 0.8 and little more, how many some rotation keeps within the scheme's budgets."""
    rng = np.random.default_rng(size)
    pairs, shared = 400, -(-8 * size // 9)  # each set has ``size`` hashes, so shared / (2 * size - shared) is 0.8 or more
    every = rng.integers(0, 1 << 63, (pairs, 2 * size - shared), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (pairs, 2 * size - shared), dtype=np.uint64)
    sides = [every[:, :size], np.concatenate([every[:, :shared], every[:, size:]], axis=1)]
    a, b = (set_fingerprints(np.ascontiguousarray(s).ravel(), np.arange(pairs + 1) * size, NEAR.words) for s in sides)
    kept = np.zeros(pairs, bool)
    for turn in range(NEAR.turns):
        x = simhash.rotate(a, turn * NEAR.step) ^ simhash.rotate(b, turn * NEAR.step)
        errors = np.unpackbits(x.byteswap().view(np.uint8).reshape(pairs, -1), axis=1).cumsum(1)
        kept |= np.all([errors[:, depth - 1] <= most for depth, most in NEAR.budgets], axis=0)
    assert kept.mean() >= 0.95


def test_near_copies_that_are_not_alike_are_not_paired(spark, monkeypatch):
    """Copies of one text, each with words of its own, so that nearly all pairs have a similarity of 0.6 to 0.75."""
    rng = random.Random(7)
    base, rows = [f"w{rng.randrange(5000)}" for _ in range(150)], []
    for i in range(300):
        copy = list(base)
        for k in rng.sample(range(150), rng.choice([2, 5, 6, 7, 8])):
            copy[k] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(copy)))
    pairs, materialize = [], simhash.materialize

    def kept(df, tag):
        out = materialize(df, tag)
        if tag == "near-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(simhash, "materialize", kept)
    want = jaccard_closure(rows)
    assert {r.id: r.component_id for r in similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want
    assert len(set(want.values())) > 100
    assert sum(pairs) < 2000  # of 44,850


@pytest.mark.parametrize("size", [0, 1, 60, 500, 1500, 40_000])
def test_parity_maps_drop_no_pair_that_is_alike(size):
    rng = np.random.default_rng(size)
    hashes = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    sets, base = [], hashes(size)
    for share in (0, 0.05, 0.1, 0.11, 0.12, 0.2, 0.25, 0.5):
        gone, new = int(share * size), hashes(int(share * size))
        sets += [np.concatenate([base[gone:], new]), base[gone:], np.concatenate([base, new])]
    at = np.concatenate([[0], np.cumsum([x.size for x in sets])])
    maps = parity_maps(np.concatenate(sets), at)
    offs = np.frombuffer(maps.buffers()[1], np.int32).astype(np.int64)
    words = (np.frombuffer(maps.buffers()[2], np.uint64), offs[:-1] >> 3, np.diff(offs) >> 3)
    u, v = (x.ravel() for x in np.meshgrid(*[np.arange(len(sets))] * 2))
    maybe = may_be_alike(u, v, np.diff(at), words, 0.8)
    alike = np.array([len(x & y) >= 0.8 * len(x | y) for x, y in ((set(sets[i].tolist()), set(sets[j].tolist())) for i, j in zip(u, v))])
    assert maybe[alike].all()
    if size in (60, 500, 1500):
        assert (~maybe[~alike]).mean() > 0.6
