import hashlib
import random
import re

from tidewatch.llm import substring_dedup
from tidewatch.llm.substring_dedup import dedup_substrings

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(t):
    return [w for w in SPACE.split(t or "") if w]


def brute(rows, length=20):
    seen, out = {}, {}
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0]))
    for i, t in order:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            k = tuple(w[s : s + length])
            if k in seen:
                gone[s : s + length] = [True] * length
            seen.setdefault(k, 1)
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string" if len(rows[0]) == 3 else "doc_id long, text string")
    return {r.row.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in dedup_substrings(docs).collect()}


def sample():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    common = [rng.choices(vocab, k=rng.choice([19, 20, 21, 50, 90])) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(5)):
            parts += rng.choices(vocab, k=rng.randrange(30))
            p = rng.choice(common)
            a = rng.randrange(3)
            parts += p[a:] if rng.random() < 0.5 else p
        rows.append((i, "  ".join(parts) if i % 7 else "\t".join(parts).upper()))
    rows += [(200, "a " * 70), (201, "a " * 45 + "b"), (202, None), (203, " \n"), (204, rows[5][1]), (205, "é 😀 " * 40), (None, rows[3][1])]
    return rows


def test_against_brute_force(spark):
    rows = sample()
    assert run(spark, rows) == brute(rows)


def test_hot_anchors_take_the_join(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCKS_IN_MEMORY", 1)
    rows = sample()
    assert run(spark, rows) == brute(rows)


def test_without_filter(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MOST_BITS", 1)
    rows = sample()[:60]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"x{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "p"), (1, text, "q"), (2, text, "r")], "doc_id long, text string, digest string")
    got = sorted((r.row.digest, r.n_removed, r.kept_text) for r in dedup_substrings(docs, with_text=True).collect())
    assert got == [("p", 0, text), ("q", 0, text), ("r", 40, "")]
    assert dedup_substrings(docs.limit(0)).count() == 0
