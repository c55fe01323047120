import re

import numpy as np
import pyarrow as pa
import xxhash

from tidewatch.llm.hmm import score_lm
from tidewatch.llm.shingles import set_fingerprints
from tidewatch.llm.substring_dedup import dedup_substrings
from tidewatch.llm.textkernel import U64, chunks, code_points, split_words, text_buffer, word_hashes


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def hashes(words):
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    return word_hashes(data, np.append(0, ends[:-1]).astype(np.int64), ends)


def test_equal_words_and_no_others_hash_alike():
    words = [bytes([b]) * n for n in (1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200) for b in b"\x00\x01az"]
    words += [b"ab" * 40 + b"c", b"ba" * 40 + b"c", b"abcdefgh12345678", b"12345678abcdefgh", b"abcdefgh", b"abcdefgh\x00"]
    words += [w.encode() for n in (16, 64, 128, 1024, 4096) for w in thue_morse(n)]
    got = hashes(words * 3)
    assert np.array_equal(got, np.tile(got[: len(words)], 3))
    assert len(set(got.tolist())) == len(set(words))
    assert hashes([b"x" * 100])[0] == xxhash.xxh64_intdigest(b"x" * 100, 42)


def test_words_of_regular_structure_stay_apart(spark):
    one, two = thue_morse(1024)
    same = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{same} {one}"), (2, f"{same} {two}"), (3, f"{same} {one}")], "doc_id long, text string")
    assert {r.row.doc_id: r.n_removed for r in dedup_substrings(docs).collect()} == {1: 0, 2: 0, 3: 20}
    # 9 is not held out, 2 is: its long word was never seen
    lm = {r.doc_id: r for r in score_lm(spark.createDataFrame([(9, f"x {one}"), (13, f"x {two}")], "doc_id long, text string")).collect()}
    assert [lm[d].held_out for d in (9, 13)] == [False, True]
    assert lm[13].n_known == 2 and lm[13].n_tokens == 3


def test_chunks_and_words():
    texts = ["a bc\td", None, "", "é 日本", " " * 5, "x" * 3000, "last"]
    for most in (1, 10, 1 << 20):
        words, rows = [], 0
        for a, b, data, offs in chunks(pa.array(texts), most):
            starts, ends, at = split_words(data, offs)
            rows += b - a
            raw = data.tobytes()
            words += [[raw[s:e].decode() for s, e in zip(starts[i:j], ends[i:j])] for i, j in zip(at[:-1], at[1:])]
        assert rows == len(texts)
        assert words == [(t or "").split() for t in texts]
    data, offs = text_buffer(pa.array(texts))
    code, at = code_points(data, offs)
    assert ["".join(map(chr, code[i:j])) for i, j in zip(at[:-1], at[1:])] == [t or "" for t in texts]


def test_set_fingerprints_by_the_definition():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(U64) * U64(3)) for n in (0, 1, 2, 7, 400)]
    at = np.cumsum([0, *[s.size for s in sets]])
    got = set_fingerprints(np.concatenate(sets), at, 4)
    for s, g in zip(sets, got):
        want = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in s) > len(s))
        assert int(g[0]) == want
    assert len({tuple(g.tolist()) for g in got}) == 5
