import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tidewatch.llm import bpe
from tidewatch.llm.bpe import Lexicon, Tokenizer, _starts, encode_digest, folded, load_ranks, mergeable, merged_ids, pair_table

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


CASES = [
    None, "", " ", "\n\n  x", "Hello world, it's we'll 123 456abc", "<|endoftext|> as text", "é😀 ñandú  été  x", "a" * 3000, "ab" * 400, " " * 700 + "z",
    "''s 's'll'x 'sabc 'veto'd\n's  'm 're", "\x1c\x1d \x85\u180e\u200b\u2028 \u00a0\u3000x", "x'", "'", "'r", "x  \n", "  'tis  ''tis",
    "日本語のテキスト" * 20, "\x00\x01\x7f", "!?" * 900, "mixed\tTabs\r\nand\x0bmore", "ﬁ Ǆ İstanbul ß", "0" * 700,
]


def check(spark, library, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in encode_digest(docs, PATH, PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids), (i, (t or "")[:60])
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), (i, (t or "")[:60])
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """By the definition: the leftmost pair of the lowest rank is merged until none has one."""
    pieces = [word[i : i + 1] for i in range(len(word))]
    while len(pieces) > 1:
        rank, i = min((ranks.get(a + b, len(ranks) + 1), i) for i, (a, b) in enumerate(zip(pieces, pieces[1:])))
        if rank > len(ranks):
            break
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
    return [ranks[p] for p in pieces]


def test_pair_table_holds_every_pair_and_ends():
    pairs = mergeable(load_ranks(PATH))
    began = time.time()
    slots, shift = pair_table(pairs)
    assert time.time() - began < 30 and slots.size < 500_000
    assert (slots[shift[pairs[:, 0]] + pairs[:, 1]] == (pairs[:, 0] << 16 | pairs[:, 2])).all()
    used = slots[slots != bpe._FREE]
    assert used.size == len(pairs)
    # every left id has the same rights: none fits between another's, each goes behind the last
    dense = np.array([(a, b, 7) for a in range(40) for b in range(0, 40_000, 400)])
    slots, shift = pair_table(dense)
    assert (slots[shift[dense[:, 0]] + dense[:, 1]] == (dense[:, 0] << 16 | 7)).all()
    assert pair_table(np.zeros((0, 3), np.int64))[0].size == 1


def test_heap_by_the_definition():
    rng, ranks = random.Random(5), load_ranks(PATH)
    for _ in range(300):
        word = "".join(rng.choices("abcdeiénst th", k=rng.randrange(0, 90))).encode()
        assert merged_ids(word, ranks) == merge_bytes(word, ranks)
    few = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"ba": 299, b"abab": 298, b"aba": 400}
    for word in (b"ab" * 31, b"ba" * 30 + b"b", b"aabba" * 9):
        assert merged_ids(word, few) == [few[p] for p in _pieces(word, few)]


def _pieces(word, ranks):
    pieces = [word[i : i + 1] for i in range(len(word))]
    while True:
        known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(pieces, pieces[1:])) if a + b in ranks]
        if not known:
            return pieces
        i = min(known)[1]
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]


def test_words_of_a_million_bytes(spark, library):
    rng = random.Random(6)
    texts = ["ab" * 150_000, "".join(rng.choices("etaoinshrdlu", k=1_000_000)), "x " * 100 + "=" * 300_000]
    began = time.time()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in encode_digest(docs, PATH, PATTERN).collect()}
    assert time.time() - began < 90
    for i, t in enumerate(texts):
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert got[2].n_tokens == len(library.encode_ordinary(texts[2]))


def test_edges_match_the_library(spark, library):
    check(spark, library, CASES)


def test_table_matches_the_library(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 500)
    monkeypatch.setattr(bpe, "HEAD_WORDS", 60)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    check(spark, library, texts)


def test_fold_by_the_definition(spark):
    rng = random.Random(2)
    words = [w.encode() for w in sorted({"".join(rng.choices("abcdeiénst ", k=rng.randrange(1, 40))) for _ in range(300)} | {"=" * 1500, "ab" * 700})]
    ranks, tok = load_ranks(PATH), Tokenizer(spark, PATH, PATTERN)
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    opened = Lexicon(ranks, PATTERN).opened(data, np.append(0, ends[:-1]), ends)
    rows = spark.createDataFrame(pa.table({"w": pa.array(words, pa.binary()), "x": opened}))
    for r in rows.select("w", F.element_at(folded(F.array("x"), tok.slots, tok.shift), 1).alias("ids")).collect():
        assert r.ids == merge_bytes(bytes(r.w), ranks)


def test_splits_like_the_pattern():
    rng = random.Random(3)
    kinds, find = bpe.character_classes(), regex.compile(PATTERN).finditer
    for _ in range(300):
        rows = ["".join(rng.choices("'  \n\tstmdrevl Aé日1٣!?\u00a0\x1c😀", k=rng.randrange(0, 60))) for _ in range(5)]
        raw = [t.encode() for t in rows]
        offs = np.cumsum([0, *map(len, raw)])
        want = [a + len(t[: m.start()].encode()) for a, t in zip(offs, rows) for m in find(t)]
        assert _starts(np.frombuffer(b"".join(raw), np.uint8), offs, kinds).tolist() == want


def test_words_without_hashes(library):
    texts = ["alphabetagammadelta", "omegapsichiphi uvwxyzzz", "alphabetagammadelta omegapsichiphi"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0, *[len(t) for t in texts]])
    lexicon = Lexicon(load_ranks(PATH), PATTERN).ready()
    ids, per = bpe._by_bytes(lexicon, load_ranks(PATH), data, offs)
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t)]
    assert per.tolist() == [len(library.encode_ordinary(t)) for t in texts]


def test_another_pattern(spark):
    pattern = r"\w+"
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(PATH), special_tokens={})
    docs = spark.createDataFrame([(1, "anöther pattern, with gaps"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in Tokenizer(spark, PATH, pattern).encode(docs).collect()}
    assert got == {1: [i for w in ("anöther", "pattern", "with", "gaps") for i in library.encode_ordinary(w)], 2: []}


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", "a", "b")], "doc_id long, text string, ids string, row string")
    tok = Tokenizer(spark, PATH, PATTERN)
    out = tok.decode(tok.encode(docs))
    assert out.columns == ["doc_id", "text", "row", "ids", "decoded"]
    assert bytes(out.first().decoded) == b"some text"
    assert bytes(tok.encode(docs, decoded_col="row").first().row) == b"some text"
    assert tok.encode(docs.limit(0)).count() == 0
