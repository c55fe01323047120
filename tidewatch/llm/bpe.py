"""Byte-level BPE: Spark higher-order functions fold ranked merges over the bytes of distinct words.

1. Every task splits its texts into words and sends on the words that aren't tokens themselves, each once.  They are
   counted by the tasks that have them.
2. Of the words that two tasks or more have, the commonest ``HEAD_WORDS`` are folded once and broadcast, as sorted
   hashes with their ids: 10 MB at most, whatever the corpus.
3. In the pass over the documents a task sends the words that it has alone through the same fold, with the first
   document that has them, and a second pass of the same task fills their ids in.  No document is shuffled.

A fold keeps an array with an element for each piece: rank of the pair that it opens, place of its first byte, id.  Its
least element is so the leftmost pair of the lowest rank; it is merged until none has a rank.  Ranks of pairs of ids
are two arrays that scalar subqueries give, rows of left ids laid over one another.  Words of more than ``LONG_BYTES`` bytes, for
which a fold is quadratic, are merged with a heap; the ids are the same.

Words are known by 64-bit hashes (``textkernel``), but nothing rests on them: every chunk's ids are decoded, and unless
that gives the bytes of the texts back, the words are merged from their bytes.  Decoding concatenates the binary pieces
of the ids.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import give_back, lean, materialize
from tidewatch.llm.textkernel import U64, chunks, text_buffer, word_hashes

HEAD_WORDS = 400_000
#: A task forgets the words it has numbered beyond so many, and numbers them anew.
WORDS_AT_ONCE = 200_000
#: The pattern that ``_starts`` splits by; any other is left to the regex library.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_NO_RANK = (1 << 16) - 1
_EDGE = _NO_RANK << 47 | _NO_RANK
#: A slot of no pair: it reads as no rank whatever the left id is.
_FREE = _NO_RANK
#: Places that ``pair_table`` tries at once.
_SWEEP = 1 << 15
#: Longer words are merged with a heap: a fold looks at all pieces for each merge.
LONG_BYTES = 256


@lru_cache(maxsize=2)
def rank_table(path: str) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Ranks of a file, and ``pair_table`` of them; made once a process."""
    ranks = load_ranks(path)
    if max(ranks.values()) >= _NO_RANK:
        raise ValueError(f"ranks must be below {_NO_RANK}")
    return ranks, *pair_table(mergeable(ranks))


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a tiktoken file."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(a): int(b) for a, b in pairs}


def mergeable(ranks: dict[bytes, int]) -> np.ndarray:
    """left id, right id, rank of every pair of tokens whose bytes together are a token."""
    found = [(a, b, rank) for token, rank in ranks.items() for k in range(1, len(token)) if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None]
    return np.array(found, np.int64).reshape(-1, 3)


def pair_table(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots (left id << 16 | rank) and a shift for each left id: a pair is at the left id's shift plus the right id.

    First fit, left ids of most pairs first: a left id goes to the first place where all its pairs fall on free slots.
    The place behind the last used slot always fits, so each left id is placed in one sweep.
    """
    many = int(pairs[:, :2].max(initial=0)) + 1
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    left, first, count = np.unique(pairs[:, 0], return_index=True, return_counts=True)
    free, used, shift = np.ones(4 * many, bool), 0, np.zeros(many, np.int64)
    slots = np.full(free.size, _FREE, np.int64)
    for k in np.argsort(-count, kind="stable").tolist():
        mine = pairs[first[k] : first[k] + count[k]]
        away = mine[:, 1] - mine[0, 1]
        if used + _SWEEP + many > free.size:
            more = np.ones(free.size, bool)
            free, slots = np.concatenate([free, more]), np.concatenate([slots, np.full(more.size, _FREE, np.int64)])
        for low in range(0, used + 1, _SWEEP):
            fits = free[low : low + _SWEEP].copy()
            for d in away[1:].tolist():
                fits &= free[low + d : low + d + _SWEEP]
                if not fits.any():
                    break
            if fits.any():
                break
        place = low + int(fits.argmax())
        shift[left[k]] = place - mine[0, 1]
        free[place + away], slots[place + away] = False, left[k] << 16 | mine[:, 2]
        used = max(used, place + int(away[-1]) + 1)
    return slots[: max(used, 1)], shift


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def folded(words: Column, slots: Column, shift: Column) -> Column:
    """Ids of each word; a word: array<long> with an edge, an element for each byte, and an edge."""

    def with_table(table: Column) -> Column:
        def placed(pair: Column) -> Column:  # start << 32 | left id << 16 | right id -> the left piece's element
            left, right = F.shiftright(pair, 16).bitwiseAND(_long(0xFFFF)).cast("int"), pair.bitwiseAND(_long(0xFFFF)).cast("int")
            slot = F.get(table["slots"], F.get(table["shift"], left) + right)
            rank = F.least(slot.bitwiseXOR(pair.bitwiseAND(_long(0xFFFF0000))), _long(_NO_RANK))  # another's slot, or none, is more than that
            return F.shiftleft(rank, 47).bitwiseOR(F.shiftright(pair, 16))

        def step(pieces: Column, _) -> Column:
            def at(i: Column) -> Column:  # place of the pair's first piece, from 1; an edge stands before it
                token = F.shiftright(F.get(pieces, i - 1), 47)
                left = F.shiftleft(F.get(pieces, i - 2).bitwiseAND(_long((1 << 47) - 1)), 16).bitwiseOR(token)
                start = F.get(pieces, i - 1).bitwiseAND(_long((1 << 47) - (1 << 16)))
                right = F.shiftleft(start.bitwiseOR(token), 16).bitwiseOR(F.get(pieces, i + 1).bitwiseAND(_long((1 << 16) - 1)))
                return F.flatten(F.array(F.slice(pieces, F.lit(1), i - 2), F.transform(F.array(left, right), placed), F.slice(pieces, i + 2, F.size(pieces))))

            least = F.array_min(pieces)
            merge = F.element_at(F.transform(F.array(F.array_position(pieces, least).cast("int")), at), 1)
            return F.when(least >= _long(_NO_RANK << 47), pieces).otherwise(merge)

        def word_ids(word: Column) -> Column:
            last = lambda pieces: F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 2), lambda x: x.bitwiseAND(_long((1 << 16) - 1)).cast("int"))
            merges = F.when(F.array_min(word) >= _long(_NO_RANK << 47), F.lit(4)).otherwise(F.greatest(F.size(word), F.lit(4)))
            return F.aggregate(F.sequence(F.lit(4), merges), word, step, last)

        return F.transform(words, word_ids)

    return F.element_at(F.transform(F.array(F.struct(slots.alias("slots"), shift.alias("shift"))), with_table), 1)


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Letter, number, white space or other, for each code point."""
    out, block = np.zeros(0x110000, np.uint8), 1 << 11
    for low in range(0, out.size, block):
        if 0xD800 <= low < 0xE000:  # surrogates are no characters
            continue
        every = "".join(map(chr, range(low, low + block)))
        for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\p{White_Space}")):
            out[[low + m.start() for m in regex.finditer(pattern, every)]] = kind
    return out


def _starts(data: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Bytes at which a match of ``_PATTERN`` starts; matches leave no gaps, and none spans two rows."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if not lead.size:
        return lead
    code = data if lead.size == data.size else np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    row = np.zeros(code.size + 1, bool)
    row[np.searchsorted(lead, offs)] = True
    kind = classes[code]
    run = np.empty(code.size, bool)
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run |= row[:-1]
    start = run.copy()
    # the last of a run of white space: a blank goes to the run behind it, anything else is a match of its own
    behind = np.flatnonzero(run[1:] & ~row[1:-1] & (kind[:-1] == _SPACE)) + 1
    start[behind - 1] = True
    start[behind] = code[behind - 1] != 32
    # an apostrophe that opens a match takes one or two of the letters behind it
    mark = np.flatnonzero(start & (code == 39))
    mark = mark[mark + 1 < code.size]
    mark = mark[~row[mark + 1]]
    one = code[mark + 1]
    two = np.where((mark + 2 < code.size) & ~row[np.minimum(mark + 2, code.size)], code[np.minimum(mark + 2, code.size - 1)], 0)
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    hit = long | np.isin(one, [ord(c) for c in "stmd"])
    mark, long = mark[hit], long[hit]
    start[mark + 1] = False
    after = mark + 2 + long
    start[after[after < code.size]] = True
    return lead[start]


def _regex_starts(find, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw, starts, ends = data.tobytes(), [], []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        at, low = 0, a
        text = raw[a:b].decode()
        for m in find(text):
            low += len(text[at : m.start()].encode())
            starts.append(low)
            low += len(m[0].encode())
            ends.append(low)
            at = m.end()
    return np.array(starts, np.int64), np.array(ends, np.int64)


class Index:
    """Places of 64-bit keys, by open addressing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * keys.size).bit_length())
        self.shift, self.mask, self.keys = U64(64 - bits), (1 << bits) - 1, keys
        self.slot = np.full(1 << bits, -1, np.int32)
        left = np.arange(keys.size, dtype=np.int32)
        at = (keys >> self.shift).astype(np.int64)
        while left.size:
            open_ = self.slot[at] < 0
            self.slot[at[open_]] = left[open_]
            lost = self.slot[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        out = np.full(keys.size, -1, np.int64)
        if not self.keys.size:
            return out
        rest, at = np.arange(keys.size), (keys >> self.shift).astype(np.int64)
        while rest.size:
            slot = self.slot[at]
            same = (slot >= 0) & (self.keys[slot] == keys[rest])
            out[rest[same]] = slot[same]
            go = (slot >= 0) & ~same
            rest, at = rest[go], (at[go] + 1) & self.mask
        return out


def _find_sorted(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each wanted key, a place among sorted ones and whether it is there."""
    if not keys.size:
        return np.zeros(wanted.size, np.int64), np.zeros(wanted.size, bool)
    spot = np.minimum(np.searchsorted(keys, wanted), keys.size - 1)
    return spot, keys[spot] == wanted


def _spans(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. of each of several runs, one after another."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _strings(raw: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(kind, lengths.size, [None, pa.py_buffer(edges), pa.py_buffer(raw)])


def _row_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of consecutive runs of values, ``sizes`` long, the sums."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(sizes)])])


class Lexicon:
    """Known words: ids of each word by its hash; what is broadcast.  It also splits, decodes and opens folds."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.pattern = pattern
        self.classes = character_classes() if pattern == _PATTERN else None
        self.rank_of = np.array([ranks[t] for t in tokens], np.int64)
        size = np.array([len(t) for t in tokens], np.int64)
        self.pieces = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum(size)
        self.keys, self.n = word_hashes(self.pieces, ends - size, ends), np.ones(size.size, np.int32)
        self.ids = self.rank_of.astype(np.int32)
        self.piece_size = np.zeros(int(self.rank_of.max()) + 1, np.int64)
        self.piece_at = np.zeros_like(self.piece_size)
        self.piece_size[self.rank_of], self.piece_at[self.rank_of] = size, ends - size
        decimal = [b"%d " % r for r in range(self.piece_size.size)]
        self.decimal = np.frombuffer(b"".join(decimal), np.uint8)
        self.decimal_size = np.array([len(d) for d in decimal], np.int64)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pair = [[ranks.get(bytes([a, b]), _NO_RANK) for b in range(256)] for a in range(256)]
        self.byte_rank = np.array(pair, np.int64)

    def learn(self, keys: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        self.keys, self.n, self.ids = np.concatenate([self.keys, keys]), np.concatenate([self.n, n.astype(np.int32)]), np.concatenate([self.ids, ids.astype(np.int32)])

    def ready(self, finds: bool = True) -> Lexicon:
        """With what is quicker made than sent; ``finds``: words are looked up, else only their ids are read."""
        if finds and not hasattr(self, "tokens"):
            few = self.rank_of.size  # most words are tokens, and a small index is quicker
            self.tokens, self.words = Index(self.keys[:few]), Index(self.keys[few:])
        if not hasattr(self, "at"):
            self.at = np.cumsum(self.n, dtype=np.int64) - self.n
            self.finditer = None if self.classes is not None else regex.compile(self.pattern).finditer
        return self

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each word, or -1."""
        out = self.tokens.find(keys)
        rest = np.flatnonzero(out < 0)
        place = self.words.find(keys[rest])
        out[rest] = np.where(place < 0, -1, place + self.rank_of.size)
        return out

    def split(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and where each row's words begin (one more than rows)."""
        if self.finditer is not None:
            starts, ends = _regex_starts(self.finditer, data, offs)
        else:
            starts = _starts(data, offs, self.classes)
            ends = np.append(starts[1:], data.size) if starts.size else starts
        return starts, ends, np.searchsorted(starts, offs)

    def opened(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.ListArray:
        """Words as ``folded`` takes them; those over ``LONG_BYTES`` bytes come merged, without any pair of a rank."""
        size = ends - starts
        merged = {k: merged_ids(data[starts[k] : ends[k]].tobytes(), self._ranks()) for k in np.flatnonzero(size > LONG_BYTES).tolist()}
        many = size.copy()
        many[list(merged)] = [len(x) for x in merged.values()]
        out, first = np.full(int((many + 2).sum()), _EDGE, np.int64), np.cumsum(many + 2) - many - 1
        short = np.flatnonzero(size <= LONG_BYTES)
        n = size[short]
        within = _spans(n)
        at = np.repeat(starts[short], n) + within
        byte, behind = data[at], data[np.minimum(at + 1, data.size - 1)]
        rank = np.where(within + 1 < np.repeat(n, n), self.byte_rank[byte, behind], _NO_RANK)
        out[np.repeat(first[short], n) + within] = rank << 47 | (within + 1) << 16 | self.byte_id[byte]
        for k, ids in merged.items():
            out[first[k] : first[k] + many[k]] = _NO_RANK << 47 | np.array(ids, np.int64)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many + 2)]).astype(np.int32)), pa.array(out))

    def _ranks(self) -> dict[bytes, int]:
        if not hasattr(self, "rank_by_token"):
            raw = self.pieces.tobytes()
            self.rank_by_token = {raw[a : a + n]: r for r, (a, n) in enumerate(zip(self.piece_at.tolist(), self.piece_size.tolist())) if n}
        return self.rank_by_token

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and how many each has."""
        size = self.piece_size[ids]
        return self.pieces[np.repeat(self.piece_at[ids], size) + _spans(size)], size

    def decimals(self, ids: np.ndarray, per: np.ndarray) -> pa.Array:
        """Each row's ids as decimals, joined by one space."""
        size = self.decimal_size[ids]
        lengths, many = _row_sums(size, per), per > 0
        raw = self.decimal[np.repeat((np.cumsum(self.decimal_size) - self.decimal_size)[ids], size) + _spans(size)]
        raw = np.delete(raw, np.cumsum(lengths)[many] - 1)  # the space behind a row's last id
        return _strings(raw, lengths - many, pa.string())


def merged_ids(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word of any length: a heap gives the leftmost pair of the lowest rank until none has one.

    ``end[i]``: where the piece that starts at i ends, 0 if none does; ``before[i]``: where the piece before it starts.
    A heap's entry that no longer is the rank of its pair is passed over.
    """
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [ranks[word[i : i + 2]] << 40 | i for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        i = top & (1 << 40) - 1
        mid = end[i]
        if not mid or mid >= n or ranks.get(word[i : end[mid]]) != top >> 40:
            continue
        new, end[mid] = end[mid], 0
        end[i] = new
        if new < n:
            before[new] = i
        for a in (before[i], i):
            if a >= 0 and end[a] < n and (rank := ranks.get(word[a : end[end[a]]])) is not None:
                heapq.heappush(heap, rank << 40 | a)
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids))


def _unknown(lexicon: Lexicon, batches, column: str = "text"):
    """Of each chunk: batch, its rows, bytes, words, their places in the lexicon, and hash and one place of each unknown word."""
    for batch in batches:
        for a, b, data, offs in chunks(batch.column(column)):
            starts, ends, at = lexicon.split(data, offs)
            keys = word_hashes(data, starts, ends)
            place = lexicon.find(keys)
            yield batch.slice(a, b - a), data, starts, ends, at, keys, place


class Tokenizer:
    """A rank file and a pattern; ``encode`` and ``decode`` are DataFrame to DataFrame."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.ranks, slots, shift = rank_table(path)
        self.spark, self.pattern = spark, pattern
        self._table = slots, shift.astype(np.int32)

    @property
    def slots(self) -> Column:
        return F.from_json(F.lit(json.dumps(self._table[0].tolist())), "array<bigint>")

    @property
    def shift(self) -> Column:
        return F.from_json(F.lit(json.dumps(self._table[1].tolist())), "array<int>")

    def _beside_table(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the pair table as ``_slots`` and ``_shift``, to be read once by the next projection.

        They are scalar subqueries: literals of that size stand in the text of each plan, which the driver keeps.
        """
        table = lambda x: self.spark.createDataFrame(pa.table({"x": pa.array([x])})).scalar()
        return rows.select("*", table(self._table[0]).alias("_slots"), table(self._table[1]).alias("_shift"))

    def _lexicon(self, texts: DataFrame) -> Lexicon:
        """Tokens, and the ids of the words that are broadcast; texts: one column ``text``."""
        lexicon = Lexicon(self.ranks, self.pattern)
        shared, most = self.spark.sparkContext.broadcast(lexicon), WORDS_AT_ONCE

        def distinct(batches):
            mine = shared.value.ready()
            seen, many = [], 0
            for _, data, starts, ends, _, keys, place in _unknown(mine, batches):
                new, first = np.unique(keys[place < 0], return_index=True)
                for old in seen:
                    fresh = ~_find_sorted(old, new)[1]
                    new, first = new[fresh], first[fresh]
                first = np.flatnonzero(place < 0)[first]
                seen, many = [*seen, new], many + new.size
                if len(seen) > 8:
                    seen = [np.sort(np.concatenate(seen))]
                if many > 4 * most:
                    seen, many = [], 0
                size = ends[first] - starts[first]
                yield pa.RecordBatch.from_arrays([_strings(data[np.repeat(starts[first], size) + _spans(size)], size, pa.binary())], ["word"])

        counts = materialize(texts.mapInArrow(lean(distinct), "word binary").groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "bpe-words")
        sizes = {r.n: r.many for r in counts.groupBy(F.least("n", F.lit(1000)).alias("n")).agg(F.count("*").alias("many")).collect()}  # 999 rows at most
        least, total = 1001, 0
        for n in sorted(sizes, reverse=True):
            if (total := total + sizes[n]) > HEAD_WORDS:
                break
            least = n

        def open_rows(batches):
            mine = shared.value
            for batch in batches:
                _, offs, raw = batch.column("word").buffers()
                edges = np.frombuffer(offs, np.int32)[batch.column("word").offset :][: batch.num_rows + 1].astype(np.int64)
                data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(1, np.uint8)
                key = pa.array(word_hashes(data, edges[:-1], edges[1:]).view(np.int64))
                yield pa.RecordBatch.from_arrays([key, mine.opened(data, edges[:-1], edges[1:])], ["key", "word"])

        head = counts.where(F.least("n", F.lit(1000)) >= least).select("word").mapInArrow(lean(open_rows), "key long, word array<long>")
        head = materialize(self._beside_table(head).select("key", F.element_at(folded(F.array("word"), F.col("_slots"), F.col("_shift")), 1).alias("ids")), "bpe-head")
        got = head.dropDuplicates(["key"]).toArrow()  # HEAD_WORDS rows at most
        if got.num_rows:
            ids = got["ids"].combine_chunks()
            lexicon.learn(got["key"].to_numpy().view(U64), ids.value_lengths().to_numpy(), ids.flatten().to_numpy())
            del ids
        del got
        shared.unpersist()
        give_back()
        return lexicon

    def encode(self, docs: DataFrame, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
        """``docs`` with ``ids_col``: array<int>, each match of the pattern encoded by itself, no special tokens.

        With ``decoded_col``, also the binary that the ids decode to.  A null text counts as empty and has no ids; an
        empty table gives no rows; rows that repeat are encoded one by one.  Texts of any length are encoded whole; a
        column of that name is replaced, other columns pass through.
        """
        return self.encoded(docs, text_col, {"ids": ids_col} | ({"decoded": decoded_col} if decoded_col else {}))

    def encoded(self, docs: DataFrame, text_col: str, wanted: dict[str, str]) -> DataFrame:
        """As ``encode``; wanted: names of columns to add for ids, decoded, n (their number) and decimals (joined by a space)."""
        kinds = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.BinaryType(), "n": T.LongType(), "decimals": T.StringType()}
        more = list(wanted)
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        shared = self.spark.sparkContext.broadcast(self._lexicon(docs.select(text.alias("text"))))
        ranks, most = self.spark.sparkContext.broadcast(self.ranks), WORDS_AT_ONCE
        keep = [c for c in docs.columns if c not in wanted.values()]
        rows = docs.select(F.struct(F.lit(0).alias(""), *[F.col(f"`{c}`") for c in keep if c != text_col]).alias("row"), F.col(f"`{text_col}`").alias("text"))  # a struct needs a field

        def look_up(batches):
            mine = shared.value.ready()
            known, numbers, many, begin = [], [], 0, True
            for part, data, starts, ends, at, keys, place in _unknown(mine, batches):
                if many > most:
                    known, numbers, many, begin = [], [], 0, True
                hole = np.flatnonzero(place < 0)
                new, first, back = np.unique(keys[hole], return_index=True, return_inverse=True)
                number = np.full(new.size, -1, np.int64)
                for old, given in zip(known, numbers):
                    spot, same = _find_sorted(old, new)
                    number[same] = given[spot[same]]
                fresh = number < 0
                number[fresh] = many + np.arange(np.count_nonzero(fresh))
                many += int(np.count_nonzero(fresh))
                known, numbers = [*known, new[fresh]], [*numbers, number[fresh]]
                if len(known) > 8:
                    key, number_ = np.concatenate(known), np.concatenate(numbers)
                    order = np.argsort(key)
                    known, numbers = [key[order]], [number_[order]]
                place[hole] = -1 - number[back]
                first = hole[first[fresh]]
                words = mine.opened(data, starts[first], ends[first])
                # all of a chunk's new words go with its first row
                rest = pa.ListArray.from_arrays(pa.array(np.append(0, np.full(part.num_rows, first.size)).astype(np.int32)), words)
                begins = np.zeros(part.num_rows, bool)
                begins[0], begin = begin, False
                leads = np.arange(part.num_rows) == 0
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("text"), _lists(place.astype(np.int32), np.diff(at)), rest, pa.array(begins), pa.array(leads)], ["row", "text", "code", "rest", "begins", "leads"])

        def fill(batches):
            mine = shared.value.ready(finds=False)
            flat, ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
            for batch in batches:
                leads = np.flatnonzero(batch.column("leads").to_numpy(zero_copy_only=False))
                cuts = np.unique(np.concatenate([[0], leads, [batch.num_rows]]))
                for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    part = batch.slice(low, high - low)
                    if part.column("begins")[0].as_py():
                        flat, ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
                    new = part.column("rest").flatten()
                    if len(new):
                        flat = np.concatenate([flat, new.flatten().to_numpy()])
                        ends = np.concatenate([ends, ends[-1] + np.cumsum(new.value_lengths().to_numpy().astype(np.int64))])
                    code, sizes = part.column("code").flatten().to_numpy(), part.column("code").value_lengths().to_numpy()
                    hole = code < 0
                    slot, known = np.where(hole, -1 - code, 0), np.where(hole, 0, code)
                    n = np.where(hole, np.append(ends, ends[-1])[slot + 1] - ends[slot], mine.n[known])
                    at, mine_too = np.repeat(np.where(hole, ends[slot], mine.at[known]), n) + _spans(n), np.repeat(hole, n)
                    ids = np.empty(at.size, np.int32)
                    ids[mine_too], ids[~mine_too] = flat[at[mine_too]], mine.ids[at[~mine_too]]
                    per = _row_sums(n, sizes)
                    raw, length = mine.decoded(ids)
                    lengths = _row_sums(length, per)
                    data, offs = text_buffer(part.column("text"))
                    if no_gaps and not (np.array_equal(lengths, np.diff(offs)) and np.array_equal(raw, data)):
                        ids, per = _by_bytes(mine, ranks.value, data, offs)
                        raw, length = mine.decoded(ids)
                        lengths = _row_sums(length, per)
                    made = {"ids": lambda: _lists(ids, per), "decoded": lambda: _strings(raw, lengths, pa.binary()), "n": lambda: pa.array(per), "decimals": lambda: mine.decimals(ids, per)}  # noqa: B023
                    yield pa.RecordBatch.from_arrays([part.column("row"), part.column("text"), *[made[c]() for c in more]], ["row", "text", *more])

        no_gaps = self.pattern == _PATTERN
        shape = rows.schema
        split = rows.mapInArrow(lean(look_up), T.StructType([*shape, T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("rest", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("begins", T.BooleanType()), T.StructField("leads", T.BooleanType())]))
        joined = self._beside_table(split).select("row", "text", "code", F.when(F.size("rest") > 0, folded(F.col("rest"), F.col("_slots"), F.col("_shift"))).otherwise(F.array().cast("array<array<int>>")).alias("rest"), "begins", "leads")
        out = T.StructType([*shape, *[T.StructField(c, kinds[c]) for c in more]])
        filled = joined.mapInArrow(lean(fill), out)
        others = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in keep]
        return filled.select(*others, *[F.col(c).alias(name) for c, name in wanted.items()])

    def decode(self, df: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
        """``df`` with ``out_col``: the binary pieces of the ids, concatenated; null ids give null, unknown ids fail."""
        shared = self.spark.sparkContext.broadcast({r: t for t, r in self.ranks.items()})
        keep = [c for c in df.columns if c != out_col]
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))

        def run(batches):
            piece = shared.value.__getitem__
            for batch in batches:
                out = [b"".join(map(piece, x.values.to_pylist())) if x.is_valid else None for x in batch.column("ids")]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], ["row", "decoded"])

        return rows.mapInArrow(run, rows.select("row").schema.add("decoded", T.BinaryType())).select("row.*", F.col("decoded").alias(out_col))


def _by_bytes(lexicon: Lexicon, ranks: dict[bytes, int], data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and how many each row has, without any hash: for a chunk in which two words share one."""
    starts, ends, at = lexicon.split(data, offs)
    raw = data.tobytes()
    words = [merged_ids(raw[a:b], ranks) for a, b in zip(starts.tolist(), ends.tolist())]
    sizes = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    return np.array([i for w in words for i in w], np.int32), np.diff(sizes[at])


def encode_digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``, its text encoded and decoded again."""
    tokenizer = Tokenizer(docs.sparkSession, path, pattern)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = tokenizer.encoded(rows, "text", {"n": "n_tokens", "decimals": "decimals", "decoded": "decoded"})
    return both.select("doc_id", "n_tokens", F.sha2("decimals", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
