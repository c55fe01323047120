"""Overlap of texts with their source chunks, by word n-grams."""

from __future__ import annotations

from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.filters import key_filter, passing
from tidewatch.functions.text import first_answer, has_tags, is_json, run_hashes, word_tokens
from tidewatch.tables import written

LEAST, MOST, LEAK = 4, 25, 13
#: Runs of the chunks are broadcast up to so many, 16 bytes each; beyond that texts' runs pass a filter and are shuffled.
SMALL_RUNS = 1 << 20
_BLOCK_WORDS, _BLOCK_BYTES = 1 << 16, 1 << 19


def _runs(df: DataFrame, key: str, n: int) -> DataFrame:
    """key, digest of the text, h and i: hash and place of each run of n words."""
    words = df.select(key, F.xxhash64("text").alias("digest"), word_tokens(F.col("text")).alias("_w"))
    return words.select(key, "digest", F.posexplode(run_hashes(F.col("_w"), n)).alias("i", "h"))


def _said(df: DataFrame, hits: DataFrame, key: str, n: int) -> DataFrame:
    """``hits`` (key, digest, i) with run, the words themselves."""
    words = df.select(key, F.xxhash64("text").alias("digest"), word_tokens(F.col("text")).alias("_w")).dropDuplicates([key, "digest"])
    return hits.join(words, [key, "digest"]).withColumn("run", F.array_join(F.slice("_w", F.col("i") + 1, n), " ")).drop("_w")


def shared_shingles(texts: DataFrame, chunks: DataFrame, n: int = LEAK) -> DataFrame:
    """text_id, chunk_id, n_shared: distinct runs of n words that both have.

    Runs of the texts are hashes, and nearly all end where they are made: they meet the chunks' hashes in a broadcast
    join if those are few, else those that pass a bit filter of them are shuffled.  Only runs that meet become words
    again, which are compared.  What is shuffled is so in proportion to what is shared.
    """
    theirs = written(_runs(chunks, "chunk_id", n).select("chunk_id", F.col("digest").alias("_digest"), F.col("i").alias("_i"), "h"), "leak-runs")
    ours, many = _runs(texts, "text_id", n), theirs.count()
    if many <= SMALL_RUNS:
        hits = ours.join(F.broadcast(theirs), "h")
    else:
        hits = passing(ours, "h", key_filter(theirs.select("h").distinct(), many)).join(theirs, "h")
    hits = written(hits.drop("h"), "leak-hits")
    a = _said(texts, hits.select("text_id", "digest", "i").distinct(), "text_id", n)
    b = _said(chunks, hits.select("chunk_id", F.col("_digest").alias("digest"), F.col("_i").alias("i")).distinct(), "chunk_id", n)
    b = b.select("chunk_id", F.col("digest").alias("_digest"), F.col("i").alias("_i"), F.col("run").alias("_run"))
    met = hits.join(a, ["text_id", "digest", "i"]).join(b, ["chunk_id", "_digest", "_i"]).where("run = _run")
    return met.select("text_id", "chunk_id", "run").distinct().groupBy("text_id", "chunk_id").agg(F.count("*").alias("n_shared"))


def _offsets(column: pa.ListArray) -> np.ndarray:
    return column.offsets.to_numpy().astype(np.int64)


def _hashes(runs: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of runs that are a word longer."""
    x = (runs ^ (runs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _in_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys of hashes that are told apart by row."""
    return hashes ^ ((row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _first_runs(word: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places with ``LEAST`` words or more left in their list, and the hashes of those runs."""
    at = np.flatnonzero(left >= LEAST)
    runs = word[at]
    for k in range(1, LEAST):
        runs = _hashes(runs, word[at + k])
    return at, runs


def _left(offsets: np.ndarray) -> np.ndarray:
    """Words from each place to the end of its list."""
    return np.repeat(offsets[1:], np.diff(offsets)) - np.arange(offsets[0], offsets[-1])


def _blocks(offsets: np.ndarray, most: int) -> list[slice]:
    """Rows one after another that have about ``most`` items, one at least: what is worked on at once stays in the caches."""
    cuts = np.searchsorted(offsets, np.arange(offsets[0], offsets[-1] + most, most), "left")
    cuts = np.unique(np.concatenate([[0], np.minimum(cuts, offsets.size - 1), [offsets.size - 1]]))
    return [slice(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])]


def longest_runs(texts: pa.Array, chunks: pa.Array) -> pa.Array:
    """Of each row's text, a list of word hashes, and each of its chunks: the longest run of words that both have."""
    blocks = [(texts[k], chunks[k]) for k in _blocks(_offsets(texts), _BLOCK_WORDS)]
    return pa.concat_arrays([_longest_runs(*both) for both in blocks] or [pa.array([], pa.list_(pa.int32()))])


def _longest_runs(texts: pa.Array, chunks: pa.Array) -> pa.Array:
    """``longest_runs`` of a block of rows.

    Places of a text and a chunk where a run of 4 words of both begins are carried on a word at a time, up to 25: those
    whose longer run both have stay.  A text is looked through once, whatever the number of its chunks.
    """
    text_at, many = _offsets(texts), np.diff(_offsets(chunks))
    text = texts.values.to_numpy().view(np.uint64)[text_at[0] : text_at[-1]]
    inner = chunks.flatten()  # the rows' chunks, one after another
    chunk_at = _offsets(inner)
    words = inner.values.to_numpy().view(np.uint64)[chunk_at[0] : chunk_at[-1]]
    out = np.zeros(len(inner), np.int32)
    row_of = np.repeat(np.arange(len(texts)), many)
    chunk = np.repeat(np.arange(len(inner)), np.diff(chunk_at))
    c_left, t_left = _left(chunk_at), _left(text_at)
    c, c_runs = _first_runs(words, c_left)
    t, t_runs = _first_runs(text, t_left)
    if c.size and t.size:
        row = np.repeat(np.arange(len(texts)), np.diff(text_at))[t]
        ours, theirs = _in_row(t_runs, row), _in_row(c_runs, row_of[chunk[c]])
        order = np.argsort(theirs, kind="stable")
        keys = theirs[order]
        size = 1 << int(16 * keys.size).bit_length()
        known = np.zeros(size, bool)
        known[(keys & np.uint64(size - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(known[(ours & np.uint64(size - 1)).astype(np.int64)])
        low, high = np.searchsorted(keys, ours[maybe], "left"), np.searchsorted(keys, ours[maybe], "right")
        n = high - low
        # a text's place meets each chunk once, however often the chunk has the run
        place = np.repeat(maybe, n)
        met = c[order[np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]]
        both = np.unique(np.stack([chunk[met], place], 1), axis=0) if met.size else np.zeros((0, 2), np.int64)
        pair, place = both[:, 0], both[:, 1]
        t, runs = t[place], t_runs[place]
        out[pair] = LEAST
        for length in range(LEAST + 1, MOST + 1):
            keep = c_left[c] >= length
            c, c_runs = c[keep], c_runs[keep]
            c_runs = _hashes(c_runs, words[c + length - 1])
            keep = t_left[t] >= length
            t, runs, pair = t[keep], runs[keep], pair[keep]
            runs = _hashes(runs, text[t + length - 1])
            theirs = np.unique(_in_row(c_runs, chunk[c]))
            mine = _in_row(runs, pair)
            at = np.minimum(np.searchsorted(theirs, mine), max(theirs.size - 1, 0))
            keep = theirs[at] == mine if theirs.size else np.zeros(mine.size, bool)
            t, runs, pair = t[keep], runs[keep], pair[keep]
            if not t.size:
                break
            out[pair] = length
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), pa.array(out))


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_LETTER = _class(ascii_letters)
_IN_WORD = _class(ascii_letters + digits + "_'-")
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(texts: pa.Array) -> pa.Array:
    """Of each text, the 64-bit hashes of its words, which are those of ``word_tokens``; null has none."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return pa.array([], pa.list_(pa.int64()))
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lists = [_hashes_of_words(raw[offs[k.start] : offs[k.stop]], offs[k.start : k.stop + 1] - offs[k.start]) for k in _blocks(offs, _BLOCK_BYTES)]
    sizes = np.concatenate([[0], *[np.diff(at) for at, _ in lists]])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(np.concatenate([h for _, h in lists]).view(np.int64)))


def _hashes_of_words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's words begin, and all words' hashes.

    A word is what follows the first letter in a run of letters, digits and ``_'-``; 8 of its bytes are hashed at a time.
    """
    inside = np.zeros(raw.size + 2, bool)
    inside[1:-1] = _IN_WORD[raw]
    opens, closes = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cut = offs[1:-1]
    cut = np.unique(cut[inside[cut] & inside[cut + 1]])  # a run doesn't go on in the next text
    opens[cut], closes[cut] = True, True
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    letters = np.flatnonzero(_LETTER[raw])
    at = np.searchsorted(letters, start)
    start = np.append(letters, raw.size)[at]
    start, end = start[start < end], end[start < end]
    raw = np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)])
    from_any = np.ndarray(raw.size - 7, "<u8", raw, strides=(1,))
    size = end - start
    out = _hashes(size.astype(np.uint64), from_any[start] & _FIRST_BYTES[np.minimum(size, 8)])
    live, k = np.flatnonzero(size > 8), 8
    while live.size:
        out[live] = _hashes(out[live], from_any[start[live] + k] & _FIRST_BYTES[np.minimum(size[live] - k, 8)])
        k += 8
        live = live[size[live] > k]
    return np.searchsorted(start, offs), out


def _word_hashes(text: Column) -> Column:
    return F.arrow_udf(word_hashes, "array<bigint>")(text)


def _with_longest(rows: DataFrame, words: Column, chunks: Column, name: str) -> DataFrame:
    """``rows`` with the longest runs of each row's words and its list of chunks, all as hashes of words."""
    longest = F.arrow_udf(longest_runs, "array<int>")
    return rows.withColumn(name, longest(words, chunks))


def longest_common(pairs: DataFrame, a: str = "text", b: str = "chunk") -> DataFrame:
    """``pairs`` with lcs: the longest run of words that both have, from 4 to 25; below that 0.

    Runs are compared by their 64-bit hashes.
    """
    return _with_longest(pairs, _word_hashes(F.col(a)), F.array(_word_hashes(F.col(b))), "lcs").withColumn("lcs", F.col("lcs")[0])


def candidates(records: DataFrame, chunks: DataFrame) -> DataFrame:
    """Records (text_id, text, source_ids, source_chunk) beside each chunk that they name, with place: where they name it."""
    ids = F.concat(F.coalesce("source_ids", F.array().cast("array<string>")), F.array("source_chunk"))
    named = records.select("text_id", "text", F.posexplode(ids).alias("place", "chunk_id")).where("chunk_id is not null")
    return named.join(chunks.select("chunk_id", F.col("text").alias("chunk")), "chunk_id")


def longest_of_named(records: DataFrame, chunks: DataFrame) -> DataFrame:
    """text_id, place, chunk_id, lcs: ``longest_common`` of ``candidates``; chunks, as hashes of their words, go to the texts.

    Records that name the same chunks under one id get these once, so each text is moved once however many it names.
    """
    names = F.to_json(F.struct("text_id", "source_ids", "source_chunk"))
    ids = F.concat(F.coalesce("source_ids", F.array().cast("array<string>")), F.array("source_chunk"))
    named = records.select(names.alias("names"), ids.alias("ids")).dropDuplicates(["names"])
    named = named.select("names", F.posexplode("ids").alias("place", "chunk_id")).where("chunk_id is not null")
    beside = named.join(chunks.select("chunk_id", _word_hashes(F.col("text")).alias("words")), "chunk_id")
    beside = beside.groupBy("names").agg(F.collect_list(F.struct("place", "chunk_id", "words")).alias("named"))
    rows = records.select(names.alias("names"), "text_id", "text").join(beside, "names")
    rows = _with_longest(rows.select("text_id", _word_hashes(F.col("text")).alias("_t"), "named"), F.col("_t"), F.col("named.words"), "lcs")
    rows = rows.select("text_id", F.explode(F.arrays_zip(F.col("named.place").alias("place"), F.col("named.chunk_id").alias("chunk_id"), F.col("lcs"))).alias("x"))
    return rows.select("text_id", "x.place", "x.chunk_id", "x.lcs")


def examined(records: DataFrame, chunks: DataFrame) -> DataFrame:
    """text_id, lcs and leak_chunk of records that name a chunk: chunks are looked at in the order named, up to the first leak.

    lcs is the longest run of those looked at; leak_chunk is null if none has a run of 13 words.
    """
    rows = written(longest_of_named(records, chunks), "leak-lcs")  # read twice, found once
    leak = F.col("lcs") >= LEAK
    first = rows.where(leak).groupBy("text_id").agg(F.min(F.struct("place", "chunk_id")).alias("_first"))
    seen = rows.join(first, "text_id", "left").where(F.col("_first").isNull() | (F.col("place") <= F.col("_first.place")))
    return seen.groupBy("text_id").agg(F.max("lcs").alias("lcs"), F.first("_first.chunk_id").alias("leak_chunk"))


def audit(records: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of counts over records (text_id, text, answer_text, synthesis, source_ids, source_chunk).

    Structure is valid if all four tags are there and what stands in the answer's is JSON; the leak rate is of those
    records that name a chunk; synthesis is ``?`` where unknown.  Percentages have two digits and are 0 of nothing.
    """
    rows = records.join(examined(records, chunks), "text_id", "left")
    said, leaks = F.coalesce("answer_text", F.lit("")), F.count_if(F.col("leak_chunk").isNotNull())
    valid = has_tags(said, "reasoning") & has_tags(said, "answer") & is_json(first_answer(said))
    kinds = rows.groupBy(F.coalesce("synthesis", F.lit("?")).alias("kind")).agg(F.count("*").alias("n"), F.count_if(valid).alias("valid"), F.count("lcs").alias("named"), leaks.alias("leaked"), F.max("lcs").alias("most"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    percent = lambda x, n: F.coalesce(F.bround(F.sum(x) * 100.0 / F.greatest(F.sum(n), F.lit(1)), 2), F.lit(0.0))
    by_kind = lambda c: F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col(c) > 0, F.struct("kind", c))))))
    return kinds.agg(
        total("n").alias("total"), total("valid").alias("structurally_valid"), percent("valid", "n").alias("structural_validity_pct"), total("named").alias("with_source_chunk"),
        total("leaked").alias("verbatim_leaked"), percent("leaked", "named").alias("leak_rate_pct"), F.coalesce(F.max("most"), F.lit(0)).alias("max_lcs_words_observed"),
        by_kind("n").alias("totals_by_synthesis"), by_kind("leaked").alias("leaks_by_synthesis"),
    )


def first_examples(leaks: DataFrame, n: int = 5) -> DataFrame:
    return leaks.orderBy(F.desc("lcs"), "text_id").limit(n)
