"""Repeated passages by seed and extend.

Seeds are winnowed anchors: of the 5-word grams in a stretch of ``length`` words the smallest hash, leftmost, is the
anchor of that window, so equal windows have equal anchors at equal offsets.  Consecutive windows with the same anchor
form a block; a document is tiled by blocks, about one for eight words.

1. Anchors that occur twice are found by a count with map-side combination, and put in a bit filter of bounded size.
2. Blocks whose anchor passes the filter are grouped by their whole content; the earliest of equal blocks stands for
   them.  Every window of a later one starts earlier elsewhere: it is covered whole.
3. The earliest blocks of one anchor are extended to both sides against each other, window by window, and windows that
   start earlier in another block are marked.  Anchors with very many different blocks go through an aggregation and a
   join instead of one task's memory.
4. Marks become ranges of words, gathered for each document; overlapping windows merge into maximal repeats.

The filter only spares work: a false positive is a block that finds no partner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize
from tidewatch.llm.textkernel import U64, chunks, mix, prefix_sums, run_hashes, split_words, word_hashes

LENGTH = 20
GRAM = 5
#: The filter has 16 bits for each repeated anchor, and never more than this many: 64 MB.
MOST_BITS = 1 << 29
#: Anchors with more different blocks than this are resolved by an aggregation and a join.
BLOCKS_IN_MEMORY = 50_000
_NO_ID = -(1 << 63)


def _blocks(data: np.ndarray, offs: np.ndarray, length: int):
    """Of the rows of one chunk: row, first window, windows, anchor, content hash of each block, and window hashes."""
    starts, ends, at = split_words(data, offs)
    hashes = word_hashes(data, starts, ends)
    none = np.zeros(0, np.int64)
    if hashes.size < length:
        return none, none, none, none.astype(U64), none.astype(U64), none.astype(U64), at
    sums = prefix_sums(hashes)
    i = np.arange(hashes.size - GRAM + 1)
    grams = run_hashes(hashes, i, i + GRAM, sums)
    best = i[: hashes.size - length + 1] + np.lib.stride_tricks.sliding_window_view(grams, length - GRAM + 1).argmin(1)
    row = np.repeat(np.arange(offs.size - 1), np.diff(at))
    s = np.arange(hashes.size - length + 1)
    s = s[row[s] == row[s + length - 1]]
    p = best[s]
    new = np.ones(s.size, bool)
    new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)
    k = np.flatnonzero(new)
    n = np.diff(np.append(k, s.size))
    low, anchor_at = s[k], p[k]
    shape = mix((anchor_at - low).astype(U64) * U64(64) + n.astype(U64))
    content = run_hashes(hashes, low, low + n + length - 1, sums) ^ shape
    windows = run_hashes(hashes, s, s + length, sums)
    return row[low], low - at[row[low]], n, grams[anchor_at], content, windows, at


def _passes(bits: np.ndarray | None, anchors: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(anchors.size, bool)
    size = U64(bits.size * 64 - 1)
    ok = np.ones(anchors.size, bool)
    for h in (anchors, mix(anchors)):
        b = h & size
        ok &= (bits[(b >> U64(6)).astype(np.int64)] >> (b & U64(63))) & U64(1) > 0
    return ok


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64, copy=False).view(np.int64))


def _anchor_rows(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in chunks(batch.column("text")):
                anchor, n = np.unique(_blocks(data, offs, length)[3], return_counts=True)
                yield pa.RecordBatch.from_arrays([_longs(anchor), pa.array(n.astype(np.int64))], ["anchor", "n"])

    return run


def _block_rows(length: int, bits, with_windows: bool) -> Callable:
    """doc, place, anchor, block of every block that passes; with windows, the earliest of a chunk's equal blocks only.

    place: first window, the text's digest and the number of windows in one long, in that order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = bits.value if bits is not None else None
        for batch in batches:
            doc, digest = batch.column("doc_id").to_numpy(), batch.column("digest").to_numpy()
            for a, _, data, offs in chunks(batch.column("text")):
                row, first, n, anchor, content, windows, _ = _blocks(data, offs, length)
                ok = np.flatnonzero(_passes(mine, anchor))
                ends = np.cumsum(n)
                ids, place = doc[a + row[ok]], (first[ok] << 36) | (digest[a + row[ok]] << 4) | (n[ok] - 1)
                if with_windows and ok.size:
                    order = np.lexsort((place, ids, content[ok], anchor[ok]))
                    x, y = anchor[ok][order], content[ok][order]
                    lead = np.ones(order.size, bool)
                    lead[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
                    take = np.sort(order[lead])
                    ok, ids, place = ok[take], ids[take], place[take]
                cols = [pa.array(ids), pa.array(place), _longs(anchor[ok]), _longs(content[ok])]
                names = ["doc", "place", "anchor", "block"]
                if with_windows:
                    sizes = n[ok]
                    base = np.repeat(ends[ok] - sizes, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    raw = windows[base.astype(np.int64)].tobytes()
                    edges = np.append(0, np.cumsum(sizes * 8)).astype(np.int32)
                    cols.append(pa.Array.from_buffers(pa.binary(), ok.size, [None, pa.py_buffer(edges), pa.py_buffer(raw)]))
                    names.append("windows")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks clustered by anchor -> doc, digest, first word of each window that starts earlier in another block."""
    held: list[pa.RecordBatch] = []

    def resolve(t: pa.Table):
        anchor = t["anchor"].to_numpy()
        place, doc = t["place"].to_numpy(), t["doc"].to_numpy()
        n = (place & 15) + 1
        wins = np.frombuffer(b"".join(t["windows"].to_pylist()), U64)
        k = np.arange(wins.size) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(place >> 36, n) + k
        digest, doc = np.repeat((place >> 4) & 0xFFFFFFFF, n), np.repeat(doc, n)
        anchor = np.repeat(anchor, n)
        order = np.lexsort((digest, start, doc, wins, anchor))
        again = np.zeros(order.size, bool)
        a, w = anchor[order], wins[order]
        again[1:] = (a[1:] == a[:-1]) & (w[1:] == w[:-1])
        late = order[again]
        return pa.RecordBatch.from_arrays([pa.array(doc[late]), pa.array(digest[late]), pa.array(start[late])], ["doc", "digest", "start"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        anchor = batch.column("anchor").to_numpy()
        cut = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if (anchor != anchor[-1]).any() else 0
        if cut:
            whole = pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
            held = [batch.slice(cut)]
            yield resolve(whole)
        elif len(held) > 1 and held[0].column("anchor")[0].as_py() != anchor[-1]:
            yield resolve(pa.Table.from_batches(held[:-1]))
            held = [batch]
    if held:
        yield resolve(pa.Table.from_batches(held))


def _filter_bits(spark, repeated: DataFrame):
    """A broadcast bit filter of the repeated anchors, or None if there are so many that it would let most pass."""
    n = repeated.count()
    size = 1 << max(12, (16 * n - 1).bit_length())
    if size > MOST_BITS:
        return None

    def bit_rows(batches):
        for b in batches:
            h = b.column("anchor").to_numpy().view(U64)
            both = np.concatenate([h, mix(h)]) & U64(size - 1)
            word, at = np.unique(both >> U64(6), return_inverse=True)
            mask = np.zeros(word.size, U64)
            np.bitwise_or.at(mask, at, U64(1) << (both & U64(63)))
            yield pa.RecordBatch.from_arrays([_longs(word), _longs(mask)], ["word", "mask"])

    rows = repeated.select("anchor").mapInArrow(bit_rows, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    bits = np.zeros(size // 64, U64)
    got = rows.toArrow()
    bits[got["word"].to_numpy()] = got["mask"].to_numpy().view(U64)
    return spark.sparkContext.broadcast(bits)


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc, digest, ranges: for each document with a repeat, word ranges covered by windows that start earlier elsewhere.

    doc: the id, null as the smallest long; digest: 32 bits of the text's hash; ranges: start << 32 | words, unsorted.
    """
    if not GRAM <= length <= GRAM + 15:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 15}")
    spark = docs.sparkSession
    rows = _keyed(docs, id_col, text_col).select("doc_id", "digest", "text")
    anchors = rows.select("text").mapInArrow(_anchor_rows(length), "anchor long, n long")
    repeated = materialize(anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors")
    bits = _filter_bits(spark, repeated)

    shape = "doc long, place long, anchor long, block long"
    every = rows.mapInArrow(_block_rows(length, bits, False), shape)
    seeds = rows.mapInArrow(_block_rows(length, bits, True), f"{shape}, windows binary")
    first = seeds.groupBy("anchor", "block").agg(F.min(F.struct("doc", "place")).alias("first"), F.first("windows").alias("windows"))
    first = materialize(first.select("anchor", "block", "first.doc", "first.place", "windows"), "blocks")

    lead = first.select("anchor", "block", F.col("doc").alias("first_doc"), F.col("place").alias("first_place"))
    later = every.join(lead, ["anchor", "block"]).where("doc <> first_doc or place <> first_place")
    whole = later.select("doc", _digest("place"), F.shiftright("place", 36).alias("start"), (F.col("place").bitwiseAND(15) + length).alias("words"))

    sizes = first.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    sizes = materialize(sizes, "anchor-sizes")
    hot = sizes.where(F.col("n") > BLOCKS_IN_MEMORY).select("anchor")
    n_hot = hot.count()
    several = first.join(sizes.select("anchor"), "anchor", "left_semi")
    cold = several.join(F.broadcast(hot) if n_hot <= 1_000_000 else hot, "anchor", "left_anti") if n_hot else several
    parts = cold.select("anchor", "doc", "place", "windows").repartition("anchor").sortWithinPartitions("anchor")
    edges = parts.mapInArrow(_extended, "doc long, digest long, start long")
    if n_hot:
        wide = several.join(F.broadcast(hot) if n_hot <= 1_000_000 else hot, "anchor", "left_semi")
        edges = edges.unionByName(_hot_edges(wide))
    edges = edges.withColumn("words", F.lit(length).cast("long"))
    ranges = whole.unionByName(edges).groupBy("doc", "digest").agg(F.collect_list(F.shiftleft("start", 32).bitwiseOR(F.col("words"))).alias("ranges"))
    return ranges


def _digest(place: str):
    return F.shiftright(place, 4).bitwiseAND(0xFFFFFFFF).alias("digest")


def _hot_edges(blocks: DataFrame) -> DataFrame:
    """As ``_extended``, by an aggregation and a join: no task holds an anchor's blocks."""
    k = F.explode(F.sequence(F.lit(0), F.col("place").bitwiseAND(15).cast("int")))
    rows = blocks.select("anchor", "doc", "place", "windows", k.alias("k"))
    rows = rows.select("anchor", F.expr("substring(windows, k * 8 + 1, 8)").alias("window"), "doc", _digest("place"), (F.shiftright("place", 36) + F.col("k")).alias("start"))
    least = rows.groupBy("anchor", "window").agg(F.min(F.struct("doc", "start", "digest")).alias("least"))
    late = rows.join(least, ["anchor", "window"]).where(F.struct("doc", "start", "digest") != F.col("least"))
    return late.select("doc", "digest", "start")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    return docs.select(key.alias("doc_id"), F.xxhash64(text).bitwiseAND(0xFFFFFFFF).alias("digest"), text.alias("text"), *more)


def _kept(with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digest, texts = [], [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges")):
                raw = text.as_buffer().to_pybytes()
                words = raw.split()
                if ranges.is_valid:
                    r = ranges.values.to_numpy()
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, r >> 32, 1)
                    np.add.at(change, (r >> 32) + (r & 0xFFFFFFFF), -1)
                    gone = np.cumsum(change[:-1]) > 0
                    kept = [w for w, g in zip(words, gone) if not g]
                else:
                    kept = words
                joined = b" ".join(kept)
                total.append(len(words))
                removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(joined).hexdigest())
                texts.append(joined.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(texts, pa.string())], ["row", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """The columns of ``docs`` but its text, in a struct ``row``, with n_words, n_removed, kept_sha256 and kept_text.

    A word goes if it lies in a window of ``length`` words whose sequence also starts earlier: in a smaller id (null ids
    first), or earlier in the same document.  Rows that repeat an id and its text are one document; other rows that
    share an id are told apart by their text, and order by where the window starts.  Null texts have no words, texts
    shorter than a window lose none.  ``kept_text`` (null unless ``with_text``) joins what stays by one space.
    """
    ranges = repeated_ranges(docs, id_col, text_col, length)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    rows = _keyed(docs, id_col, text_col, others)
    joined = rows.join(ranges.withColumnRenamed("doc", "doc_id"), ["doc_id", "digest"], "left").select("row", "text", "ranges")
    shape = joined.select("row").schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string").add("kept_text", "string")
    return joined.mapInArrow(_kept(with_text), shape)
