"""Repeated byte strings by interval expansion on Burrows-Wheeler transforms.

Texts are cut into blocks: of the grams in a string of ``length`` bytes the smallest hash, leftmost, is its anchor, and
consecutive strings of the same anchor are a block.  Equal strings have equal anchors, so a set of blocks that has all
blocks of its anchors has all partners of its strings, and each such set is searched by itself.

1. Anchors are counted; a bit filter of bounded size has those that occur twice.  It only spares work.
2. Blocks that pass are counted by anchor and content, with map-side combination, and one occurrence of each stands for
   all: a group of copies is one block of a weight.  An anchor of more than ``MOST_BLOCKS`` different blocks, say a
   common line in many surroundings, is cut at every string instead, and the strings' hashes take its place.
3. The blocks that stand for others are dealt out by anchor and sorted; ``repeated`` builds the transform of about
   ``SHARD_BYTES`` of them at a time.  Backward extension, breadth first, finds the boundaries of common prefixes of 7, 8,
   .. bytes and stops at ``length``; what no boundary parts shares ``length`` bytes, and is a repeat if it weighs 2 or more.
4. What is repeated in a block is so in all its occurrences; their ranges are gathered for each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize
from tidewatch.llm.textkernel import U64, chunks, distinct, mix, powers

LENGTH = 200
GRAM = 48
#: Bytes that are cut at once; a place within them takes 20 bits.
SEGMENT = 1 << 19
#: A filter has 32 bits for each key, and never more than this many: 64 MB.
MOST_BITS = 1 << 29
_PAGE = 1 << 16
MOST_BLOCKS = 5_000
SHARD_BYTES = 1 << 18
#: Symbols of 9 bits that a sort key holds.
_PACKED = 7
_NO_ID = -(1 << 63)


def _gram(length: int) -> int:
    return max(1, min(GRAM, length // 4))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive keys, by doubling."""
    span = 1
    while 2 * span <= width:
        keys, span = np.minimum(keys[:-span], keys[span:]), 2 * span
    return np.minimum(keys[: keys.size - (width - span)], keys[width - span :]) if span < width else keys


def _find(keys: np.ndarray | None, wanted: np.ndarray) -> np.ndarray:
    if keys is None or not keys.size:
        return np.zeros(wanted.size, bool)
    return keys[np.minimum(np.searchsorted(keys, wanted), keys.size - 1)] == wanted


def cut(data: np.ndarray, offs: np.ndarray, length: int, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Of each block: its first byte, how many strings start in it, anchor and content hash; it has n + length - 1 bytes.

    Anchors in ``hot`` (sorted) give a block for each string, whose hash is then the anchor.
    """
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64))]
    gram = _gram(length)
    row_of = np.repeat(np.arange(offs.size - 1, dtype=np.int32), np.diff(offs))
    for low in range(0, data.size - length + 1, SEGMENT):
        part, row = data[low : low + SEGMENT + length - 1], row_of[low : low + SEGMENT + length - 1]
        s = np.flatnonzero(row[: part.size - length + 1] == row[length - 1 :])
        if not s.size:
            continue
        p, q = powers(part.size + 1)
        sums = np.zeros(part.size + 1, U64)
        np.cumsum((part.astype(U64) + U64(1)) * p[: part.size], out=sums[1:])
        i = part.size - gram + 1
        grams = mix((sums[gram:] - sums[:i]) * q[:i])
        best = _least((grams >> U64(20) << U64(20)) | np.arange(i, dtype=U64), length - gram + 1)[s]
        at = (best & U64((1 << 20) - 1)).astype(np.int64)
        new = np.ones(s.size, bool)
        new[1:] = (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)
        if hot is not None:
            new |= _find(hot, grams[at])
        k = np.flatnonzero(new)
        n, first, anchor = np.diff(np.append(k, s.size)), s[k], grams[at[k]]
        content = mix((sums[first + n + length - 1] - sums[first]) * q[first] + n.astype(U64))
        if hot is not None:
            anchor = np.where(_find(hot, anchor), mix(content ^ mix(anchor)), anchor)
        out.append((low + first, n, anchor, content))
    return tuple(np.concatenate(x) for x in zip(*out))


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, the place of each, and of neighbours in order the common prefix up to ``_PACKED`` symbols.

    A symbol 0 stands at ``ends``, behind each block; suffixes end there, and equal ones go by their place.
    """
    n = symbols.size
    left = np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(n)
    key = np.zeros(n, np.int64)
    for j in range(_PACKED):
        key <<= 9
        to = max(n - j, 0)
        key[:to] |= np.where(left[:to] >= j, symbols[j:], 0)
    order = np.argsort(key)
    packed = key[order]
    new = np.ones(n + 1, bool)
    new[1:-1] = packed[1:] != packed[:-1]
    start = np.flatnonzero(new[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    known, bits = _PACKED, int(n).bit_length()
    times = 3 if 3 * bits < 64 else 2
    longest = int(left.max()) + 1
    while (slots := np.flatnonzero(~(new[:-1] & new[1:]))).size:
        open_ = order[slots]
        if known >= longest:
            order[slots] = open_[np.argsort(rank[open_] << 32 | open_)]
            break
        key = rank[open_]
        for j in range(1, times):
            key = key << bits | np.where(left[open_] >= j * known, rank[np.minimum(open_ + j * known, n - 1)] + 1, 0)
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        order[slots] = open_
        fresh = np.ones(slots.size, bool)
        fresh[1:] = key[1:] != key[:-1]
        new[slots[fresh]] = True
        rank[open_] = np.maximum.accumulate(np.where(fresh, slots, 0))
        known *= times
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    differ, common = packed[1:] ^ packed[:-1], np.zeros(n, np.int64)
    for m in range(1, _PACKED + 1):
        common[1:] += (differ >> 9 * (_PACKED - m)) == 0
    common[1:] = np.minimum(common[1:], np.minimum(left[order[1:]], left[order[:-1]]))
    return order, place, common


def repeated(symbols: np.ndarray, ends: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` symbols from each place on, within one block, weigh 2 or more; as ``suffix_order`` takes them.

    ``bound[r]``: row r of the transform starts with another prefix than the row before it, of the length looked at or
    less.  An interval whose end became a boundary at one length is extended by each symbol that stands before it: the
    last row of a symbol maps to the last row of the longer prefix's interval, and a boundary is behind it.
    """
    n = symbols.size
    order, place, common = suffix_order(symbols, ends)
    first, before = symbols[order].astype(np.int64), symbols[order - 1]
    before[order == 0] = 0
    back, ahead = place[order - 1], place[np.where(order + 1 < n, order + 1, 0)]
    behind = np.minimum(back + 1, n - 1)
    after = np.where((back + 1 < n) & (first[behind] == before), ahead[behind], n)  # next row with the symbol
    live = np.where(before > 0, after, -1)
    table = first << 40 | ahead  # ascends: rows of a symbol are in the order of the rows that follow them
    table[: ends.size] = np.arange(ends.size)
    bound = np.append(common < min(_PACKED, length), True)
    edge = np.flatnonzero(bound)
    new = np.flatnonzero(common[edge[1:-1]] == _PACKED - 1) + 1
    low, high = edge[new - 1], edge[new]
    for _ in range(_PACKED, length):
        if not low.size:
            break
        size = high - low
        rows = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        last = np.flatnonzero(live[rows] >= np.repeat(high, size))
        low, rows = np.repeat(low, size)[last], rows[last]
        high = back[rows] + 1
        fresh = ~bound[high]
        low, rows, high = low[fresh], rows[fresh], high[fresh]
        bound[high] = True
        low = np.searchsorted(table, before[rows].astype(np.int64) << 40 | low)
    edge = np.flatnonzero(bound[:n])
    block = np.searchsorted(ends, order)
    total = np.add.reduceat(weights[block], edge)
    out = np.zeros(n, bool)
    out[order] = (np.repeat(total, np.diff(np.append(edge, n))) > 1) & (ends[block] - order >= length)
    return out


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64, copy=False).view(np.int64))


def _passes(bits: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(keys.size, bool)
    ok, size = np.ones(keys.size, bool), U64(bits.size * 64 - 1)
    for h in (keys, mix(keys)):
        b = h & size
        ok &= (bits[(b >> U64(6)).astype(np.int64)] >> (b & U64(63))) & U64(1) > 0
    return ok


def key_filter(keys: DataFrame):
    """A broadcast bit filter of the one long column of ``keys``: two bits a key, ``MOST_BITS`` in all at most.

    Tasks fill pages of 8 KB, so the driver gets the filter itself and no more.
    """
    spark = keys.sparkSession
    size = 1 << min(MOST_BITS.bit_length() - 1, max(_PAGE.bit_length() - 1, (32 * keys.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view(U64)
            both = distinct(np.concatenate([h, mix(h)]) & U64(size - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both // _PAGE), pa.array((both % _PAGE).astype(np.int32))], ["page", "bit"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, np.ndarray] = {}
        for batch in batches:
            page, bit = batch.column("page").to_numpy(), batch.column("bit").to_numpy().astype(np.int64)
            for k in np.unique(page).tolist():
                np.bitwise_or.at(mine.setdefault(k, np.zeros(_PAGE // 64, U64)), (own := bit[page == k]) >> 6, U64(1) << (own & 63).astype(U64))
        for k, words in mine.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([words.tobytes()], pa.binary())], ["page", "words"])

    got = keys.mapInArrow(places, "page long, bit int").repartition("page").mapInArrow(pages, "page long, words binary").toArrow()
    bits = np.zeros((size // _PAGE, _PAGE // 64), U64)
    for k, words in zip(got["page"].to_pylist(), got["words"].to_pylist()):
        bits[k] = np.frombuffer(words, U64)
    return spark.sparkContext.broadcast(bits.ravel())


def _scan(batches: Iterator[pa.RecordBatch], length: int, bits, hot):
    """Of each chunk: batch, its first row, bytes, and row, start in the row, first byte, strings, anchor, content of blocks that pass."""
    bits, hot = (x.value if x is not None else None for x in (bits, hot))
    for batch in batches:
        for a, _, data, offs in chunks(batch.column("text"), SEGMENT):
            first, n, anchor, content = cut(data, offs, length, hot)
            ok = np.flatnonzero(_passes(bits, anchor))
            row = np.searchsorted(offs, first[ok], "right") - 1
            yield batch, a, data, row, first[ok] - offs[row], first[ok], n[ok], anchor[ok], content[ok]


def _anchors(length: int, hot) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, anchor, _ in _scan(batches, length, None, hot):
            some, n = np.unique(anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([_longs(some), pa.array(n.astype(np.int64))], ["anchor", "n"])

    return run


def _where(batch: pa.RecordBatch, a: int, row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of where each block is: id, digest of the text, place in it."""
    doc, digest = (batch.column(c).to_numpy()[a + row].view(U64) for c in ("doc_id", "digest"))
    return mix(mix(mix(doc + U64(1)) ^ digest) + start.astype(U64))


def _counts(length: int, bits, hot) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, _, row, start, _, _, anchor, content in _scan(batches, length, bits, hot):
            at = _where(batch, a, row, start).view(np.int64)
            by = np.lexsort((at, content, anchor))
            x, y = anchor[by], content[by]
            lead = np.ones(by.size, bool)
            lead[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            n = np.diff(np.append(np.flatnonzero(lead), by.size))
            yield pa.RecordBatch.from_arrays([_longs(x[lead]), _longs(y[lead]), pa.array(n), pa.array(at[by][lead])], ["anchor", "content", "n", "at"])

    return run


def _contents(length: int, bits, hot, chosen) -> Callable:
    """The bytes of blocks that stand for others: those whose place passes the filter of the chosen ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, data, row, start, first, n, anchor, content in _scan(batches, length, bits, hot):
            ok = np.flatnonzero(_passes(chosen.value, _where(batch, a, row, start)))
            _, lead = np.unique(anchor[ok] ^ mix(content[ok]), return_index=True)
            ok = ok[lead]
            size = n[ok] + length - 1
            edges = np.append(0, np.cumsum(size))
            raw = data[np.repeat(first[ok] - edges[:-1], size) + np.arange(edges[-1])]
            body = pa.Array.from_buffers(pa.binary(), ok.size, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([_longs(anchor[ok]), _longs(content[ok]), pa.array(np.zeros(ok.size, np.int64)), body], ["anchor", "content", "n", "body"])

    return run


def _occurrences(length: int, bits, hot) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, _, row, start, _, _, anchor, content in _scan(batches, length, bits, hot):
            doc, digest = (batch.column(c).to_numpy()[a + row] for c in ("doc_id", "digest"))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(digest), pa.array(start), _longs(anchor), _longs(content)], ["doc_id", "digest", "start", "anchor", "content"])

    return run


def _ranges(starts: np.ndarray, length: int) -> np.ndarray:
    """Sorted places at which repeats start -> start << 32 | bytes of each run of consecutive ones, up to its last byte."""
    cuts = np.flatnonzero(np.diff(starts) != 1) + 1
    low, high = starts[np.append(0, cuts)], starts[np.append(cuts, starts.size) - 1]
    return low << 32 | (high - low + length)


def _searched(length: int, shard: int) -> Callable:
    """Blocks sorted by anchor and content, each with its body once or oftener and its count once -> what is repeated in them."""

    def search(t: pa.Table) -> pa.RecordBatch | None:
        anchor, content = t["anchor"].to_numpy(), t["content"].to_numpy()
        lead = np.ones(anchor.size, bool)
        lead[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
        weights = np.add.reduceat(t["n"].to_numpy(), np.flatnonzero(lead))
        body = t["body"].combine_chunks()
        group = np.cumsum(lead) - 1
        has = np.flatnonzero(body.is_valid().to_numpy(zero_copy_only=False))
        _, one = np.unique(group[has], return_index=True)
        rows = has[one]
        raw = body.take(pa.array(rows))
        _, offs, data = raw.buffers()
        edges = np.frombuffer(offs, np.int32)[: rows.size + 1].astype(np.int64)
        if not edges[-1]:
            return None
        size = np.diff(edges)
        symbols = np.zeros(int(edges[-1]) + rows.size, np.int16)
        ends = np.cumsum(size + 1) - 1
        inside = np.ones(symbols.size, bool)
        inside[ends] = False
        symbols[inside] = np.frombuffer(data, np.uint8)[: edges[-1]].astype(np.int16) + 1
        hit = np.flatnonzero(repeated(symbols, ends, weights[group[rows]], length))
        if not hit.size:
            return None
        # places of two blocks are parted by the ends, so runs don't join
        runs = _ranges(hit, length)
        of = np.searchsorted(ends, runs >> 32)
        runs -= (ends[of] - size[of]) << 32
        some, n = np.unique(of, return_counts=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(runs))
        return pa.RecordBatch.from_arrays([pa.array(anchor[rows[some]]), pa.array(content[rows[some]]), lists], ["anchor", "content", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            anchor = batch.column("anchor").to_numpy()
            turn = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            for low, high in zip(np.append(0, turn).tolist(), np.append(turn, anchor.size).tolist()):
                if size > shard and (low or held[-1].column("anchor")[-1].as_py() != int(anchor[0])):
                    if low > at:
                        held.append(batch.slice(at, low - at))
                    if (found := search(pa.Table.from_batches(held))) is not None:
                        yield found
                    held, size, at = [], 0, low
                size += batch.column("body").slice(low, high - low).nbytes
            if anchor.size > at:
                held.append(batch.slice(at))
        if held and (found := search(pa.Table.from_batches(held))) is not None:
            yield found

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID))
    return docs.select(key.alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"), *more)


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, digest, ranges: of each document with a repeat, byte ranges (lists of start << 32 | bytes) that cover it.

    doc_id: null as the smallest long; digest: XXH64 of the text.
    """
    if length < 2 * _PACKED:
        raise ValueError(f"length must be {2 * _PACKED} or more")
    spark = docs.sparkSession
    rows = _keyed(docs, id_col, text_col)

    def counted(hot):
        anchors = rows.select("text").mapInArrow(_anchors(length, hot), "anchor long, n long")
        twice = materialize(anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "suffix-anchors")
        bits = key_filter(twice)
        blocks = rows.mapInArrow(_counts(length, bits, hot), "anchor long, content long, n long, at long")
        return bits, materialize(blocks.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.min("at").alias("at")), "suffix-blocks")

    bits, blocks = counted(None)
    # a few in a million blocks: an anchor of that many blocks is 8 bytes here
    crowded = blocks.groupBy("anchor").agg(F.count("*").alias("blocks")).where(F.col("blocks") > MOST_BLOCKS).select("anchor").toArrow()
    hot = None
    if crowded.num_rows:
        hot = spark.sparkContext.broadcast(np.sort(crowded["anchor"].to_numpy().view(U64)))
        bits, blocks = counted(hot)
    chosen = key_filter(blocks.select("at"))
    bodies = rows.mapInArrow(_contents(length, bits, hot, chosen), "anchor long, content long, n long, body binary")
    both = bodies.unionByName(blocks.select("anchor", "content", "n", F.lit(None).cast("binary").alias("body")))
    dealt = both.repartition("anchor").sortWithinPartitions("anchor", "content")
    found = materialize(dealt.mapInArrow(_searched(length, SHARD_BYTES), "anchor long, content long, runs array<long>"), "suffix-repeats")
    every = rows.mapInArrow(_occurrences(length, bits, hot), "doc_id long, digest long, start long, anchor long, content long")
    runs = F.transform("runs", lambda r: r + F.shiftleft("start", 32))
    return every.join(found, ["anchor", "content"]).select("doc_id", "digest", runs.alias("runs")).groupBy("doc_id", "digest").agg(F.collect_list("runs").alias("ranges"))


def _kept(with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, spans, digest, texts = [], [], [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges")):
                raw = text.as_buffer().to_pybytes()
                kept, n = raw, 0
                if ranges.is_valid:
                    r = ranges.values.flatten().to_numpy()
                    change = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(change, r >> 32, 1)
                    np.add.at(change, (r >> 32) + (r & 0xFFFFFFFF), -1)
                    stay = np.cumsum(change[:-1]) == 0
                    n = int(np.count_nonzero(~stay & np.append(True, stay[:-1])))
                    kept = np.frombuffer(raw, np.uint8)[stay].tobytes()
                total.append(len(raw))
                removed.append(len(raw) - len(kept))
                spans.append(n)
                digest.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept if with_text else None)
            made = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *made], ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """The columns of ``docs`` but its text, in a struct ``row``, with n_bytes, n_removed, n_spans, kept_sha256 and kept.

    Texts are UTF-8 bytes.  A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the
    same text or another row's; strings are judged on the input, and all occurrences go, the first as well.  ``n_spans``
    counts the maximal runs that go; ``kept`` (null unless ``with_text``) has the bytes that stay, which may cut a
    character.  Null texts are empty, texts shorter than ``length`` lose nothing, rows that repeat an id and a text are
    copies of each other, and an empty table gives no rows.
    """
    ranges = repeated_ranges(docs, id_col, text_col, length)
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    joined = _keyed(docs, id_col, text_col, others).join(ranges, ["doc_id", "digest"], "left").select("row", "text", "ranges")
    shape = joined.select("row").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("kept", "binary")
    return joined.mapInArrow(_kept(with_text), shape)
