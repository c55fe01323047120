"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has one or more 64-bit words.  The trie over all fingerprints is traversed in pairs of nodes: a pair adds
up the bits in which its prefixes differ and is dropped as soon as an error budget is exceeded.  The bits are read from
each of several rotations in turn, and a ``Scheme`` says how many errors a prefix may have: with a small budget for the
first bits, the trie is pruned where it is widest.  Two fingerprints that differ in at most 3 of 64 bits agree on one of
four blocks, so with four rotations a budget of 0 in front is exact; ``NEAR`` is for larger distances, and what it may
miss is said there.

The top levels are dealt out: a task is a pair of nodes at a depth where a node has about ``NODE_ROWS`` fingerprints,
and pairs that hold more go on splitting by eight more bits, so no task holds an unbounded group.  Inside a task the
traversal goes on in numpy, all pairs of a level at once.  Links are reduced to a spanning forest before they leave a
task, so a group of n near copies gives at most n rows a task and not n squared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import lean, materialize
from tidewatch.llm.components import least_reachable
from tidewatch.llm.shingles import alike, fingerprint_rows, may_be_alike, set_rows
from tidewatch.llm.textkernel import U64, mix, text_buffer

SEED = 42
NODE_ROWS = 16_384
BROADCAST_ROWS = 1_000_000
STEP_BITS = 8
_FRONTIER = 1 << 18
_HELD_BYTES = 64 << 20
_SMALL = 64


@dataclass(frozen=True)
class Scheme:
    """Rotations by ``step`` bits, and the most errors of a prefix: (depth, errors), deeper entries later."""

    words: int
    step: int
    budgets: tuple[tuple[int, int], ...]

    @property
    def turns(self) -> int:
        return 64 * self.words // self.step

    @property
    def max_bits(self) -> int:
        return self.budgets[-1][1]

    def most(self, depth: int) -> int:
        return next((errors for d, errors in self.budgets if d >= depth), self.max_bits)


#: At most 3 of 64 bits: exact.
EXACT = Scheme(1, 16, ((16, 0), (64, 3)))
#: 256 bits of which 15 of 100 differ at a Jaccard similarity of 0.8: 99.8 of 100 such pairs have one of 32 rotations that
#: keeps to the budgets, nearly all above it; of random pairs 1 in 2,000 does for 32 bits, none for all.
NEAR = Scheme(4, 8, ((8, 0), (16, 2), (24, 4), (32, 5), (256, 64)))


def _fingerprint(text: bytes, shingle_words: int, words: int) -> np.ndarray:
    parts = text.lower().split()
    if not parts:
        return np.zeros(words, U64)
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(shingle_words, len(parts))
    n = len(parts) - k + 1
    counts = np.zeros(64 * words, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 16):
        a, b = starts[i : min(n, i + (1 << 16))], ends[i + k - 1 : min(n, i + (1 << 16)) + k - 1]
        h = np.fromiter((digest(joined[x:y], SEED) for x, y in zip(a.tolist(), b.tolist())), U64, a.size)
        for w in range(words):
            counts[64 * w : 64 * w + 64] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            h = mix(h + U64(0x9E3779B97F4A7C15)) if w + 1 < words else h
    return np.packbits(2 * counts > n, bitorder="little").view(U64)


def _fingerprint_rows(shingle_words: int, words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, words), U64)
            for i, text in enumerate(batch.column("text")):
                if text.is_valid:
                    found[i] = _fingerprint(text.as_buffer().to_pybytes(), shingle_words, words)
            names = [*batch.schema.names[1:], *[f"f{w}" for w in range(words)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(found[:, w].view(np.int64)) for w in range(words)]], names)

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, words: int = 1) -> DataFrame:
    """id, digest and fingerprint words f0, f1, ... (longs) of every row; digest: the text's 64-bit hash.

    Shingles are ``shingle_words`` lower-cased (A-Z) words joined by a space, repeats included, hashed by XXH64 with
    seed 42; the later words of a fingerprint take mixed hashes.  A bit is set if it is in over half of them.  A shorter
    text is one shingle; a text without words, empty or null, has the fingerprint zero.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(text.alias("text"), F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("digest"))
    shape = "id long, digest long, " + ", ".join(f"f{w} long" for w in range(words))
    return rows.mapInArrow(_fingerprint_rows(shingle_words, words), shape)


def rotate(values: np.ndarray, by: int) -> np.ndarray:
    """Rows of 64-bit words as one number, rotated left by ``by`` bits."""
    words = values.shape[1]
    skip, bits = divmod(by, 64)
    v = np.roll(values, -skip, axis=1)
    if not bits:
        return v
    after = np.roll(v, -1, axis=1) if words > 1 else v
    return (v << U64(bits)) | (after >> U64(64 - bits))


def _pairs_within(link, left, right, errs, values, scheme, depth, same):
    """Links index pairs of ``values`` (rotated, sorted by the first word in each node) within the scheme's budgets.

    left, right: node intervals (low, high), pairwise; errs: bits in which they differ so far; same: left is right.
    """
    max_bits, most = scheme.max_bits, np.array([scheme.most(d) for d in range(66)])
    stack = [(left[0], left[1], right[0], right[1], errs, same, np.full(errs.size, depth))]
    head = values[:, 0]
    while stack:
        a0, a1, b0, b1, e, s, d = stack.pop()
        if a0.size > _FRONTIER:
            for i in range(0, a0.size, _FRONTIER):
                k = slice(i, i + _FRONTIER)
                stack.append((a0[k], a1[k], b0[k], b1[k], e[k], s[k], d[k]))
            continue
        na, nb = a1 - a0, b1 - b0
        done = (na * nb <= _SMALL) | (d >= 64)
        if done.any():
            x0, y0, m, n, same_node = a0[done], b0[done], na[done], nb[done], s[done]
            for i in range(0, x0.size, 1 << 15):
                k = slice(i, i + (1 << 15))
                size = m[k] * n[k]
                if size.max(initial=0) > _FRONTIER:  # equal first words: row by row
                    for p, q, mm, nn, t in zip(x0[k], y0[k], m[k], n[k], same_node[k]):
                        for r in range(mm):
                            low = q + (r + 1 if t else 0)
                            near = np.bitwise_count(values[low : q + nn] ^ values[p + r]).sum(1) <= max_bits
                            hit = low + np.flatnonzero(near)
                            link(np.full(hit.size, p + r), hit)
                    continue
                at = np.repeat(np.arange(size.size), size)
                within = np.arange(at.size) - np.repeat(np.cumsum(size) - size, size)
                u, v = x0[k][at] + within // n[k][at], y0[k][at] + within % n[k][at]
                ok = ~same_node[k][at] | (u < v)
                u, v = u[ok], v[ok]
                near = np.bitwise_count(values[u] ^ values[v]).sum(1) <= max_bits
                link(u[near], v[near])
            go = ~done
            a0, a1, b0, b1, e, s, d = (z[go] for z in (a0, a1, b0, b1, e, s, d))
        if not a0.size:
            continue
        bit = U64(1) << (U64(63) - d.astype(U64))
        am, bm = _split(head, a0, a1, bit), _split(head, b0, b1, bit)
        d = d + 1
        parts = []
        for x0, x1, y0, y1, more in ((a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)):
            ee = e + more
            ok = (x0 < x1) & (y0 < y1) & (ee <= most[d])
            if more and x0 is am:
                ok &= ~s
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], ee[ok], s[ok] & (more == 0), d[ok]))
        stack.append(tuple(np.concatenate(z) for z in zip(*parts)))


def _split(head: np.ndarray, low: np.ndarray, high: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Of sorted intervals that agree above ``bit``, where that bit becomes one: all bisected together."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        one = (head[np.minimum(mid, head.size - 1)] & bit) > 0
        high = np.where(open_ & one, mid, high)
        low = np.where(open_ & ~one, mid + 1, low)
    return low


class Forest:
    """Smallest index that each of n nodes reaches over the links so far, and links that suffice for that."""

    def __init__(self, n: int):
        self.root, self.kept, self.size, self.links = np.arange(n), [], 0, []

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        if u.size:
            self.kept.append((u, v))
            self.size += u.size
            if self.size > _FRONTIER:
                self.settle()

    def settle(self) -> np.ndarray:
        if self.kept:
            u, v = (np.concatenate(x) for x in zip(*self.kept))
            self.kept, self.size = [], 0
            root = self.root
            while u.size:
                a, b = root[u], root[v]
                open_ = a != b
                u, v, a, b = u[open_], v[open_], a[open_], b[open_]
                high, first = np.unique(np.maximum(a, b), return_index=True)  # each root hooks to one smaller root
                self.links.append((u[first], v[first]))
                root[high] = np.minimum(a, b)[first]
                while ((up := root[root]) != root).any():
                    root[:] = up
        return self.root

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *x]) for x in (zip(*self.links) if self.links else ((), ())))


class Across:
    """All links between nodes of different groups whose sets may have the similarity."""

    def __init__(self, group: np.ndarray, size: np.ndarray, maps: tuple[np.ndarray, np.ndarray, np.ndarray], similarity: float):
        self.group, self.size, self.maps, self.similarity, self.kept = group, size, maps, similarity, []

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        open_ = self.group[u] != self.group[v]
        u, v = u[open_], v[open_]
        if u.size and (ok := may_be_alike(u, v, self.size, self.maps, self.similarity)).any():
            self.kept.append(np.stack([u[ok], v[ok]], 1))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        both = np.concatenate([np.zeros((0, 2), np.int64), *self.kept])
        return both[:, 0], both[:, 1]


def _task_rows(scheme: Scheme, across: float) -> Callable:
    names = [f"f{w}" for w in range(scheme.words)]

    def solve(t: dict):
        n = t["side"].size
        values = np.stack([t[f] for f in names], 1).view(U64)
        turn = t["turn"]
        rotated = np.empty_like(values)
        for r in np.unique(turn):
            k = turn == r
            rotated[k] = rotate(values[k], int(r) * scheme.step)
        # rows are grouped by task, side after side; each side sorted by its rotated first word
        keys = np.stack([turn, t["depth"], t["a"], t["b"], t["side"]], 1)
        order = np.lexsort((rotated[:, 0], keys[:, 4], keys[:, 3], keys[:, 2], keys[:, 1], keys[:, 0]))
        keys, rotated, errs = keys[order], rotated[order], t["errs"][order]
        new = np.ones(n, bool)
        new[1:] = (keys[1:] != keys[:-1]).any(1)
        low = np.flatnonzero(new)
        high = np.append(low[1:], n)
        first = keys[low]
        mate = np.zeros(low.size, bool)
        mate[:-1] = (first[1:, :4] == first[:-1, :4]).all(1)
        own = first[:, 2] == first[:, 3]
        a = np.flatnonzero(own | mate)
        b = np.where(own[a], a, np.minimum(a + 1, low.size - 1))
        if across:
            data, offs = text_buffer(t["map"])
            maps = (np.ascontiguousarray(data).view(U64), offs[:-1][order] >> 3, np.diff(offs)[order] >> 3)
            found = Across(t["root"][order], t["size"][order], maps, across)
        else:
            found = Forest(n)
        for depth in np.unique(first[a, 1]):
            here = first[a, 1] == depth
            k, m = a[here], b[here]
            _pairs_within(found.link, (low[k], high[k]), (low[m], high[m]), errs[low[k]].astype(np.int64), rotated, scheme, int(depth), own[k])
        u, v = found.pairs()
        node = t["node"][order]
        both = np.stack([np.maximum(node[u], node[v]), np.minimum(node[u], node[v])], 1)
        both = np.unique(both, axis=0) if across else both
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush(parts):
            t = pa.Table.from_batches(parts)
            return solve({c: t[c].combine_chunks() if c == "map" else t[c].to_numpy() for c in t.column_names})

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < 4 * NODE_ROWS and sum(b.nbytes for b in held) < _HELD_BYTES:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            key = np.stack([t[c].to_numpy() for c in ("turn", "depth", "a", "b")], 1)
            cut = np.flatnonzero((key != key[-1]).any(1))
            if cut.size:
                end = int(cut[-1]) + 1
                yield flush(t.slice(0, end).to_batches())
                held = t.slice(end).to_batches()
                rows = t.num_rows - end
            else:
                held = t.to_batches()
        if held:
            yield flush(held)

    return run


def _rotated_bits(scheme: Scheme, turn: int, depth: int, bits: int) -> Column:
    """Bits depth .. depth + bits of the fingerprint rotated by ``turn`` steps, as a long."""
    out, done = F.lit(0).cast("long"), 0
    while done < bits:  # a piece for each word that they lie in
        word, at = divmod((turn * scheme.step + depth + done) % (64 * scheme.words), 64)
        many = min(bits - done, 64 - at)
        piece = F.shiftrightunsigned(f"f{word}", 64 - at - many).bitwiseAND(F.lit((1 << many) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(piece, bits - done - many))
        done += many
    return out


def _tasks(nodes: DataFrame, scheme: Scheme, depth: int) -> DataFrame:
    """A row for each fingerprint, rotation and pair of nodes at ``depth`` that it takes part in."""
    own = F.array(*[F.struct(F.lit(turn).alias("turn"), _rotated_bits(scheme, turn, 0, depth).alias("_p")) for turn in range(scheme.turns)])
    rows = nodes.select("*", F.inline(own))
    return _spread(rows.withColumns({"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long"), "errs": F.lit(0), "side": F.lit(0), "depth": F.lit(0)}), 0, depth, scheme)


def _spread(rows: DataFrame, depth: int, bits: int, scheme: Scheme) -> DataFrame:
    """Each node pair's rows go from ``depth`` to its pairs of children ``bits`` levels below; ``_p``: a row's own bits there."""
    after = F.lit(depth + bits)
    most = scheme.most(depth + bits)
    limit = F.lit(most)
    inside = [(depth + bits - d, errors) for d, errors in scheme.budgets if depth < d < depth + bits]  # budgets that end within this step
    masks = [m for m in range(1 << bits) if m.bit_count() <= most and all((m >> rest).bit_count() <= errors for rest, errors in inside)]
    table = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("c")) for m in masks])
    if len(masks) == 1:
        out = rows.withColumns({"_m": F.lit(0).cast("long"), "_c": F.lit(0)})
    else:
        out = rows.select("*", F.inline(table).alias("_m", "_c"))
    mine, theirs = F.col("_p"), F.col("_p").bitwiseXOR(F.col("_m"))
    one = F.col("a") == F.col("b")
    left = F.when(one, F.least(mine, theirs)).when(F.col("side") == 0, mine).otherwise(theirs)
    right = F.when(one, F.greatest(mine, theirs)).when(F.col("side") == 0, theirs).otherwise(mine)
    side = F.when(one, F.when(mine <= theirs, 0).otherwise(1)).otherwise(F.col("side"))
    grow = lambda parent, child: (F.shiftleft(parent, bits) + child)
    out = out.where(F.col("errs") + F.col("_c") <= limit)
    out = out.withColumns({"_l": grow(F.col("a"), left), "_r": grow(F.col("b"), right), "side": side, "errs": F.col("errs") + F.col("_c"), "depth": after})
    return out.drop("a", "b", "_m", "_c", "_p").withColumnsRenamed({"_l": "a", "_r": "b"})


def near_links(nodes: DataFrame, scheme: Scheme = EXACT, across: float = 0.0) -> DataFrame:
    """u, v (nodes): a spanning forest of each task's links between fingerprints within the scheme's budgets.

    nodes: node (long, unique), f0, f1, ... ; distinct fingerprints if the scheme's distance is to be the only link.
    The transitive closure of the result is that of all links.  ``across``: instead, all links between nodes of
    different ``root`` whose sets may have this Jaccard similarity, as told by ``size`` and ``map`` (columns of nodes).
    """
    n = nodes.count()
    depth = min(scheme.budgets[0][0], max(0, (max(n, 1) // NODE_ROWS).bit_length()))
    if not scheme.budgets[0][1]:
        depth = min(scheme.budgets[0][0], max(depth, STEP_BITS))
    rows = _tasks(nodes, scheme, depth)
    key, more = ["turn", "depth", "a", "b"], ["root", "size", "map"] if across else []
    links = None
    while True:
        sizes = rows.groupBy(*key).agg(F.count("*").alias("n"))
        large = materialize(sizes.where(F.col("n") > 4 * NODE_ROWS).select(*key), "trie-nodes")
        some = depth + STEP_BITS <= 48 and large.count() > 0
        light = rows.join(large, key, "left_anti") if some else rows
        shape = light.repartition(*key).sortWithinPartitions(*key)
        got = shape.select(*key, "side", "errs", "node", *more, *[f"f{w}" for w in range(scheme.words)]).mapInArrow(lean(_task_rows(scheme, across)), "u long, v long")
        links = got if links is None else links.unionByName(got)
        if not some:
            return links
        heavy = rows.join(large, key, "left_semi")
        bits = F.lit(0).cast("long")
        for turn in range(scheme.turns):
            bits = F.when(F.col("turn") == turn, _rotated_bits(scheme, turn, depth, STEP_BITS)).otherwise(bits)
        left = F.col("side") == 0
        there = heavy.select("turn", (F.shiftleft(F.when(left, F.col("a")).otherwise(F.col("b")), STEP_BITS) + bits).alias("_other")).distinct()
        rows = _spread(heavy.withColumn("_p", bits), depth, STEP_BITS, scheme)
        rows = rows.withColumn("_other", F.when(left, F.col("b")).otherwise(F.col("a"))).join(there, ["turn", "_other"], "left_semi").drop("_other")
        rows = materialize(rows, "trie-rows")
        depth += STEP_BITS


def _named(marked: DataFrame, nodes: DataFrame, roots: DataFrame, on: list[str]) -> DataFrame:
    """marked (id, digest, ..) with the smallest id of its component, and whether it is the row that has it."""
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("least").alias("least"))
    named = placed.select(*on, "root").join(least, "root").select(*on, "least")
    return marked.join(named, on).withColumns({"component_id": F.col("least.id"), "first": rank == F.col("least")}).drop("least")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, scheme: Scheme = EXACT) -> DataFrame:
    """One row per input row: id, digest, f0, f1, ..., component_id, first.

    Rows whose fingerprints differ in at most the scheme's bits are linked; component_id is the smallest id that can be
    reached, a row's own included (null if no row of the component has an id).  ``first`` marks the row that stands for
    its component: the one with that id, and of rows that share it the one with the smallest digest.  Texts of any
    length are read whole, null ones as empty; an empty table gives no rows; other columns are ignored.
    """
    names = [f"f{w}" for w in range(scheme.words)]
    marked = materialize(fingerprints(docs, id_col, text_col, shingle_words, scheme.words), "fingerprints")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    nodes = marked.groupBy(*names).agg(F.min(rank).alias("least"))
    nodes = nodes.withColumn("node", F.col("f0") if scheme.words == 1 else F.monotonically_increasing_id())
    nodes = materialize(nodes.select("node", *names, "least"), "nodes")
    roots = least_reachable(near_links(nodes.drop("least"), scheme))
    return _named(marked, nodes, roots, names).select("id", "digest", *names, "component_id", "first")


def bits_for_similarity(similarity: float, bits: int) -> int:
    """The most differing bits at which fingerprints still say that shingle sets overlap by ``similarity`` (Jaccard).

    Sets of one size with Jaccard J have cosine 2J / (1 + J), and a bit differs with the angle's share of 180 degrees.
    """
    return int(bits * np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8, scheme: Scheme = NEAR) -> DataFrame:
    """One row per input row: id, digest, component_id, first; as ``near_groups``, linked by Jaccard similarity.

    Candidates are pairs whose fingerprints of sets of shingles are within the scheme's budgets; a pair is linked if the
    sets' exact similarity is ``similarity`` or more.  First each task's candidates at the distance that the similarity
    stands for are reduced to a spanning forest, and its pairs are checked; then all candidates between groups that are
    still apart, but for those that the sets' parity maps rule out where candidates are found, which drops none that is
    similar enough.  So n near copies cost about n comparisons of sets a rotation, and not n squared, unless most of
    their pairs lie just below the similarity.

    A text of fewer words than a shingle is one shingle; rows without words, empty or null, are one component.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    names = [f"f{w}" for w in range(scheme.words)]
    shape = "id long, digest long, node long, " + ", ".join(f"{c} long" for c in names) + ", size long, map binary"
    marked = materialize(rows.mapInArrow(lean(fingerprint_rows(shingle_words, scheme.words)), shape), "near-marks")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    # equal sets are one node, and one of its rows gives its text
    nodes = marked.groupBy("node").agg(F.min(rank).alias("least"), *[F.min(c).alias(c) for c in (*names, "size", "map")])
    nodes = materialize(nodes, "near-nodes")
    close = Scheme(scheme.words, scheme.step, (*scheme.budgets[:-1], (scheme.budgets[-1][0], bits_for_similarity(similarity, 64 * scheme.words))))
    forest = materialize(near_links(nodes.drop("least", "size", "map"), close).distinct(), "near-forest")
    sets = materialize(_sets_of(rows, nodes, forest, shingle_words), "near-sets")
    links = materialize(alike(forest, sets, similarity), "near-links")
    roots = least_reachable(links)
    apart = nodes.drop("least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    pairs = near_links(materialize(apart, "near-apart"), scheme, similarity).distinct().join(forest, ["u", "v"], "left_anti")
    pairs = materialize(pairs, "near-pairs")
    known = sets.select("node")
    sets = sets.unionByName(_sets_of(rows, nodes.join(known, "node", "left_anti"), pairs, shingle_words))
    roots = least_reachable(links.unionByName(materialize(alike(pairs, sets, similarity), "near-links")))
    return _named(marked, nodes, roots, ["node"]).select("id", "digest", "component_id", "first")


def _sets_of(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle_words: int) -> DataFrame:
    """node, set of the nodes in ``pairs``, from the text of one row each."""
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    chosen = nodes.join(wanted, "node", "left_semi").select(F.col("least.digest").alias("_digest"), F.col("least.id").alias("_id"))
    texts = rows.join(chosen, (rows["digest"] == F.col("_digest")) & rows["id"].eqNullSafe(F.col("_id")), "left_semi").select("text")
    return texts.mapInArrow(lean(set_rows(shingle_words)), "node long, set array<long>").dropDuplicates(["node"])


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each group of near-duplicates the one with the smallest id.

    Two rows are linked if the Jaccard similarity of their sets of 5-word shingles is ``similarity`` or more, and linked
    rows form groups; see ``similar_groups``.  Rows without words are one group.  Rows that repeat both id and text are
    one document and stay or go together.
    """
    groups = similar_groups(docs, id_col, text_col, shingle_words, similarity)
    gone = materialize(groups.where("not first").select(F.col("id").alias("_gone_id"), F.col("digest").alias("_gone_digest")).distinct(), "near-gone")
    same = docs[f"`{id_col}`"].cast("long").eqNullSafe(gone["_gone_id"]) & (F.xxhash64(F.coalesce(docs[f"`{text_col}`"], F.lit(""))) == gone["_gone_digest"])
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, same, "left_anti")
