"""Ranked lexical search over term-partitioned postings, by the three phases of TPUT.

A posting is what a term adds to a document's score, so a score is a sum over lists, and a search wants the ``k`` largest.

1. Each list gives its ``k`` largest entries.  The documents that do best in an item's heads are looked up, and the k-th of
   their scores is a lower bound of what it takes.
2. One threshold holds for all of an item's lists, the largest with which the entries below it add up to less than that
   bound, each list by its own largest entry at most: a document below it in every list can't be among the k.  Lists give
   all entries above it.  The sums give a bound again, and with what lists that didn't name a document may add an upper
   one; documents whose upper bound is lower than the bound go.
3. Exact scores of the documents that are left are looked up in the documents' own rows of postings.

Lists are dealt out by term, and the list of a frequent term in parts of ``LIST_ROWS``; heads are cut in each part before
they meet.  What lists give goes once to the document's task, not once an item: there it meets all items of its term.
Best-of-item steps are ranked windows over rows that Spark limits to k an item in each partition beforehand.  Terms are
places in the items' vocabulary and known by 64-bit hashes; items come in blocks, so that a vocabulary is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize
from tidewatch.llm.textkernel import LOWER_BYTE, U64, chunks, split_words, word_hashes

TOP = 50
#: Items are searched for in blocks of about so many terms in all, repeats included: what a block broadcasts is 60 bytes a term.
BLOCK_TERMS = 1 << 20
#: Pairs of an item and a document are broadcast up to so many.
SMALL_TABLE = 1 << 18
#: Postings of one part of a list.
LIST_ROWS = 250_000
#: Documents of the heads that are looked up, as a multiple of the documents asked for.
TRIED = 4
#: Bytes that part terms: ASCII but digits and letters.
PARTING = np.zeros(256, bool)
PARTING[[b for b in range(128) if not chr(b).isalnum()]] = True


def _terms(column: pa.Array, known: np.ndarray | None):
    """Of each chunk: first row, how many rows, terms of each row, and distinct (row, term, times), by row.

    ``known``: sorted hashes, of which terms are the places; other terms are counted and left out.
    """
    for a, b, data, offs in chunks(column):
        data = LOWER_BYTE[data]
        starts, ends, at = split_words(data, offs, PARTING)
        term = word_hashes(data, starts, ends)
        row = np.repeat(np.arange(b - a), np.diff(at))
        if known is not None:
            place = np.minimum(np.searchsorted(known, term), max(known.size - 1, 0))
            hit = known[place] == term if known.size else np.zeros(term.size, bool)
            row, term = row[hit], place[hit].astype(U64)
        by = np.lexsort((term, row))
        row, term = row[by], term[by]
        new = np.ones(row.size, bool)
        new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        lead = np.flatnonzero(new)
        yield a, b - a, np.diff(at), row[lead], term[lead].view(np.int64), np.diff(np.append(lead, row.size))


def term_rows(df: DataFrame, id_col: str, text_col: str, known=None) -> DataFrame:
    """uid, id, n (terms with repeats), and terms and times in lists of the same order, of every row; a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, rows, n, row, term, times in _terms(batch.column("text"), known.value if known is not None else None):
                edges = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(edges, pa.array(x)) for x in (term, times)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + rows)), batch.column("id").slice(a, rows), pa.array(n), *lists], ["uid", "id", "n", "terms", "times"])
                uid += rows

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return materialize(rows.mapInArrow(run, "uid long, id long, n long, terms array<long>, times array<long>"), "lexical-rows")


def _heads(top: int):
    """Rows sorted by term and falling points -> the first ``top`` of each term in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, had = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            term = batch.column("term").to_numpy()
            lead = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
            within = np.arange(term.size) - np.repeat(lead, np.diff(np.append(lead, term.size)))
            if term[0] == last:
                within[: lead[1] if lead.size > 1 else term.size] += had
            last, had = term[-1], int(within[-1]) + 1
            yield batch.filter(pa.array(within < top))

    return run


@dataclass(frozen=True)
class Asked:
    """What a block of items asks for, by the term's place and the item's: what is broadcast.

    ``first[t]:first[t + 1]``: where the items of term t stand in ``of``; weight and peak (a list's largest entry) are by
    term; uid, level (the threshold), caps (what lists that don't name a document may add in all) and bound by item.
    """

    uid: np.ndarray
    first: np.ndarray
    of: np.ndarray
    weight: np.ndarray
    peak: np.ndarray
    level: np.ndarray
    caps: np.ndarray
    bound: np.ndarray

    def met(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every item of every term of a list: which of the list it is, and the item."""
        n = self.first[term + 1] - self.first[term]
        row = np.repeat(np.arange(term.size), n)
        return row, self.of[np.arange(row.size) + np.repeat(self.first[term] - (np.cumsum(n) - n), n)]


def asked_for(wanted: pa.Table, n_terms: int, uid: np.ndarray, weights: pa.Table, peaks: pa.Table | None = None, bounds: pa.Table | None = None) -> Asked:
    """wanted: item, term; weights: term, w; peaks: term, peak; bounds: item, bound; items without a bound take every entry.

    The threshold of an item is the largest whose entries below it, each list's largest at most, add up to less than the
    bound: with k lists of smaller peaks taken whole, the largest of (bound - 1 - their sum) div (lists - k).
    """
    item, term = np.searchsorted(uid, wanted["item"].to_numpy()), wanted["term"].to_numpy()
    weight, peak = _filled(weights, "term", "w", n_terms), _filled(peaks, "term", "peak", n_terms)
    bound = _filled(bounds, "item", "bound", uid.size, uid)
    order = np.lexsort((peak[term], item))
    i, p = item[order], peak[term][order]
    start = np.searchsorted(i, np.arange(uid.size + 1))
    lists = np.diff(start)
    sums = np.append(0, np.cumsum(p))
    below = sums[:-1] - sums[start[i]]
    before = np.arange(i.size) - start[i]
    level = np.zeros(uid.size, np.int64)
    np.maximum.at(level, i, (bound[i] - 1 - below) // (lists[i] - before))
    caps = np.zeros(uid.size, np.int64)
    np.add.at(caps, i, np.minimum(p, level[i]))
    order = np.argsort(term, kind="stable")
    return Asked(uid, np.searchsorted(term[order], np.arange(n_terms + 1)), item[order], weight, peak, level, caps, bound)


def _filled(table: pa.Table | None, key: str, value: str, size: int, places: np.ndarray | None = None) -> np.ndarray:
    out = np.zeros(size, np.int64)
    if table is not None and table.num_rows:
        at = table[key].to_numpy()
        out[at if places is None else np.searchsorted(places, at)] = table[value].to_numpy()
    return out


def _looked_up(asked):
    """Documents' rows of postings, each with the items to look for -> item, uid, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: Asked = asked.value
        for batch in batches:
            lists = batch.column("terms")
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            term, tf = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            points = mine.weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * batch.column("m").to_numpy()[doc]))
            row, item = mine.met(term)
            names = batch.column("items")
            of = np.repeat(np.arange(batch.num_rows), names.value_lengths().to_numpy())
            pair = np.unique(of * mine.uid.size + np.searchsorted(mine.uid, names.flatten().to_numpy()))
            key = doc[row] * mine.uid.size + item
            at = np.minimum(np.searchsorted(pair, key), max(pair.size - 1, 0))
            hit = np.flatnonzero(pair[at] == key) if pair.size else np.zeros(0, np.int64)
            score = np.bincount(at[hit], points[row[hit]], pair.size).astype(np.int64)  # below 2**53
            yield pa.RecordBatch.from_arrays([pa.array(mine.uid[pair % mine.uid.size]), batch.column("uid").take(pa.array(pair // mine.uid.size)), pa.array(score)], ["item", "uid", "score"])

    return run


def _named(asked):
    """What lists give, by document -> item, uid and points of documents whose upper bound is the item's bound or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: Asked = asked.value

        def summed(uid: np.ndarray, term: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
            doc = np.cumsum(np.append(True, uid[1:] != uid[:-1])) - 1
            row, item = mine.met(term)
            above = points[row] > mine.level[item]
            row, item = row[above], item[above]
            pair, at = np.unique(doc[row] * mine.uid.size + item, return_inverse=True)
            total = np.bincount(at, points[row], pair.size).astype(np.int64)  # below 2**53
            named = np.bincount(at, np.minimum(mine.peak[term[row]], mine.level[item]), pair.size).astype(np.int64)
            item = pair % mine.uid.size
            ok = total + mine.caps[item] - named >= mine.bound[item]
            lead = np.flatnonzero(np.append(True, uid[1:] != uid[:-1]))
            cols = [mine.uid[item[ok]], uid[lead[pair[ok] // mine.uid.size]], total[ok], (mine.caps[item] - named)[ok]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["item", "uid", "points", "more"])

        held: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("uid", "term", "points")]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            if cut or (held[0] and held[0][0][0] != cols[0][0]):
                yield summed(*(np.concatenate([*h, c[:cut]]) for h, c in zip(held, cols)))
                held = [[], [], []]
            for h, c in zip(held, cols):
                h.append(c[cut:])
        if held[0]:
            yield summed(*(np.concatenate(h) for h in held))

    return run


def _best(rows: DataFrame, by: str, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each ``by``, numbered in ``rank``."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= top)


def _bound(sums: DataFrame, top: int) -> DataFrame:
    """item, bound: the ``top``-th largest score of each item; items of fewer documents have no row."""
    return _best(sums.select("item", "score"), "item", [F.col("score").desc()], top).where(F.col("rank") == top).select("item", F.col("score").alias("bound"))


def search(items: DataFrame, docs: DataFrame, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: of each item the ``top`` documents of the highest scores above 0, all if fewer.

    Terms are runs of ASCII digits and letters (A-Z lower-cased) and of any characters beyond ASCII.  Equal scores go by
    ascending doc_id, null ids last, and rows that repeat an id are documents of their own; so are items.  Null and empty
    texts have no terms: such items have no rows, such documents don't count.  Empty tables give no rows; texts are whole
    whatever their length; other columns are ignored.
    """
    asked = term_rows(items, item_id, item_text)
    n = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n
    blocks, found = max(1, -(-n // BLOCK_TERMS)), None
    for k in range(blocks):
        block = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == k)
        some = _searched(block, docs, doc_id, doc_text, top)
        found = some if found is None else found.unionByName(some)
    return found.join(asked.select(F.col("uid").alias("item"), F.col("id").alias("item_id")), "item").select("item_id", "rank", "doc_id", "score")


def _searched(asked: DataFrame, docs: DataFrame, doc_id: str, doc_text: str, top: int) -> DataFrame:
    """item, rank, doc_id, score of the items of one block."""
    spark = docs.sparkSession
    shape = "item long, rank int, doc_id long, score long"
    pairs = asked.select(F.col("uid").alias("item"), F.explode("terms").alias("hash")).toArrow()  # a block's terms
    hashes, place = np.unique(pairs["hash"].to_numpy().view(U64), return_inverse=True)
    wanted = pa.table({"item": pairs["item"], "term": pa.array(place.astype(np.int64))})
    uid, n_words = np.unique(wanted["item"].to_numpy()), hashes.size
    rows = term_rows(docs, doc_id, doc_text, spark.sparkContext.broadcast(hashes))
    stats = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not stats.docs or not n_words:
        return spark.createDataFrame([], shape)
    n_docs, n_terms = F.lit(stats.docs).cast("long"), F.lit(stats.terms).cast("long")
    known = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    ratio = (2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weights = materialize(known.select("term", F.floor(F.log(ratio) * 1000.0).alias("w"), F.ceil(F.col("df") / LIST_ROWS).alias("parts")), "lexical-weights")
    w = weights.select("term", "w").toArrow()

    sized = rows.select("uid", "n", "terms", "times", n_docs.alias("docs"), n_terms.alias("total")).withColumn("m", 100 - 50 + F.expr("50 * n * docs div total"))
    each = sized.select("uid", "m", F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("times").alias("tf"))).alias("x")).select("uid", "m", "x.term", "x.tf")
    scored = each.join(F.broadcast(weights), "term").withColumn("points", F.expr("w * (1000000000 * tf div (1000 * tf + 20 * m))")).where("points > 0")
    dealt = scored.select("term", "points", "uid", F.pmod(F.xxhash64("uid"), "parts").alias("part")).repartition("term", "part")
    postings = materialize(dealt.drop("part").sortWithinPartitions("term", F.col("points").desc()), "lexical-postings")

    def exact(pairs: DataFrame, plan) -> DataFrame:
        """item, uid, score of pairs; few are broadcast, so that rows of postings stay where they are."""
        pairs = materialize(pairs.groupBy("uid").agg(F.collect_list("item").alias("items")), "lexical-pairs")
        few = pairs.agg(F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("n")).first().n <= SMALL_TABLE
        both = sized.select("uid", "m", "terms", "times").join(F.broadcast(pairs) if few else pairs, "uid")
        return both.mapInArrow(_looked_up(plan), "item long, uid long, score long")

    # 1: heads of lists, and exact scores of the documents that do best in them
    heads = _best(postings.mapInArrow(_heads(top), postings.schema), "term", [F.col("points").desc(), F.col("uid")], top)
    heads = materialize(heads.select("term", "points", "uid"), "lexical-heads")
    mine = spark.createDataFrame(wanted)
    sums = mine.join(F.broadcast(heads) if n_words * top <= SMALL_TABLE else heads, "term").groupBy("item", "uid").agg(F.sum("points").alias("points"))
    plan = spark.sparkContext.broadcast(asked_for(wanted, n_words, uid, w))
    tried = exact(_best(sums, "item", [F.col("points").desc()], TRIED * top).select("item", "uid"), plan)
    first = materialize(_bound(tried, top), "lexical-bounds")
    # 2: one threshold for all of an item's lists; what they give goes to its document
    peaks = heads.groupBy("term").agg(F.max("points").alias("peak")).toArrow()
    full = asked_for(wanted, n_words, uid, w, peaks, first.toArrow())
    plan = spark.sparkContext.broadcast(full)
    lowest = np.full(n_words, np.iinfo(np.int64).max)
    np.minimum.at(lowest, np.repeat(np.arange(n_words), np.diff(full.first)), full.level[full.of])
    lowest = spark.createDataFrame(pa.table({"term": np.arange(n_words), "lowest": lowest}))
    given = postings.join(F.broadcast(lowest), "term").where("points > lowest").select("uid", "term", "points")
    named = given.repartition("uid").sortWithinPartitions("uid").mapInArrow(_named(plan), "item long, uid long, points long, more long")
    named = materialize(named, "lexical-candidates")
    second = first.unionByName(_bound(named.select("item", F.col("points").alias("score")), top)).groupBy("item").agg(F.max("bound").alias("bound"))
    left = named.join(F.broadcast(second), "item", "left").where(F.col("points") + F.col("more") >= F.coalesce("bound", F.lit(0)))
    # 3: exact scores of what is left
    scores = exact(left.select("item", "uid"), plan).where("score > 0").join(rows.select("uid", F.col("id").alias("doc_id")), "uid")
    return _best(scores, "item", [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("uid")], top).select("item", "rank", "doc_id", "score")
