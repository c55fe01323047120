"""Queries beside their SQL on tables that the given ones don't stand for: other row counts and keys."""

import json
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_entry import rows_by_sql, rows_of
from tidewatch.functions import text as tx
from tidewatch.operators import generate, leak
from tidewatch.plans import catalog


def both(spark, folder, name, **tables):
    """Rows of a query and of its SQL, over tables given as SQL; they are written to ``folder``."""
    con = duckdb.connect()
    for table, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet'")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return rows_of(catalog.QUERIES[name](spark, str(folder))), rows_by_sql(con, catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("n", [5, 12, 15, 25, 98])
def test_ratio_split_of_any_number_of_rows(spark, tmp_path, n):
    got, wanted = both(spark, tmp_path, "ratio_split", documents=f"SELECT range AS doc_id FROM range({n})")
    assert got == wanted


def test_mitigations_of_techniques_that_share_an_id(spark, tmp_path):
    # from a million parts on, several have the id that the first six digits make; the SQL's order leaves ties of a place open
    part = "SELECT k AS p_partkey, 'name ' || k AS p_name, 'b' AS p_brand, 't' AS p_type FROM (SELECT unnest([5, 100000, 100001, 1000001, 1000003, 1000010, 1000015]) AS k)"
    tables = {"part": part, "supplier": "SELECT range AS s_suppkey, 'S' || range AS s_name FROM range(50)", "orders": "SELECT 1 AS o_orderkey, 1 AS o_custkey", "events": "SELECT 1 AS event_id, 1 AS user_id"}
    (cols, got), (also, wanted) = both(spark, tmp_path, "gen_mitigation_recommend", **tables)
    assert cols == also == ["lines", "sources", "split_key"]
    bag = lambda rows: [(sorted(lines.split("\n")), *rest) for lines, *rest in rows]
    assert sorted(bag(got)) == sorted(bag(wanted)) and len(got) == 3


def test_longest_runs_of_texts_that_name_many_chunks(spark):
    # words of few kinds, ids that repeat with other texts and other names, chunks of one id, lists without a chunk
    import random

    rng = random.Random(7)
    say = lambda n, kinds: " ".join(rng.choice("abcdefgh"[:kinds]) for _ in range(n))
    recs = [(k % 30, say(rng.randrange(60), 1 + k % 4), [f"c{rng.randrange(25)}" for _ in range(k % 6)] or None, rng.choice([None, "c1", "none"])) for k in range(80)]
    chunks = [(f"c{k % 22}", say(k * 2, 1 + k % 4)) for k in range(26)]

    def longest(text, chunk):
        a, b = text.split(), chunk.split()
        runs = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        return next((n for n in range(25, 3, -1) if runs(a, n) & runs(b, n)), 0)

    wanted = [(i, place, c, longest(text, said)) for i, text, ids, own in recs for place, name in enumerate([*(ids or []), own]) for c, said in chunks if c == name]
    rows = spark.createDataFrame(recs, "text_id int, text string, source_ids array<string>, source_chunk string").repartition(3)
    got = leak.longest_of_named(rows, spark.createDataFrame(chunks, "chunk_id string, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(wanted) and len({w[3] for w in wanted}) > 8


def test_a_text_is_hashed_once_whatever_it_names():
    # a text of 200,000 words beside 300 chunks; before, each chunk had it hashed anew for five lengths
    import time

    import numpy as np
    import pyarrow as pa

    text = np.random.default_rng(1).integers(0, 1 << 60, 200_000)
    chunks = [text[k : k + 30].tolist() for k in range(0, 9000, 30)]
    began = time.process_time()
    got = leak.longest_runs(pa.array([text.tolist()], pa.list_(pa.int64())), pa.array([chunks], pa.list_(pa.list_(pa.int64()))))
    assert got.to_pylist() == [[25] * 300] and time.process_time() - began < 10


def test_a_rule_is_parsed_once(spark):
    rules = spark.range(50).selectExpr("string(id) as rule_id", "'t' as title", "'d' as description", "'high' as level", "concat('selection:\\n  Image: x', id) as detection_yaml", "named_struct('product', 'windows', 'category', 'dns', 'service', string(null)) as logsource", "array('T1') as mitre_techniques")
    made = generate.rule_events(rules)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [json.loads(r.event)["fields"] for r in made.orderBy(F.col("rule_id").cast("int")).collect()] == [{"Image": f"x{k}"} for k in range(50)]


def test_word_hashes_are_those_of_the_words(spark, monkeypatch):
    """Words as ``word_tokens`` finds them, whatever stands between them and wherever blocks of texts end."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abZ9_'- é😀\n.") for _ in range(rng.choice([0, 1, 5, 80]))) for _ in range(400)]
    texts += [None, "", "9a", "a", "b", "-'_", "x" * 100, "X" * 100, "x" * 101, "é" * 40 + "Word", "it's_9-A 9it's"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    words = {r.i: r.w for r in rows.select("i", tx.word_tokens(F.col("text")).alias("w")).collect()}
    few = {r.i: r.w for r in rows.select("i", tx.word_tokens(tx.first_words(F.col("text"), 3)).alias("w")).collect()}
    assert few == {i: w[:3] for i, w in words.items()}
    for most in (leak._BLOCK_BYTES, 7):
        monkeypatch.setattr(leak, "_BLOCK_BYTES", most)
        got = leak.word_hashes(pa.array(["before", *texts])[1:]).to_pylist()
        named = {}
        for i, hashes in enumerate(got):
            assert len(hashes) == len(words[i])
            for word, h in zip(words[i], hashes):
                assert named.setdefault(word, h) == h
        assert len(set(named.values())) == len(named) > 300
    assert leak.word_hashes(pa.array([], pa.string())).to_pylist() == []
