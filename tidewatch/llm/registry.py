"""Queries of the training-data operators, each over its whole table, and the SQL that expresses them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.bpe import encode_digest
from tidewatch.llm.common import LOWER, UPPER, documents
from tidewatch.llm.decontaminate import find_leaks
from tidewatch.llm.exact_dedup import exact_groups
from tidewatch.llm.hmm import score_lm
from tidewatch.llm.langid import identify_language
from tidewatch.llm.lexical_search import search
from tidewatch.llm.pii import pii_digest
from tidewatch.llm.quality import score_quality
from tidewatch.llm.simhash import near_groups
from tidewatch.llm.substring_dedup import dedup_substrings
from tidewatch.llm.suffix_dedup import dedup_bytes
from tidewatch.llm.toxicity import score_toxicity
from tidewatch.llm.whitening import whiten


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_lm(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), keep="max")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(documents(spark, sf_dir))
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(documents(spark, sf_dir))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir)).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair that leaks; documents that are clean have no row."""
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(documents(spark, sf_dir)).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_hmm": op4_hmm,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_whitening": op12_whitening,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
    "op9_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
        ),
        win AS (
            SELECT doc_id, s, array_to_string(list_slice(ws, s + 1, s + 20), ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 19)) AS s FROM w WHERE len(ws) >= 20)
        ),
        late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM late),
        pos AS (SELECT doc_id, unnest(range(0, len(ws))) AS i, unnest(ws) AS x FROM w),
        kept AS (
            SELECT pos.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY pos.i) AS t
            FROM pos LEFT JOIN gone ON gone.doc_id = pos.doc_id AND gone.i = pos.i WHERE gone.i IS NULL GROUP BY pos.doc_id
        )
        SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, len(w.ws)::BIGINT - coalesce(kept.n, 0) AS n_removed,
               sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
    """,
    "op11_suffix_dedup": """
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
        win AS (
            SELECT r, s, md5(substr(h, 2 * s + 1, 400)) AS k
            FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS s FROM d WHERE length(h) >= 400)
        ),
        again AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
        runs AS (SELECT r, s, CASE WHEN s > lag(s) OVER (PARTITION BY r ORDER BY s) + 200 THEN 1 ELSE 0 END AS new FROM again),
        spans AS (
            SELECT r, min(s) AS a, max(s) + 200 AS b
            FROM (SELECT r, s, sum(new) OVER (PARTITION BY r ORDER BY s) AS g FROM runs) GROUP BY r, g
        ),
        gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS low FROM spans),
        parts AS (
            SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(h, 2 * low + 1, 2 * (a - low)), '' ORDER BY a) AS t
            FROM gaps JOIN d USING (r) GROUP BY r
        )
        SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(t || substr(h, 2 * last + 1), h))) AS kept_sha256
        FROM d LEFT JOIN parts USING (r)
    """,
    "op13_lexical_search": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS uid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
            FROM documents
        ),
        st AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
        q AS (
            SELECT item, item_id, unnest(ts) AS t
            FROM (SELECT row_number() OVER () AS item, item_id,
                         list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts
                  FROM benchmark)
        ),
        p AS (
            SELECT uid, doc_id, n, t, count(*) AS tf FROM (SELECT uid, doc_id, len(ts) AS n, unnest(ts) AS t FROM d)
            WHERE t IN (SELECT t FROM q) GROUP BY uid, doc_id, n, t
        ),
        w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, st GROUP BY t, n_docs),
        s AS (
            SELECT item, item_id, uid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM q JOIN p USING (t) JOIN w USING (t), st GROUP BY item, item_id, uid, doc_id
        )
        SELECT item_id, rank::INT AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
    """,
}
