"""The registered queries of this subpackage, through the entry point: columns, types, and the SQL where there is one."""

import duckdb
import pytest

import __spark_entry__
from tidewatch.llm import registry

DATA = "/root/testdata/sf0.001"
#: Columns that a query returns first, with their types.
CONTRACTS = {
    "op1_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op4_hmm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op6_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op7_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op11_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op12_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op13_lexical_search": "item_id bigint, rank int, doc_id bigint, score bigint",
}


def test_entry_has_all():
    queries = __spark_entry__.queries()
    assert set(registry.QUERIES) | {"pipeline"} <= set(queries) and set(registry.ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(CONTRACTS, key=lambda n: int(n[2:].split("_")[0])))
def test_contract(spark, name):
    df = registry.QUERIES[name](spark, DATA)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in (x.split()[0] for x in CONTRACTS[name].split(", "))} == dict(x.split() for x in CONTRACTS[name].split(", "))
    if name not in registry.ORACLE_SQL:
        assert df.count() > 0
        return
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    got = con.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in got.description]
    want = sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in got.fetchall())
    assert sorted(df.columns) == sorted(names) and sorted(tuple(r[c] for c in sorted(names)) for r in df.collect()) == want
