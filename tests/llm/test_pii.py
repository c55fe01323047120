import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.pii import find_pii, pii_digest, redact_pii, span_values

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ORDER = list(BASE)


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def brute(text):
    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), ORDER.index(kind), m.end(), kind))
    return sorted(out)


CASES = [
    None, "", "a@b.c", "a@b.c_d@e.f", "x..y@a-b.co.uk.", "a@b @c.d", "é😀 me@x.org 152.143.123.131 999.1.1.1 1.2.3.4.5.6.7.8",
    "card 4785380592391139 and 4111 1111 1111 1111, 4111-1111-1111-1112", "call +1 (555) 123-4567. or +123", "+49 30 1234567-",
    "0001.002.3.0255 256.1.1.1", "1" * 3000, "a" * 50000 + "@" + "b." * 6000, "." * 2000 + "@x.y", "1 " * 9000, "+1" + "(" * 4000, "9-9 " * 30,
]


def check(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii_digest(rows).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in want).encode()).hexdigest(), (i, (t or "")[:80], want, got[i].spans)
        assert [got[i][f"n_{k}"] for k in ORDER] == [sum(w[3] == k for w in want) for k in ORDER]


def test_base_spans_match_brute_force(spark):
    check(spark, CASES)


def test_base_spans_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [r.text for r in docs.select("text").collect()])


def test_checksums_and_context(spark):
    texts = ["my bank account GB82 WEST 1234 5698 7654 32 now", "GB82 WEST 1234 5698 7654 33", "ssn 078-05-1120", "code 078-05-1120", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pii", F.lit("old")).withColumn("start", F.lit(1))
    found = find_pii(docs)
    kinds = {r.doc_id: [s.kind for s in r.pii] for r in found.collect()}
    assert kinds == {0: ["iban"], 1: [], 2: ["ssn"], 3: [], 4: []}
    values = {(r.doc_id, r.kind): r.value for r in span_values(found.drop("start")).collect()}
    assert values == {(0, "iban"): "GB82 WEST 1234 5698 7654 32", (2, "ssn"): "078-05-1120"}


def test_redaction_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "to a@b.co and b@c.de!"), (2, None), (3, "plain")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in redact_pii(docs).collect()} == {1: "to [EMAIL] and [EMAIL]!", 2: None, 3: "plain"}
    assert pii_digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("digits,ok", [("4111111111111111", 1), ("4111111111111112", 0)])
def test_luhn(spark, digits, ok):
    rows = spark.createDataFrame([(1, f"x {digits} y")], "doc_id long, text string")
    assert pii_digest(rows).first().n_card == ok


def test_accounts_end_before_the_next_word(spark):
    texts = ["DE89370400440532013000 BIC COBADEFF", "DE89 3704 0044 0532 0130 00 2024 EUR", "pay DE89370400440532013000", "DE89370400440532013001 BIC"]
    got = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    values = {r.doc_id: r.value for r in span_values(got).where("kind = 'iban'").collect()}
    assert values == {0: "DE89370400440532013000", 1: "DE89 3704 0044 0532 0130 00", 2: "DE89370400440532013000"}


def test_a_text_full_of_spans(spark):
    import time

    text = " ".join(f"u{i}@ex{i % 7}.org" for i in range(80_000)) + " ssn 078-05-1120"
    docs = spark.createDataFrame([(1, text), (2, "x@y.z " * 700), (2, "x@y.z " * 700)], "doc_id long, text string")
    began = time.time()
    got = pii_digest(docs).collect()
    assert time.time() - began < 60
    want = brute(text)
    for r in got:
        if r.doc_id == 1:
            assert r.n_email == len(want) == 80_000 and r.spans.endswith(f"ssn:{len(text) - 11}:{len(text)}")
            assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in want).encode()).hexdigest()
    assert [r.n_email for r in got if r.doc_id == 2] == [700, 700]


def test_context_reaches_over_neighbours(spark):
    """Forty characters, short numbers in between, and no further."""
    near = "ssn" + " 11" * 12 + " "
    texts = [f"{near}078-05-1120", f"ssn{' 11' * 14} 078-05-1120", f"078-05-1120 {'22 ' * 12}ssn", f"078-05-1120 {'22 ' * 14}ssn"]
    got = pii_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert ["ssn" in r.spans for r in sorted(got, key=lambda r: r.doc_id)] == [True, False, True, False]
