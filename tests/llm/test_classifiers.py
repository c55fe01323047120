import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.langid import identify_language
from tidewatch.llm.quality import keep_quality, score_quality
from tidewatch.llm.toxicity import score_toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    extra = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 34 !!", "en", "s", 8), (None, "the of and", None, None, None), (5, "repeated id", "en", "s", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    return spark.read.parquet(f"{SF}/documents.parquet").unionByName(extra).withColumn("score", F.lit("x")).withColumn("held_out", F.lit(1)).cache()


@pytest.fixture(scope="module")
def labels(spark):
    odd = spark.createDataFrame([(None, 1, 1), (0, None, None), (1, 0, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    return spark.read.parquet(f"{SF}/labels.parquet").unionByName(odd)


def accuracy(got, truth, label):
    rows = got.where("held_out").join(truth.where(F.col(label).isNotNull()), "doc_id").select("predicted", label).collect()
    assert len(rows) > 50
    return sum(r.predicted == r[label] for r in rows) / len(rows)


@pytest.mark.parametrize("fn,label,least", [(score_toxicity, "toxic", 0.93), (score_quality, "quality", 0.97)])
def test_held_out_accuracy_and_edges(spark, docs, labels, fn, label, least):
    got = fn(docs, labels).cache()
    assert got.count() == docs.count()
    rows = got.collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    by = {r.doc_id: r for r in rows}
    if label == "toxic":
        assert by[9001].score == pytest.approx(by[9002].score)
    assert accuracy(got, spark.read.parquet(f"{SF}/labels.parquet"), label) >= least


@pytest.mark.parametrize("fn", [score_toxicity, score_quality])
def test_without_labels_or_rows(docs, labels, fn):
    assert {r.score for r in fn(docs.limit(3), labels.limit(0)).collect()} == {0.5}
    assert fn(docs.limit(0), labels).count() == 0


def test_learning_is_repeatable(docs, labels):
    one, two = (score_quality(d, labels).where("doc_id < 50").orderBy("doc_id").collect() for d in (docs, docs.repartition(7)))
    assert [r.score for r in one] == pytest.approx([r.score for r in two], abs=1e-6)


def test_kept_rows_have_their_columns(docs, labels):
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert 0.7 * docs.count() < kept.count() < docs.count()


def test_language(docs):
    got = identify_language(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang and r.n > 20]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    odd = {r.doc_id: r for r in got if r.doc_id > 9000}
    assert [odd[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in identify_language(docs.withColumn("lang", F.lit(None).cast("string")).limit(5)).collect()} == {"und"}
    assert identify_language(docs.limit(0)).count() == 0
