import zlib

import pytest
from pyspark.sql import functions as F

from arborspark.llm import langid


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(docs):
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))), max_docs=400)
    rows = langid.identify(docs.withColumn("score", F.lit("clash")), model).filter("lang is not null").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_and_backoff(spark):
    train = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("the house and the garden", "en"), ("der garten und das haus", "de")] * 3)] + [(None, "x", "fr"), (9, None, "fr"), (10, "y", None)], "doc_id long, text string, lang string")
    model = langid.fit(train, max_docs=100)
    assert model.languages == ["de", "en"]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "the"), (5, "gartens"), (6, "日本"), (7, "the " * 50000), (4, "the")], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(odd, model).collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (6, "de"), (7, "en"), (4, "en")]
    assert langid.identify(odd.limit(0), model).count() == 0
    nothing = langid.fit(train.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_signs_that_are_no_letters_are_no_words():
    assert langid.words("² ½ ①²") == [] and langid.words("x² Ünï") == ["x²", "ünï"]
