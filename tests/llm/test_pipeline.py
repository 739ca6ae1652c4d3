import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from arborspark.llm import quality
from arborspark.session import land

from .test_jaccard import brute
from .test_mixing import wanted

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, "one two three four five six seven eight nine ten eleven", None, None, 1), (0, None, "en", "src1", 0), (900001, "twelve " + " ".join(f"w{i}" for i in range(30)), None, None, 2), (900001, "twelve " + " ".join(f"w{i}" for i in range(30)), None, None, 2), (900002, "12 13 " * 8 + "14 15 16 17", "en", "src1", 3)], docs.schema)
    tables = [land(docs.union(extra), "in")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(land(stage(spark, tables[-1], SF), name))
    return tables


def test_stage_decisions(spark, stages):
    raw, ruled, told, single, mixed, coded = [t.collect() for t in stages]
    judged = quality.judge(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert len(ruled) == sum(r.kept for r in judged) < len(raw)
    assert {r.doc_id for r in ruled} - {r.doc_id for r in told} <= {900002} and None in {r.doc_id for r in told}
    assert all(r.lang for r in told)
    classes = brute([(r.doc_id, r.text) for r in told], 5, 80)
    assert sorted(r.doc_id for r in single if r.doc_id is not None) == sorted({c for null, _, _, c in classes if not null})
    sizes, taken = {}, {}
    for r in single:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    want = wanted(sizes, (1, 2, 3), 3)
    big = max(len(r.text.split()) for r in single)
    assert all(abs(taken.get(s, 0) - t) <= big for s, t in want.items())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = sorted((r.doc_id or -1, library.encode(r.text, add_special_tokens=False).ids) for r in mixed)
    assert texts == sorted((r.doc_id or -1, r.ids) for r in coded)
    assert all(set(t.columns) == set(stages[0].columns) for t in stages[:-1])


def test_texts_under_one_id_are_documents_of_their_own(spark):
    text = lambda word: " ".join(f"{word}{i}" for i in range(40))
    rows = [(5, "a"), (5, "b"), (7, "a"), (9, "a"), (9, "c"), (9, "c"), (3, "d"), (None, "d"), (-4, "c")]
    docs = spark.createDataFrame([(i, text(w), "en", "s", 1) for i, w in rows] + [(11, text("b") + " x", "en", "s", 1), (12, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.jaccard_join(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text and r.text[0]) for r in kept), key=str) == [(-4, "c"), (12, None), (3, "d"), (5, "a"), (5, "b"), (None, "d")]


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_run_is_registered(spark):
    import __spark_entry__

    assert {"pipeline", *(f"op{i}" for i in range(1, 14))} <= {n.split("_")[0] for n in __spark_entry__.queries()}
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert out.agg(F.sum("n_tokens")).first()[0] > 0
