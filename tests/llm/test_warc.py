import pytest
from pyspark.sql import functions as F

from arborspark.llm import warc


@pytest.fixture(scope="module")
def store(spark):
    rows = [(i, (i * 37) % 500 + 60, f"d{i % 800}") for i in range(900)] + [(None, 70, "n"), (None, 70, "n"), (5, 80, None)]
    return warc.lay_out(spark.createDataFrame(rows, "record_id long, n_bytes long, digest string"))


def test_offsets_are_contiguous(store):
    at = 0
    for r in store.orderBy("offset").collect():
        assert r.offset == at
        at += r.n_bytes


@pytest.mark.parametrize("leaf,fanout", [(256, 2), (4096, 4), (1 << 30, 16)])
def test_finds_every_difference(spark, store, leaf, fanout):
    primary = store.select("record_id", "offset", "digest")
    broken = primary.withColumn("digest", F.when(F.col("record_id") % 90 == 1, "x").otherwise(F.col("digest"))).filter("record_id is null or record_id % 100 <> 7")
    broken = broken.union(spark.createDataFrame([(10**6, 10**7, "new")], "record_id long, offset long, digest string"))
    got = {(r.record_id, r.status) for r in warc.audit(primary, broken, leaf, fanout).collect()}
    assert got == {(i, "changed") for i in range(900) if i % 90 == 1 and i % 100 != 7} | {(i, "missing") for i in range(900) if i % 100 == 7} | {(10**6, "extra")}


def test_equal_empty_and_repeated(spark, store):
    primary = store.select("record_id", "offset", "digest")
    assert warc.audit(primary, primary).count() == 0
    none = primary.limit(0)
    assert warc.audit(none, none).count() == 0
    assert {r.status for r in warc.audit(primary, none).collect()} == {"missing"}
    twice = primary.union(primary.filter("record_id = 3"))
    assert [(r.record_id, r.status) for r in warc.audit(primary, twice, 512, 4).collect()] == [(3, "extra")]


def test_layouts_of_their_own(spark):
    rows = [(i, (i * 37) % 500 + 60, f"d{i}") for i in range(2000)]
    longer = [(i, n + (i == 3), d if i != 3 else "x") for i, n, d in rows if i != 1500]
    schema = "record_id long, n_bytes long, digest string"
    a, b = (warc.lay_out(spark.createDataFrame(r, schema)).withColumn("node", F.lit("clash")) for r in (rows, longer))
    got = {(r.record_id, r.status, r.digest_a, r.digest_b) for r in warc.audit(a, b, 4096, 4).collect()}
    assert got == {(3, "changed", "d3", "x"), (1500, "missing", "d1500", None)}
    placed = warc.place(a, b, 4096).cache()
    broken = warc.broken_leaves(warc.tree(placed, 4), 4)
    assert broken.count() == 2 and placed.select("node").distinct().count() > 100


def test_one_id_with_many_digests(spark):
    a = spark.createDataFrame([(7, i, f"d{i:04}") for i in range(3000)], "record_id long, offset long, digest string")
    b = a.filter("digest <> 'd0100'").union(spark.createDataFrame([(7, None, "new"), (7, None, "other"), (None, None, None)], a.schema))
    got = sorted(((r.record_id, r.status, r.digest_a, r.digest_b) for r in warc.audit(a, b, 100, 4).collect()), key=str)
    assert got == [(7, "changed", "d0100", "new"), (7, "extra", None, "other"), (None, "extra", None, None)]
