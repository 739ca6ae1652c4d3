import numpy as np
import pytest
from pyspark.sql import functions as F

from arborspark.llm import mixing


def wanted(sizes, weights, cap):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), set(names)
    left = float(sum(sizes.values()))
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        for s in list(open_):
            target[s] += left * w[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] > cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, ["b", "a", "é", None, "z", "tiny"][i % 6] if i % 40 else "a", (i * 7919) % 900 + 1) for i in range(1200)]
    rows = [r for r in rows if r[1] != "tiny" or r[0] < 40] + [(5000, "void", 0), (5001, "void", None), (7, "a", 50), (7, "a", 50), (None, "b", 10)]
    return spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("g", F.lit("clash"))


def test_targets_cap_and_reruns(docs):
    got = mixing.mix(docs).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + (r["size"] or 0)
    want = wanted(sizes, (1, 2, 3), 3)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(got) == docs.count()
    for s, t in taken.items():
        assert abs(t - want[s]) <= max(0.001 * want[s], 60), (s, t, want[s])
    key = lambda rs: sorted(map(str, rs))
    again = mixing.mix(docs.repartition(7, "doc_id"))
    assert key(again.collect()) == key(got)
    assert key(mixing.mix(docs).collect()) == key(got)


def plain_rates(sizes, target, cap):
    """Rates min(cap, exp(m x size / mean)) whose tokens meet the target, m by bisection."""
    sizes = np.array(sizes, dtype=float)
    x = sizes / sizes.mean()
    rate = lambda m: np.exp(np.minimum(m * x, np.log(cap)))
    low, high = -1e4, np.log(cap) / x[x > 0].min() + 1
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (rate(middle) * sizes).sum() < target else (low, middle)
    return rate(high)


def test_rates_solve_the_dual_per_document(spark):
    sizes = {1: [(i * 7919) % 900 + 1 for i in range(400)], 2: [3, 5, 8, 2000, 40_000, 1, 1], 3: [10] * 30, 4: [0, 7, 12, 300]}
    factor = {1: 0.37, 2: 1.6, 3: 2.2, 4: 3.0}
    docs = spark.createDataFrame([(g, i, s) for g, own in sizes.items() for i, s in enumerate(own)], "g long, i long, size long")
    targets = spark.createDataFrame([(g, float(sum(own)) * factor[g]) for g, own in sizes.items()], "g long, target double")
    got = {(r.g, r.i): r.rate for r in mixing.tilted(docs, targets, 3.0).collect()}
    for g, own in sizes.items():
        want = plain_rates(own, sum(own) * factor[g], 3.0)
        np.testing.assert_allclose([got[g, i] for i in range(len(own))], want, rtol=1e-5)
        assert sum(got[g, i] * s for i, s in enumerate(own)) == pytest.approx(sum(own) * factor[g], rel=1e-6)
    assert len({round(got[1, i], 6) for i in range(400)}) > 100


def test_feature_means_are_kept(spark):
    rows = [(i, i % 2 + 1, 100 + i % 300, (i % 10) / 10) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, g long, size long, f double")
    sums = {r.g: (r.s, r.m) for r in docs.groupBy("g").agg(F.sum("size").alias("s"), (F.sum(F.col("size") * F.col("f")) / F.sum("size")).alias("m")).collect()}
    targets = spark.createDataFrame([(1, sums[1][0] * 0.4), (2, sums[2][0] * 1.7)], "g long, target double")
    rated = mixing.rates(docs, targets, 3.0, ["f"])
    for r in rated.groupBy("g").agg(F.sum(F.col("size") * F.col("rate")).alias("t"), (F.sum(F.col("size") * F.col("rate") * F.col("f")) / F.sum(F.col("size") * F.col("rate"))).alias("m")).collect():
        assert r.t == pytest.approx({1: 0.4, 2: 1.7}[r.g] * sums[r.g][0]) and r.m == pytest.approx(sums[r.g][1])


def test_empty(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.filter("source = 'void'")).agg(F.sum("taken")).first()[0] == 0
