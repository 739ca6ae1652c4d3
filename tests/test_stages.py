"""The whole chain on a few neurons, and the contract of the registry."""

import math

import __spark_entry__ as contract
from arborspark.plans import forest, stages


def trunk(n, start, parent, offset):
    return [(start + i, 0, 0, offset, 1500 * (i + 1), 50, parent if i == 0 else start + i - 1) for i in range(n)]


def test_chain(make, spark):
    soma = [(1, 1, 0, 0, 0, 400, -1)]
    cross = [(200, 0, 500, 0, 61000, 50, 80), (201, 0, -500, 0, 61500, 50, 80), (202, 0, 900, 0, 62000, 50, 200), (203, 0, -900, 0, 62500, 50, 201)]
    nodes = make({"1": soma + trunk(60, 40, 1, 0) + trunk(3, 10, 1, 90) + cross, "2": [(1, 0, 0, 0, 0, 9, -1)] + trunk(5, 2, 1, 0)})
    meta = spark.createDataFrame([("1", 0.0, 0.0, 0.0)], "root_id string, soma_x double, soma_y double, soma_z double")
    syn = spark.createDataFrame([("1", 1, "pre", 0.0, 0.0, 30000.0), ("2", 2, "post", 0.0, 0.0, 4500.0), ("1", 3, "post", 0.0, 0.0, 30001.0)],
                                "neuron string, syn_id long, syn_type string, x double, y double, z double")
    out = stages.release(nodes, meta, syn, strict_text=True)
    rows = out.nodes.collect()
    kinds = {(r.neuron, r.id): r.type for r in rows}
    assert kinds[("1", 1)] == 1 and kinds[("1", 59)] == 4 and kinds[("2", 4)] == 3
    assert ("1", 10) not in kinds
    children = {}
    for r in rows:
        children[(r.neuron, r.parent)] = children.get((r.neuron, r.parent), 0) + 1
    assert max(children.values()) == 2
    assert {r.neuron: r.error for r in out.logs["release"].collect()} == {"1": None, "2": None}
    assert {r.neuron: r.category for r in out.logs["soma_repair"].collect()} == {"1": "unipolar", "2": "no_soma"}


def test_registry(spark):
    names = set(contract.queries())
    assert set(contract.oracle_sql()) <= names and len(names) > 70
    df = contract.entry(spark)
    assert df.count() == 10


def test_forest_does_not_depend_on_the_window(spark, monkeypatch):
    from arborspark.operators import ordering

    folder = "/root/testdata/sf0.001"
    plain = forest._forest(spark, folder).orderBy("neuron", "id").collect()
    monkeypatch.setattr(ordering, "HOT_ROWS", 50)
    assert forest._forest(spark, folder).orderBy("neuron", "id").collect() == plain
    assert math.isfinite(sum(r.x for r in plain))
