"""Traversals against plain Python walks, whole and cut into short runs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from arborspark.operators import ordering, topology
from arborspark.session import land


def random_forest(seed, n=120, roots=2):
    rng = random.Random(seed)
    ids = rng.sample(range(1, 10 * n), n)
    rows = []
    for i, node in enumerate(ids):
        parent = -1 if i < roots else (ids[i - 1] if rng.random() < 0.7 else rng.choice(ids[:i]))
        rows.append((node, rng.choice([0, 1, 5, 6]), rng.uniform(0, 1000), rng.uniform(0, 1000), rng.uniform(0, 1000), rng.uniform(1, 9), parent))
    rows.append((100_000, 0, 0, 0, 0, 1, 99_999))  # parent missing
    rng.shuffle(rows)
    return rows


def walk_up(rows):
    parent = {r[0]: r[6] for r in rows}
    out = {}
    for node in parent:
        path = [node]
        while parent[path[-1]] in parent and parent[path[-1]] != -1:
            path.append(parent[path[-1]])
        out[node] = path
    return out


@pytest.fixture(params=[1 << 18, 16])
def run_length(request, monkeypatch):
    monkeypatch.setattr(topology, "CHUNK_ROWS", request.param)
    return request.param


def gap(rows, a, b):
    at = {r[0]: r[2:5] for r in rows}
    return sum((p - q) ** 2 for p, q in zip(at[a], at[b])) ** 0.5


def test_paths_and_subtrees(make, run_length):
    groups = {"a": random_forest(1), "b": random_forest(2)}
    nodes = make(groups)
    up = {(n, k): v for n, rows in groups.items() for k, v in walk_up(rows).items()}
    got = {(r.neuron, r.id): r for r in topology.root_distance(nodes).collect()}
    for (n, node), path in up.items():
        r = got[(n, node)]
        assert (r.root, r.hops, r.looped) == (path[-1], len(path) - 1, False)
        assert r.root_distance == pytest.approx(sum(gap(groups[n], a, b) for a, b in zip(path, path[1:])))
    below = {}
    for (n, node), path in up.items():
        for a in path:
            below.setdefault((n, a), []).append(node)
    for r in topology.subtree_cable(nodes).collect():
        members = below[(r.neuron, r.id)]
        assert r.n_nodes == len(members)
        parent = {x[0]: x[6] for x in groups[r.neuron]}
        cable = sum(gap(groups[r.neuron], m, parent[m]) for m in members if parent[m] in parent)
        assert r.cable_length == pytest.approx(cable)


def test_parent_first(make, run_length):
    rows = [r for r in random_forest(3) if r[0] != 100_000]
    kids = {}
    for r in rows:
        kids.setdefault(r[6], []).append(r[0])
    want, stack = [], kids[-1][::-1]
    while stack:
        node = stack.pop()
        want.append(node)
        stack.extend(kids.get(node, [])[::-1])
    got = topology.parent_first_order(make(rows)).orderBy("position").collect()
    assert [r.id for r in got] == want


def test_branch_order(make, run_length):
    rows = random_forest(4)
    kids = {}
    for r in rows:
        kids.setdefault(r[6], []).append(r[0])
    kind = {r[0]: r[1] for r in rows}
    want = {}
    for node, path in walk_up(rows).items():
        order = 0 if kind[path[-1]] == 1 else 1
        for step in path[-2::-1] if len(path) > 1 else []:
            order = max(order, 1) + (len(kids.get(step, [])) >= 2 and kind[step] != 1)
        want[node] = order
    assert {r.id: r.branch_order for r in topology.branch_order(make(rows)).collect()} == want


def test_cycles_and_long_chain(make, run_length):
    ring = [(1, 0, 0, 0, 0, 1, 3), (2, 0, 0, 0, 0, 1, 1), (3, 0, 0, 0, 0, 1, 2), (4, 0, 0, 0, 0, 1, 3), (5, 1, 0, 0, 0, 1, -1)]
    looped = {r.id: r.looped for r in topology.root_paths(make(ring)).collect()}
    assert looped == {1: True, 2: True, 3: True, 4: True, 5: False}
    problems = {r.id: r.problem for r in topology.parent_first_order(make(ring)).collect()}
    assert problems[4] == "cycle" and problems[5] is None
    chain = make([(i, 0, i, 0, 0, 1, i - 1 if i > 1 else -1) for i in range(1, 3001)])
    assert topology.root_paths(chain).agg({"hops": "max"}).first()[0] == 2999


def ringed_forest(seed, n=150):
    """A forest in which a few nodes near the roots hang below their own descendants."""
    rows = random_forest(seed, n, roots=6)
    rng = random.Random(seed)
    paths = walk_up(rows)
    deep = [p for p in paths.values() if len(p) > 6]
    for path in rng.sample(deep, 3):
        rows = [(*r[:6], path[0]) if r[0] == path[-1] and r[6] == -1 else r for r in rows]
    return rows


def on_or_below_loop(rows):
    parent, out = {r[0]: r[6] for r in rows}, set()
    for node in parent:
        seen, at = set(), node
        while at in parent and parent[at] != -1 and at not in seen:
            seen.add(at)
            at = parent[at]
        if at in seen:
            out.add(node)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_loops_have_no_totals_and_leave_the_rest_alone(make, run_length, seed):
    groups = {"a": ringed_forest(seed), "b": random_forest(seed + 50), "c": [(7, 0, 1, 2, 3, 1, 7), (8, 0, 1, 2, 3, 1, 7), (9, 0, 0, 0, 0, 1, -1)]}
    nodes = make(groups)
    lost = {(n, k) for n, rows in groups.items() for k in on_or_below_loop(rows)}
    assert lost
    got = {(r.neuron, r.id): r for r in topology.root_distance(nodes).collect()}
    cables = {(r.neuron, r.id): r for r in topology.subtree_cable(nodes).collect()}
    assert {k for k, r in got.items() if r.looped} == lost
    for key in lost:
        assert (got[key].root, got[key].hops, got[key].root_distance, cables[key].n_nodes, cables[key].cable_length) == (None,) * 5
    sizes = {}
    for n, rows in groups.items():
        fine = [r for r in rows if (n, r[0]) not in lost]
        for node, path in walk_up(fine).items():
            assert got[n, node].hops == len(path) - 1
            for a in path:
                sizes[n, a] = sizes.get((n, a), 0) + 1
    assert {k: r.n_nodes for k, r in cables.items() if k not in lost} == sizes


def test_frames_follow_the_rows(make, run_length):
    nodes = make({f"n{i:03d}": random_forest(i, n=20) for i in range(60)} | {"big": random_forest(99, n=900)})
    packed = topology.frames(nodes).groupBy("_frame").count().collect()
    total = sum(r["count"] for r in packed)
    assert len(packed) >= total / (2 * run_length) and max(r["count"] for r in packed) <= 2 * max(run_length, 16)
    assert len(packed) <= 1 + 2 * total / run_length


def test_reroot(make, run_length):
    rows = [(1, 0, 0, 0, 0, 1, -1), (2, 0, 0, 0, 0, 1, 1), (3, 0, 0, 0, 0, 1, 2), (4, 0, 0, 0, 0, 1, 2), (9, 0, 0, 0, 0, 1, -1)]
    nodes = make(rows)
    got = {r.id: r.tree_parent for r in topology.rerooted(nodes, nodes.filter("id = 3").select("neuron", "id")).collect()}
    assert got == {1: 2, 2: 3, 3: -1, 4: 2, 9: None}


def test_nearest_marked(make, run_length):
    rows = random_forest(5)
    nodes = make(rows)
    paths = walk_up(rows)
    five = {r[0] for r in rows if r[1] == 5}
    for r in topology.nearest_marked(nodes, nodes["type"] == 5).collect():
        hit = next((i for i, p in enumerate(paths[r.id]) if p in five), None)
        assert (r.marked, r.marked_hops) == ((None, None) if hit is None else (paths[r.id][hit], hit))


def test_hot_key_windows_match_plain_ones(spark, monkeypatch):
    rng = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 20}", rng.randrange(500), i, float(i % 7)) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v long, tie long, w double")
    from pyspark.sql import functions as F

    plain = ordering.running(df, ["k"], ["v", "tie"], {"s": F.col("w"), "n": F.lit(1)}, rows=10)
    flat = ordering.quantiles(df, ["k"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, rows=10)
    monkeypatch.setattr(ordering, "HOT_ROWS", 100)
    hot = ordering.running(df, ["k"], ["v", "tie"], {"s": F.col("w"), "n": F.lit(1)})
    assert sorted(plain.collect()) == sorted(hot.collect())
    cut = ordering.quantiles(df, ["k"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99})
    for a, b in zip(flat.orderBy("k").collect(), cut.orderBy("k").collect()):
        assert list(a)[1:] == pytest.approx(list(b)[1:])
    total = ordering.running(df, [], ["v", "tie"], {"n": F.lit(1)})
    assert total.agg(F.max("n"), F.countDistinct("n")).first()[:] == (4000, 4000)


def test_short_runs_share_frames_and_change_nothing(make):
    nodes = make({f"n{i:03d}": random_forest(i, n=40) for i in range(30)} | {"big": random_forest(99, n=900)})
    assert topology.frames(nodes, run_rows=16).select("_frame").distinct().count() <= 2
    told = lambda run: sorted(tuple(r) for r in topology.traverse(nodes, sums={"size": topology.F.lit(1.0)}, run_rows=run).collect())
    assert told(16) == told(None)


def test_packed_node_tables_are_not_broadcast(spark):
    """A landed table of many nodes packs into a file under the broadcast limit; its join must not go through the driver."""
    n = 400_000
    i = F.col("id")
    nodes = land(spark.range(n).select(
        F.floor(i / 400).alias("neuron"), (i % 400).alias("id"), (i % 400).alias("row_idx"), F.when(i % 400 == 0, -1).otherwise(i % 400 - 1).alias("parent")
    ))
    sizes = topology.subtree_totals(nodes.withColumn("size", F.lit(1.0)), ["size"])
    assert sum(os.path.getsize(f.removeprefix("file:")) for f in sizes.inputFiles()) < 10 << 20
    plan = nodes.join(sizes, ["neuron", "id"])._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan
