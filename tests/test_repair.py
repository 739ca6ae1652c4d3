"""Soma repair, relinking and soma pruning on small trees."""

import hashlib
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arborspark.functions import stats
from arborspark.operators import relink, repair, soma, soma_growth, statistics, topology


def star(lengths, radius=1.0):
    """A soma with one two-node branch per cable length (nm)."""
    rows = [(1, 1, 0, 0, 0, 10, -1)]
    for i, length in enumerate(lengths):
        a = 10 * (i + 1)
        rows += [(a, 0, length / 2, 0, 0, radius, 1), (a + 1, 0, length, 0, 0, radius, a)]
    return rows


def falling_threshold(lengths, volumes, total):
    """The search written as the loop over falling thresholds."""
    left, thr, kept_thr = dict(enumerate(lengths)), 0.15, None
    while thr >= 0.01 and len(left) > 1 and max(left.values()) > 0:
        top = max(left.values())
        gone = [i for i, c in left.items() if c < top * thr]
        if gone:
            removed = sum(volumes[i] for i in range(len(lengths)) if i not in left or i in gone)
            if removed / total > 0.10 and not all(left[i] < top * 0.05 for i in gone):
                break
            left = {i: c for i, c in left.items() if i not in gone}
            kept_thr = thr
        thr -= 0.01
    return set(left), kept_thr


@pytest.mark.parametrize("radius", [1.0, 8.0])
@pytest.mark.parametrize("lengths", [(100, 14, 4, 1), (100, 4, 1), (100, 60), (100,), (100, 14.9, 15.1), ()])
def test_branch_removal_equals_threshold_loop(make, lengths, radius):
    rows = star(lengths, radius)
    nodes = make(rows)
    left, decisions = repair.remove_short_branches(nodes, repair.soma_scan(nodes))
    total = sum(r[5] ** 3 for r in rows)
    keep, thr = falling_threshold(lengths, [2 * radius**3] * len(lengths), total)
    want = {1} | {10 * (i + 1) + d for i in keep for d in (0, 1)}
    assert {r.id for r in left.collect()} == want
    got = [r.best_threshold for r in decisions.collect()]
    assert (got[0] if got else None) == thr


def test_repair_categories(make, spark):
    nodes = make({
        "1": star((100, 1)), "2": star((100, 90)), "3": [(1, 0, 0, 0, 0, 1, -1)], "4": star((50,)), "5": star((100, 1)), "6": star(()),
    })
    meta = spark.createDataFrame(
        [("1", 0.0, 0.0, 0.0), ("2", 0.0, 0.0, 0.0), ("3", 0.0, 0.0, 0.0), ("5", 9000.0, 0.0, 0.0), ("6", 0.0, 0.0, 0.0)],
        "root_id string, soma_x double, soma_y double, soma_z double")
    out, log = repair.repair_somas(nodes, meta)
    got = {r.neuron: (r.category, r.soma_status, r.changed) for r in log.collect()}
    assert got == {
        "1": ("unipolar", "trusted_soma", True), "2": ("non_unipolar", "trusted_soma", False), "3": ("no_soma", "swc_no_soma", False),
        "4": ("no_soma", "no_trusted_meta_soma", True), "5": ("soma_need_check", "soma_need_check", False), "6": ("non_unipolar", "trusted_soma", False),
    }
    assert out.filter("neuron = '4' AND type = 1").count() == 0
    assert out.filter("neuron = '1'").count() == 3 and out.filter("neuron = '5'").count() == 5


def relink_tree(seed):
    rng = random.Random(seed)
    rows = [(1, 1, 0.0, 0.0, 0.0, 1, -1)]
    for i in range(2, 90):
        base = rows[-1] if rng.random() < 0.6 else rng.choice(rows)
        rows.append((i, rng.choice([0, 0, 5, 5, 6]), *(c + rng.gauss(0, 900) for c in base[2:5]), 1, base[0]))
    return rows


def sampled_gap(p, q, r, s, steps=400):
    """Distance of two segments by alternating projections from many starts."""
    best = np.inf
    for a, b, c, d in ((p, q, r, s), (r, s, p, q)):
        t = np.linspace(0, 1, steps)[:, None]
        on = a + t * (b - a)
        along = d - c
        share = np.clip((on - c) @ along / max(float(along @ along), 1e-300), 0, 1)[:, None]
        best = min(best, float(np.linalg.norm(on - (c + share * along), axis=1).min()))
    return best


def test_segment_gaps():
    rng = np.random.default_rng(8)
    for scale in (1.0, 0.01):
        p, q, r, s = (rng.normal(0, 1, (60, 3)) * [1, 1, scale] for _ in range(4))
        q[:5], s[3:8] = p[:5], r[3:8]
        got = relink.segment_gaps(p, q, r, s)
        for i in range(60):
            want = sampled_gap(p[i], q[i], r[i], s[i])
            assert got[i] <= want + 1e-12 and want - got[i] < 0.01
    assert relink.segment_gaps(*(np.array([v], float) for v in ([0, 0, 0], [2, 0, 0], [1, -1, 0], [1, 1, 0])))[0] == 0


def plain_penalty(at, parent, kids, source, child, anchor):
    """Crossing cost of one move over the edges at and around what the search visits."""
    near, todo = {source}, [(k, 1, math.dist(at[k], at[source])) for k in kids[source]]
    for node, hops, path in todo:
        near.add(node)
        if hops <= 8 and path <= 8:
            todo += [(k, hops + 1, path + math.dist(at[k], at[node])) for k in kids.get(node, [])]
    ends = [n for n in parent if parent[n] in at and (n in near or parent[n] in near) and not {n, parent[n]} & {anchor, child}]
    gaps = [float(relink.segment_gaps(*(v[None] for v in (at[anchor], at[child], at[n], at[parent[n]])))[0]) for n in ends]
    return max([0.0, *(1 - g / 0.05 for g in gaps)])


def plain_relink(rows, crossing=False):
    """The greedy search on whole trees, one target after the other."""
    parent = {r[0]: r[6] for r in rows}
    at = {r[0]: np.array(r[2:5]) / 1000 for r in rows}
    kind = {r[0]: r[1] for r in rows}
    kids = {}
    for r in rows:
        kids.setdefault(r[6], []).append(r[0])
    gap = lambda a, b: float(np.linalg.norm(at[a] - at[b]))
    unit = lambda v: v / np.linalg.norm(v) if np.linalg.norm(v) > 1e-12 else v * 0
    moves = []
    for source in [r[0] for r in rows if r[1] == 5]:
        while len(kids.get(source, [])) > 2:
            options = []
            for root in kids[source]:
                queue = [(root, 1, gap(root, source))]
                for node, hops, path in queue:
                    if hops > 8 or path > 8.0:
                        continue
                    mine = kids.get(node, [])
                    if len(mine) == 1 and kind[node] not in (1, 6):
                        options.append((root, node, path))
                    queue.extend((k, hops + 1, path + gap(k, node)) for k in mine)
            best = None
            for child in kids[source]:
                here, gone, point = child, gap(child, source), None
                for _ in range(8):
                    if len(kids.get(here, [])) != 1:
                        break
                    nxt = kids[here][0]
                    if gap(nxt, here) > 0 and gone + gap(nxt, here) > 8.0:
                        point = at[here] + max(0.0, 8.0 - gone) / gap(nxt, here) * (at[nxt] - at[here])
                        break
                    here, gone = nxt, gone + gap(nxt, here)
                    if gone >= 8.0:
                        break
                point = at[here] if point is None else point
                for root, anchor, path in options:
                    if root == child:
                        continue
                    angle = 0.5 * (1 - float(np.clip(unit(point - at[source]) @ unit(point - at[anchor]), -1, 1)))
                    length = max(0.0, gap(child, anchor) - gap(child, source)) / 8
                    met = plain_penalty(at, parent, kids, source, child, anchor) if crossing else 0.0
                    rank = (0.45 * path / 8 + 0.35 * angle + 0.15 * length + 0.05 * met, path, gap(child, anchor), child, anchor)
                    best = rank if best is None or rank < best else best
            if best is None:
                return None
            *_, child, anchor = best
            kids[source].remove(child)
            kids[anchor].append(child)
            parent[child] = anchor
            kind[anchor] = 5
            moves.append((source, child, anchor))
    return moves


def test_clustered_relinking_equals_whole_tree_search(make):
    groups = {f"t{s}": relink_tree(s) for s in range(12)}
    groups["stuck"] = [(1, 1, 0, 0, 0, 1, -1), (2, 5, 1000, 0, 0, 1, 1)] + [(i, 6, 2000, 100 * i, 0, 1, 2) for i in (3, 4, 5)]
    nodes = make(groups)
    out, steps, log = relink.relink(nodes)
    want = {n: plain_relink(rows) for n, rows in groups.items()}
    assert any(m is None for m in want.values()) and sum(bool(m) for m in want.values()) > 3
    got = {n: set() for n in groups}
    for s in steps.collect():
        got[s.neuron].add((s.type5_node, s.moved_child, s.new_parent))
    assert got == {n: set(m or []) for n, m in want.items()}
    method = {r.neuron: r.output_method for r in log.collect()}
    assert all((method[n] == "fallback_copy") == (want[n] is None) for n in groups)
    for r in relink.validate(nodes, out).collect():
        assert (r.id_mismatch, r.repeated_ids, r.missing_parents) == (0, 0, 0)
        assert r.unresolved == 0 or want[r.neuron] is None
    records = {(r.neuron, r.type5_node): r for r in relink.node_records(nodes, out, steps).collect()}
    assert all(r.n_direct_children_after == 2 and r.n_direct_children_before == 2 + r.n_relinked_branches for r in records.values())
    flat = {f"f{s}": [(i, k, x * 0.2, y * 0.2, 20 * math.sin(i), r, p) for i, k, x, y, _, r, p in relink_tree(s)] for s in range(8)}
    for trees in (groups, flat):
        crossed = {n: set() for n in trees}
        for s in relink.relink_steps(make(trees), check_crossing=True).filter("NOT failed").collect():
            assert 0 <= s.crossover_cost <= 1
            crossed[s.neuron].add((s.type5_node, s.moved_child, s.new_parent))
        for n, rows in trees.items():
            moves = plain_relink(rows, crossing=True)
            assert moves is None or crossed[n] == set(moves)


def thick_core(stub_um=3.0, soma_type=1, stubs=4):
    """Thick chain 1-5 (1 um steps), thin stubs on 2-5, a long thin trunk on node 3."""
    rows = [(i, soma_type if i == 1 else 0, 1000 * (i - 1), 0, 0, 2000, i - 1 if i > 1 else -1) for i in range(1, 6)]
    for s in range(stubs):
        for j in range(8):
            node = 100 * (s + 1) + j
            rows.append((node, 0, 1000 * (s + 1), (j + 1) * stub_um * 125, 300 * s, 200, s + 2 if j == 0 else node - 1))
    for j in range(300):
        rows.append((1000 + j, 0, 2000, 0, -1000 * (j + 1), 200, 3 if j == 0 else 999 + j))
    return rows


def test_soma_pruning(make):
    broken = [(9999, 0, 1, 1, 1, 1, 8888)]
    nodes = make({
        "cut": thick_core() + broken, "nosoma": thick_core(soma_type=0), "long": thick_core(stub_um=60.0, stubs=1),
        "shifted": [(0, 0, -1000, 0, 0, 200, -1)] + [(*r[:6], 0) if r[0] == 1 else r for r in thick_core()], "lone": [(1, 1, 0, 0, 0, 1, -1)],
        "bare": [(1, 1, 0, 0, 0, 200, -1), (2, 0, 500, 0, 0, 1, 1), (3, 0, 900, 0, 0, 1, 2)],
    })
    out, log, exits = soma.prune_somas(nodes)
    got = {r.neuron: r for r in log.collect()}
    assert {n: (r.status, r.skip_category) for n, r in got.items()} == {
        "cut": ("modified", None), "nosoma": ("skipped", "soma_count"), "long": ("skipped", "long_submajor_exit"),
        "shifted": ("skipped", "soma_not_root"), "lone": ("skipped", "no_radius"), "bare": ("skipped", "large_soma_primary_neurite_axis_span"),
    }
    kept = {r.id for r in out.filter("neuron = 'cut'").collect()}
    assert kept == {1, 2, 3} | set(range(1000, 1300))
    assert got["cut"].deleted_nodes == 2 + 32 + 1 and got["cut"].soma_core_nodes >= 5
    assert got["cut"].retained_major_exit_ids == str(got["cut"].primary_exit_id)
    assert out.filter("neuron = 'long'").count() == len(thick_core(stubs=1))
    orphans = out.filter("neuron = 'cut' AND parent <> -1").select(F.col("parent").alias("id")).subtract(out.filter("neuron = 'cut'").select("id"))
    assert orphans.count() == 0


def plain_clusters(points, eps, least):
    """Density clusters by growing one after the other from all pairs."""
    near = [[j for j, q in enumerate(points) if math.dist(p, q) <= eps] for p in points]
    label, found = {}, 0
    for i in range(len(points)):
        if i in label or len(near[i]) < least:
            continue
        todo = [i]
        label[i] = found
        for at in todo:
            if len(near[at]) >= least:
                for j in near[at]:
                    if j not in label:
                        label[j] = found
                        todo.append(j)
        found += 1
    return [label.get(i, -1) for i in range(len(points))]


def test_density_clusters():
    line = np.array([[0.0, 0, 0], [1, 0, 0], [2, 0, 0], [10, 0, 0], [11, 0, 0], [12, 0, 0], [30, 0, 0]])
    assert list(soma_growth.grid_clusters(line, 1.0, 3)) == [0, 0, 0, 1, 1, 1, -1]
    rng = np.random.default_rng(2)
    for n in (1, 5, 40, 150, 300):
        for eps in (0.3, 1.0, 2.5):
            points = np.round(rng.normal(0, 3, (n, 3)), 1)
            assert list(soma_growth.grid_clusters(points, eps, 3)) == plain_clusters(points.tolist(), eps, 3)
    chain = np.c_[np.arange(3000) * 0.9, np.zeros((3000, 2))]
    assert set(soma_growth.grid_clusters(chain, 1.0, 3)) == {0}


def plain_core(rows, rules):
    """Core growth node by node with sets; rows: id -> (parent, xyz, edge, cable, soma distance, ratio), soma first."""
    kids = {i: [c for c in rows if rows[c][0] == i] for i in rows}
    ratio = {i: r[5] for i, r in rows.items()}

    def thin_ahead(node):
        path = [node]
        while len(path) < 10 and kids[path[-1]]:
            path.append(max(kids[path[-1]], key=lambda c: rows[c][3]))
        if ratio[node] >= 2:
            return False
        for length, least, share in ((5, 4, 0.8), (10, 6, 0.75)):
            told = [ratio[p] for p in path[:length] if not math.isnan(ratio[p])]
            if len(told) < least or np.median(told) > 1.5 or sum(v <= 1.5 for v in told) / len(told) < share:
                return False
        return True

    soma_id = next(iter(rows))
    core = {soma_id}
    while True:
        found, ways = [], {}
        for gate in sorted(c for i in core for c in kids[i] if c not in core):
            todo = [(gate, [gate])]
            while todo:
                node, way = todo.pop()
                if rows[node][4] > 20:
                    continue
                if thin_ahead(node):
                    found.append(node)
                    ways[node] = way
                else:
                    todo += [(c, [*way, c]) for c in reversed(kids[node]) if c not in core]
        best = None
        if len(found) >= 3:
            points = [rows[f][1] for f in found]
            gaps = [g for i, p in enumerate(points) if (g := min(math.dist(p, q) for j, q in enumerate(points) if j != i)) > 0]
            eps = 2 * float(np.quantile(gaps, 0.3)) if gaps else 0
            if eps > 0:
                label = plain_clusters(points, eps, 3)
                to_core = [min(math.dist(p, rows[c][1]) for c in core) for p in points]
                for k in range(max(label) + 1):
                    own = [i for i in range(len(found)) if label[i] == k]
                    good = [found[i] for i in own if sum(ratio[w] <= 1.5 for w in ways[found[i]]) <= max(2, math.ceil(0.4 * len(ways[found[i]])))]
                    if len(good) >= 3 and min(to_core[i] for i in own) <= 8 * eps:
                        middle = np.mean([points[i] for i in own], axis=0)
                        rank = (float(np.median([to_core[i] for i in own])), -len(good), float(np.median([math.dist(points[i], middle) for i in own])), k)
                        if best is None or rank < best[0]:
                            best = (rank, good)
        if best is None:
            break
        core |= {w for g in best[1] for w in ways[g]}
    if len(core) == 1:
        todo = [(c, rows[c][2]) for c in kids[soma_id]]
        for node, cable in todo:
            if cable <= 20 and rows[node][4] <= 5 and ratio[node] >= 1.8:
                core.add(node)
                todo += [(c, cable + rows[c][2]) for c in kids[node]]
    return core


@pytest.mark.parametrize("seed", range(30))
def test_core_growth_equals_plain_sets(seed):
    rng = random.Random(seed)
    n = rng.choice([3, 30, 120, 250])
    at, parent = {0: (0.0, 0.0, 0.0)}, {0: -1}
    step = rng.choice([0.3, 0.8])
    for i in range(1, n):
        parent[i] = rng.choice([i - 1] * 6 + [rng.randrange(i)] * rng.choice([1, 3]))
        at[i] = tuple(c + rng.gauss(0, step) for c in at[parent[i]])
    edge = {i: math.dist(at[i], at[max(parent[i], 0)]) for i in at}
    cable = dict(edge)
    for i in range(n - 1, 0, -1):
        cable[parent[i]] += cable[i]
    thick = rng.choice([0.3, 0.6])
    ratio = {i: float("nan") if i == 0 or rng.random() < 0.05 else (rng.uniform(1.6, 4) if rng.random() < thick * math.exp(-math.dist(at[i], at[0]) / 3) else rng.uniform(0.5, 1.6)) for i in at}
    rows = {i: (parent[i], at[i], edge[i], cable[i], math.dist(at[i], at[0]), ratio[i]) for i in at}
    pdf = pd.DataFrame([("n", i, i, p, 1 if i == 0 else 0, *xyz, 1.0, e, c, d, r) for i, (p, xyz, e, c, d, r) in rows.items()],
        columns=["neuron", "id", "row_idx", "parent", "type", "x", "y", "z", "radius", "edge_length", "cable", "soma_dist", "ratio"])
    got = soma_growth.core_of(pdf.sample(frac=1, random_state=seed))
    assert set(got["id"]) == plain_core(rows, soma_growth.Rules())


def test_release_rules(make):
    nodes = make({"a": [(1, 0, 0, 0, 0, 1, -1), (2, 0, 0, 0, 0, 1, 1), (3, 6, 0, 0, 0, 1, 2), (4, 6, 0, 0, 0, 1, 2)],
                  "b": [(1, 1, 0, 0, 0, 1, -1), (2, 1, 0, 0, 0, 1, 1), (3, 6, 0, 0, 0, 1, 1)], "c": [(1, 0, 0, 0, 0, 1, -1), (2, 0, 0, 0, 0, 1, -1)]})
    released = repair.release_types(nodes, F.col("neuron") != "b")
    assert {(r.neuron, r.id): r.final_type for r in released.filter("neuron <> 'c'").collect()} == {
        ("a", 1): 1, ("a", 2): 5, ("a", 3): 6, ("a", 4): 6, ("b", 1): 5, ("b", 2): 0, ("b", 3): 6}
    assert {r.neuron: r.error for r in repair.release_log(released).collect()} == {"a": None, "b": None, "c": "expected 1 root, found 2"}


def test_rank_tests(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4)] + [("b", v) for v in (3, 5, 6, 7, 8)], "g string, v int")
    r = statistics.mann_whitney(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    assert (r.n1, r.n2, r.u) == (4, 5, 1.5)
    assert r.rank_biserial == pytest.approx(2 * 1.5 / 20 - 1)
    # exact distributions by enumeration of tiny cases
    assert stats.rank_sum_p(2, 2, 4, 0) == pytest.approx(2 / 6)
    assert stats.signed_rank_p(3, 6, 0, 0) == pytest.approx(2 / 8)
    assert stats.signed_rank_p(3, 6, 0, 0, zeros=1) == pytest.approx(math.erfc(3 / math.sqrt(3.5) / math.sqrt(2)))
    # every arrangement of three among five
    us = [sum(x) - 6 for x in itertools.combinations(range(1, 9), 3)]
    for u in range(16):
        assert stats.rank_sum_p(3, 5, u, 0) == pytest.approx(min(1, 2 * sum(x >= max(u, 15 - u) for x in us) / len(us)))
    assert stats.rank_sum_p(1, 999, 0, 0) == pytest.approx(2 / 1000)
    # t tails with closed forms: one, two and four degrees of freedom
    for rho in (0.05, -0.3, 0.8, 0.999):
        r = abs(rho)
        assert stats.correlation_p(3, rho) == pytest.approx(1 - 2 / math.pi * math.asin(r), rel=1e-9)
        assert stats.correlation_p(4, rho) == pytest.approx(1 - r, rel=1e-9)
        assert stats.correlation_p(6, rho) == pytest.approx(1 - r * (3 - r * r) / 2, rel=1e-9)
    assert stats.correlation_p(2_000_000, 0.001) == pytest.approx(math.erfc(1), rel=1e-4)
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 1.0), (4.0, 9.0)], "x double, y double")
    w = statistics.signed_rank(pairs, "x", "y").first()
    assert (w.n_pairs, w.n, w.w_plus, w.w_minus) == (4, 3, 4.0, 2.0)
    same = statistics.signed_rank(pairs, "x", "x").first()
    assert (same.n, same.rank_biserial, same.p_value) == (0, 0.0, 1.0)


def plain_sign_test(values, draws, seed):
    names = sorted(values)
    mean = lambda signs: round(sum(s * values[n] for s, n in zip(signs, names)) / len(names), 9)
    flip = lambda d, n: 1 if hashlib.md5(f"{seed}:{d}:{n}".encode()).hexdigest() < "8" else -1
    seen = abs(mean([1] * len(names)))
    return (1 + sum(abs(mean([flip(d, n) for n in names])) >= seen for d in range(draws))) / (draws + 1)


def plain_label_test(similarity, draws, seed):
    names = sorted({a for a, _ in similarity})
    seen = round(sum(similarity[n, n] for n in names) / len(names), 9)
    hits = 0
    for d in range(draws):
        dealt = sorted(names, key=lambda n: hashlib.md5(f"{seed}:{d}:{n}".encode()).hexdigest())
        hits += round(sum(similarity[a, b] for a, b in zip(names, dealt)) / len(names), 9) >= seen
    return (1 + hits) / (draws + 1)


def test_permutations_equal_plain_loops(spark):
    rng = np.random.default_rng(3)
    values = {n: float(v) for n, v in zip(("ME", "LO", "AL", "GNG", "EB", "FB", "NO"), rng.normal(0.4, 1, 7))}
    metrics = spark.createDataFrame([*values.items(), ("ELSEWHERE", 9.0), ("PB", None)], "neuropil string, delta_post_minus_pre double")
    row = statistics.sign_permutation(metrics, draws=300, seed=5).first()
    assert (row.n, row.mean_delta) == (7, pytest.approx(np.mean(list(values.values())))) and row.permutation_p == pytest.approx(plain_sign_test(values, 300, 5))
    assert statistics.sign_permutation(metrics.limit(0)).first()[:] == (0, None, None)
    names = [f"r{i}" for i in range(6)]
    similar = {(a, b): float(rng.uniform() + (a == b) * 0.3) for a in names for b in names}
    pairs = spark.createDataFrame([(a, b, a == b, s) for (a, b), s in similar.items()], "pre_region string, post_region string, same_region boolean, similarity double")
    row = statistics.label_permutation(pairs, draws=300, seed=8).first()
    assert row.n_regions == 6 and row.permutation_p == pytest.approx(plain_label_test(similar, 300, 8))
    assert statistics.label_permutation(pairs.limit(0)).first()[:] == (0, None, None)
    told = statistics.same_or_different(pairs).first()
    assert (told.n1, told.n2) == (6, 30) and told.same_mean == pytest.approx(np.mean([similar[n, n] for n in names]), abs=1e-9)


def test_crossings_of_a_step_are_measured_together(monkeypatch):
    """The gaps of all moves that can still win are one array job a step, however many branches and anchors there are."""
    rng, calls = random.Random(11), []
    gaps = relink.segment_gaps
    monkeypatch.setattr(relink, "segment_gaps", lambda *a: calls.append(len(a[0])) or gaps(*a))
    rows = [(0, 0, -1, 0)] + [(i, i, 0 if i < 6 else i - 5, 5) for i in range(1, 26)]
    at = {i: [rng.uniform(-900, 900) for _ in "xyz"] for i in range(26)}
    pdf = pd.DataFrame([
        {"neuron": 1, "cluster": 0, "id": i, "row_idx": r, "parent": p, "type": 5 if i == 0 else 0, "is_target": i == 0, **dict(zip("xyz", at[i])),
         **{f"p_{c}": at[p][k] if p >= 0 else float("nan") for k, c in enumerate("xyz")}} for i, r, p, _ in rows
    ])
    steps = relink._Cluster(pdf, True).resolve()
    assert len(steps) == 3 and not any(s["failed"] for s in steps)
    assert len(calls) <= len(steps)


def test_short_neurons_are_relinked_in_their_frame(make, monkeypatch):
    """Neurons that fit a frame take no traversal by joins, and longer ones beside them come out the same."""
    groups = {f"t{s}": relink_tree(s) for s in (0, 3, 5, 8)}
    bush = [(1, 1, 0, 0, 0, 1, -1), (2, 5, 1000, 0, 0, 1, 1)] + [(i, 0, 2000 + i, 300 * i, 0, 1, 2 if i < 6 else i - 3) for i in range(3, 12)]
    groups["bush"] = bush
    groups["stuck"] = [(1, 1, 0, 0, 0, 1, -1), (2, 5, 1000, 0, 0, 1, 1)] + [(i, 6, 2000, 100 * i, 0, 1, 2) for i in (3, 4, 5)]
    groups["twice"] = [*bush, bush[-1]]
    groups["lost"] = [*bush, (40, 0, 0, 0, 0, 1, 39)]
    groups["ring"] = [*bush, (40, 0, 0, 0, 0, 1, 41), (41, 0, 0, 0, 0, 1, 40)]
    groups["late root"] = bush[::-1]
    nodes = make(groups)
    rows = lambda tables: [sorted(map(str, t.select(*sorted(t.columns)).collect())) for t in tables]
    with monkeypatch.context() as patch:
        patch.setattr(topology, "CHUNK_ROWS", 64)
        mixed = rows(relink.relink(nodes))
    by_joins = []
    monkeypatch.setattr(topology, "traverse", lambda *a, **k: by_joins.append(a))
    whole = relink.relink(nodes)
    assert rows(whole) == mixed and not by_joins
    method = {r.neuron: r.output_method for r in whole[2].collect()}
    assert {n for n in ("bush", "stuck", "twice", "lost", "ring", "late root") if method[n] == "relinked"} == {"bush", "late root"}
    assert whole[0].filter("neuron = 'twice' AND position <> row_idx").isEmpty() and whole[1].filter("neuron = 'bush'").count() == 1


def test_relink_validation_is_one_grouping(make):
    before = make({"a": [(i, 5, 0, 0, 0, 1, i - 1 if i > 1 else -1) for i in range(1, 5)], "b": [(1, 1, 0, 0, 0, 1, -1)], "c": [(1, 1, 0, 0, 0, 1, -1)]})
    after = make({"a": [(1, 5, 0, 0, 0, 1, -1), (2, 5, 0, 0, 0, 1, 1), (3, 0, 0, 0, 0, 1, 1), (3, 0, 0, 0, 0, 1, 1), (9, 0, 0, 0, 0, 1, 8), (10, 0, 0, 0, 0, 1, 8)], "b": [(1, 1, 0, 0, 0, 1, -1)]})
    told = relink.validate(before, after)
    assert {r.neuron: r[1:] for r in told.collect()} == {"a": (3, 1, 2, 1), "b": (0, 0, 0, 0), "c": (1, 0, 0, 0)}
    assert "Join" not in told._jdf.queryExecution().executedPlan().toString()


def test_node_facts_of_whole_neurons_take_one_shuffle_and_equal_those_by_joins(make):
    groups = {}
    for seed in range(4):
        rng = random.Random(seed)
        rows = [(1, 1, 0.0, 0.0, 0.0, 900.0, -1)]
        for i in range(2, 80):
            rows.append((i, rng.choice([0, 5, 6]), *(rng.gauss(0, 9000) for _ in "xyz"), rng.choice([0.0, 50.0, 60.0, 300.0]), rng.randrange(1, i)))
        groups[f"n{seed}"] = rows
    groups["ring"] = [(1, 1, 0, 0, 0, 9, -1), (2, 0, 9, 0, 0, 5, 3), (3, 0, 9, 9, 0, 5, 2), (4, 0, 1, 0, 0, 5, 1), (5, 0, 3, 0, 0, 7, 4), (6, 0, 3, 0, 0, 5, 99)]
    groups["bare"] = [(1, 1, 0, 0, 0, 9, -1), (2, 0, 9, 0, 0, 0, 1)]
    groups["none"] = [(1, 0, 0, 0, 0, 9, -1)]
    nodes = make(groups).withColumn("y", F.expr("CASE WHEN neuron = 'n2' AND id = 20 THEN NULL ELSE y END"))
    roots = soma.soma_roots(nodes)
    rows = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*sorted(df.columns)).collect())
    for bound in (None, 100):
        whole = soma.node_facts(nodes, roots, bound)
        assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 3
        by_joins = rows(soma._facts_by_joins(nodes, roots.select("neuron", "soma_x", "soma_y", "soma_z"), bound))
        assert rows(whole) == by_joins and len(by_joins) == 4 * 79 + 9
