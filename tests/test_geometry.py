"""Nearest joins, mesh distances, walks and retrieval against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborspark.operators import mesh, morphology, nearest, neuropil, qc, retrieval, synapse


def test_nearest_matches_brute_force(spark):
    rng = random.Random(1)
    spots = [(rng.gauss(0, 3), rng.gauss(0, 3), rng.gauss(0, 30)) for _ in range(400)] + [(900.0, 0.0, 0.0)]
    items = [("a" if i % 4 else "b", i, *p) for i, p in enumerate(spots)]
    items += [("a", 1000, *spots[1])]  # same place, later row
    probes = [("ab"[i % 2], i, rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(-90, 90)) for i in range(60)]
    probes += [("a", 99, *spots[1]), ("c", 100, 0.0, 0.0, 0.0)]
    left = spark.createDataFrame(probes, "k string, pid long, px double, py double, pz double")
    right = spark.createDataFrame(items, "k string, row_idx long, x double, y double, z double")
    for n in (1, 3):
        got = {}
        for r in nearest.nearest(left, right, ["k"], k=n, cell=0.5).orderBy("nth").collect():
            got.setdefault(r.pid, []).append((r.row_idx, r.distance))
        assert 100 not in got
        for k, pid, *p in probes[:-1]:
            ranked = sorted((math.dist(p, q), i) for kk, i, *q in items if kk == k)[:n]
            assert [i for i, _ in got[pid]] == [i for _, i in ranked]
            assert [d for _, d in got[pid]] == pytest.approx([d for d, _ in ranked])


def test_missing_synapses_give_zero_counts(make, spark):
    nodes = make({"a": [(1, 1, 0, 0, 0, 1, -1), (2, 0, 1000, 0, 0, 1, 1)], "b": [(1, 0, 0, 0, 0, 1, -1)]})
    syn = spark.createDataFrame([("a", 1, "pre", 500.0, 0.0, 0.0), ("a", 2, "post", 990.0, 0.0, 0.0)], "neuron string, syn_id long, syn_type string, x double, y double, z double")
    detail = synapse.assign(nodes, syn)
    counted = synapse.node_counts(nodes, detail)
    got = {(r.neuron, r.id): (r.pre_syn_count, r.post_syn_count, r.type) for r in synapse.visual_type(counted).collect()}
    assert got == {("a", 1): (1, 0, 1), ("a", 2): (0, 1, 3), ("b", 1): (0, 0, 0)}


def segment_distance(p, a, b):
    ab, ap = b - a, p - a
    t = 0.0 if not ab @ ab else min(1.0, max(0.0, ap @ ab / (ab @ ab)))
    return float(np.linalg.norm(ap - t * ab))


def triangle_distance(p, u, v, w):
    best = min(segment_distance(p, u, v), segment_distance(p, v, w), segment_distance(p, u, w))
    n = np.cross(v - u, w - u)
    if n @ n:
        foot = p - n * ((p - u) @ n) / (n @ n)
        hands = [np.cross(b - a, foot - a) @ n for a, b in ((u, v), (v, w), (w, u))]
        if min(hands) >= 0:
            best = min(best, abs((p - u) @ n) / math.sqrt(n @ n))
    return best


def test_triangle_distance(spark):
    rng = np.random.default_rng(3)
    faces = [("n", i, *rng.uniform(0, 100, 9)) for i in range(20)]
    samples = [("n", i, 0, *rng.uniform(-30, 130, 3)) for i in range(60)]
    f = spark.createDataFrame([(a, b, *map(float, c)) for a, b, *c in faces], "neuron string, face_id long, " + ", ".join(f"{v}{c} double" for v in "uvw" for c in "xyz"))
    s = spark.createDataFrame([(a, b, k, *map(float, c)) for a, b, k, *c in samples], "neuron string, child_id long, k int, sx double, sy double, sz double")
    got = {r.child_id: r.center_dist for r in mesh.to_surface(s, f, cell=10.0).collect()}
    for _, i, _, *p in samples:
        want = min(triangle_distance(np.array(p), *np.array(c).reshape(3, 3)) for _, _, *c in faces)
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_surface_samples_follow_area(spark):
    cols = "neuron string, face_id long, " + ", ".join(f"{v}{c} double" for v in "uvw" for c in "xyz")
    big, small = (0.0, 0, 0, 30, 0, 0, 0, 30, 0), (0.0, 0, 5, 10, 0, 5, 0, 10, 5)
    f = spark.createDataFrame([("n", 1, *map(float, big)), ("n", 2, *map(float, small))], cols)
    got = mesh.sample_surface(f, count=100)
    assert {r.face_id: r["count"] for r in got.groupBy("face_id").count().collect()} == {1: 90, 2: 10}
    assert got.filter("face_id = 1 AND (px < 0 OR py < 0 OR px + py > 30.000001 OR pz <> 0)").count() == 0


def test_weighted_quantile_clamps(spark):
    df = spark.createDataFrame([("n", 1.0, 1.0), ("n", 2.0, 1.0), ("n", 4.0, 2.0), ("n", float("nan"), 1.0)], "k string, v double, w double")
    probs = {"lo": 0.01, "mid": 0.5, "q": 0.2, "hi": 0.99}
    got = mesh.weighted_quantiles(df, ["k"], "v", "w", probs).first()
    want = np.interp([0.01, 0.5, 0.2, 0.99], [0.125, 0.375, 0.75], [1.0, 2.0, 4.0])
    assert list(got)[1:] == pytest.approx(list(want))


def test_right_angle_deflection(make):
    # trunk along x, one daughter straight on, one at a right angle; edges of 1 um
    rows = [(i, 0, i * 1000, 0, 0, 1, i - 1 if i else -1) for i in range(4)]
    rows += [(10 + i, 0, 3000 + 1000 * i, 0, 0, 1, 3 if i == 1 else 9 + i) for i in (1, 2, 3)]
    rows += [(20 + i, 0, 3000, 1000 * i, 0, 1, 3 if i == 1 else 19 + i) for i in (1, 2, 3)]
    got = {r.child: r.angle_deg for r in morphology.deflection_angles(make(rows)).collect()}
    assert got == {11: pytest.approx(0.0, abs=1e-5), 21: pytest.approx(90.0)}


def brute_angles(rows, reach=2.0):
    at = {r[0]: np.array(r[2:5]) / 1000 for r in rows}
    parent = {r[0]: r[6] for r in rows}
    kids = {}
    for r in rows:
        kids.setdefault(r[6], []).append(r[0])

    def up_point(node):
        left, here = reach, node
        while parent[here] != -1:
            step = at[parent[here]] - at[here]
            size = np.linalg.norm(step)
            if size >= left:
                return at[here] + step * left / size
            left, here = left - size, parent[here]
        return at[here]

    def down_point(fork, child):
        left, here, there = reach, fork, child
        while True:
            step = at[there] - at[here]
            size = np.linalg.norm(step)
            if size >= left:
                return at[here] + step * left / size
            left -= size
            options = kids.get(there, [])
            if not options:
                return at[there]
            unit = step / size
            best = max(options, key=lambda k: (at[k] - at[there]) @ unit / np.linalg.norm(at[k] - at[there]))
            here, there = there, best

    out = {}
    for node, ks in kids.items():
        if node == -1 or len(ks) < 2 or parent[node] == -1:
            continue
        a = at[node] - up_point(node)
        for k in ks:
            d = down_point(node, k) - at[node]
            out[k] = math.degrees(math.acos(max(-1, min(1, a @ d / np.linalg.norm(a) / np.linalg.norm(d)))))
    return out


def test_deflection_matches_brute_force(make):
    rng = random.Random(11)
    rows = [(1, 0, 0.0, 0.0, 0.0, 1, -1)]
    for i in range(2, 120):
        base = rows[-1] if rng.random() < 0.7 else rng.choice(rows)
        rows.append((i, 0, base[2] + rng.gauss(0, 500), base[3] + rng.gauss(0, 500), base[4] + rng.gauss(0, 500), 1, base[0]))
    want = brute_angles(rows)
    got = {r.child: r.angle_deg for r in morphology.deflection_angles(make(rows)).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-4) for k in want)


def test_minhash_tracks_jaccard_and_rerank_finds_itself(make, spark):
    rng = random.Random(5)

    def path(seed):
        r, at, rows = random.Random(seed), [0.0, 0.0, 0.0], []
        for i in range(60):
            rows.append((i + 1, 0, *at, 1, i if i else -1))
            at = [a + r.gauss(300, 1500) for a in at]
        return rows

    raw = {f"n{i}": path(i) for i in range(6)}
    moved = {n: [(i, t, x + rng.gauss(0, 20), y, z, r, p) for i, t, x, y, z, r, p in rows] for n, rows in raw.items()}
    rn, mn = make(raw), make(moved)
    rv, mv = retrieval.voxels(rn), retrieval.voxels(mn)
    c, q = retrieval.signatures(rv), retrieval.signatures(mv)
    pairs = retrieval.with_pair(q, c, retrieval.top_candidates(q, c, 3))
    assert retrieval.incomplete(q, pairs, 3).count() == 0
    assert {r.error for r in retrieval.incomplete(q, retrieval.with_pair(q, c, retrieval.top_candidates(q, c, 6)), 6).collect()} == {"needs 6 competitors, found 5"}
    assert {r.error for r in retrieval.incomplete(q, pairs.limit(0), 3).collect()} == {"no original of the same name"}
    scored = retrieval.exact_jaccard(pairs, mv, rv).collect()
    sets = lambda rows: {tuple(math.floor(v / 5000) for v in r[2:5]) for r in rows}
    for r in scored:
        a, b = sets(moved[r.query]), sets(raw[r.candidate])
        assert r.jaccard == pytest.approx(len(a & b) / len(a | b))
        assert abs(r.minhash_jaccard - r.jaccard) < 0.25
    shapes = retrieval.shape_scores(pairs, retrieval.dotprops(retrieval.resampled(mn)), retrieval.dotprops(retrieval.resampled(rn)))
    summary = retrieval.search_summary(retrieval.ranked(shapes)).collect()
    assert all(r.top1_is_same_name and r.paired_score > 0.8 for r in summary)
    assert retrieval.retention(retrieval.search_summary(retrieval.ranked(shapes)), rows=6).first().top1_rate == 1.0


def test_resampling_is_even(make):
    rows = [(1, 0, 0, 0, 0, 1, -1), (2, 0, 3000, 0, 0, 1, 1), (3, 0, 10_000, 0, 0, 1, 2)]
    got = sorted(r.x for r in retrieval.resampled(make(rows)).collect())
    assert got == pytest.approx([0, 2, 4, 6, 8, 10])


def test_full_size_mesh_queries(spark, tmp_path):
    from arborspark.plans.catalog import QUERIES

    given, folder = "/root/testdata/sf0.001", str(tmp_path)
    lines = spark.read.parquet(f"{given}/lineitem.parquet")
    lines.filter("l_suppkey = 1").orderBy("l_orderkey", "l_linenumber").limit(8).write.parquet(f"{folder}/lineitem.parquet")
    spark.read.parquet(f"{given}/supplier.parquet").filter("s_suppkey = 1").write.parquet(f"{folder}/supplier.parquet")
    edges = {r.child_id: r for r in QUERIES["edge_samples_full"](spark, folder).groupBy("child_id").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"), F.max("length_nm").alias("l")).collect()}
    assert len(edges) == 7 and max(r.n for r in edges.values()) > 4
    for r in edges.values():
        assert r.n == min(128, int(np.ceil(r.l / 250))) and abs(r.w - r.l) < 1e-2
    out = QUERIES["mesh_agreement_full"](spark, folder).collect()
    assert len(out) == 1 and out[0].n_surface_samples == 80_000 and out[0].n_center_samples == sum(r.n for r in edges.values())
    assert 0 <= out[0].cable_fit_fraction_250nm <= out[0].cable_fit_fraction_1000nm <= 1


def test_top_candidates_equal_all_pairs(spark):
    rng = random.Random(5)
    # few values, so many are held by more than two candidates; some neurons share nothing with any other
    sigs = {f"n{i:02}": [rng.randrange(4) if i % 5 else 100 * i + j for j in range(16)] for i in range(40)}
    table = spark.createDataFrame(list(sigs.items()), "neuron string, signature array<bigint>")
    for k in (3, 30, 50):
        got = {}
        for r in retrieval.top_candidates(table, table, k, split=2).orderBy("nth").collect():
            got.setdefault(r.query, []).append((r.candidate, r.minhash_jaccard))
        for q, a in sigs.items():
            scored = sorted((-sum(x == y for x, y in zip(a, b)) / 16, c) for c, b in sigs.items() if c != q)[:k]
            assert got[q] == [(c, -s) for s, c in scored]
    assert retrieval.top_candidates(table.limit(0), table, 3).count() == 0 and retrieval.top_candidates(table, table.limit(0), 3).count() == 0


def test_paired_sample(spark):
    names = spark.range(40).selectExpr("id AS neuron")
    sample = qc.paired_sample(names.union(names), names.filter("neuron % 3 > 0"), "neuron", 15, 7)
    order = sorted(range(40), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())[:15]
    assert {r.neuron: r.has_raw for r in sample.collect()} == {i: i % 3 > 0 for i in order}
    gone = sorted(i for i in order if i % 3 == 0)
    assert tuple(qc.sample_report(sample, "neuron").first()) == (15, 15 - len(gone), len(gone), ",".join(map(str, gone)))


@pytest.mark.parametrize("n", [1, 3])
def test_nearest_in_frames_slices_and_cells_agree(spark, monkeypatch, n):
    """Keys that fit a task, keys of many probes (in slices) and keys too large for a task, against all pairs."""
    rng = random.Random(n)
    place = lambda: tuple(rng.choice([rng.uniform(0, 9), float(rng.randrange(9))]) for _ in range(3))
    items = [(k, i, *place()) for k, many in (("a", 5), ("b", 1500), ("c", 90), ("lonely", 3)) for i in range(many)]
    probes = [(k, i, *place()) for k, many in (("a", 300), ("b", 200), ("c", 40), ("none", 3)) for i in range(many)]
    left, right = spark.createDataFrame(probes, "k string, pid long, px double, py double, pz double"), spark.createDataFrame(items, "k string, row_idx long, x double, y double, z double")
    want = {}
    for k, i, *p in probes:
        far = sorted((sum((a - b) ** 2 for a, b in zip(p, q)), j) for key, j, *q in items if key == k)[:n]
        want |= {(k, i, nth): (j, round(d**0.5, 9)) for nth, (d, j) in enumerate(far, 1)}
    for pack in (1 << 18, 64):
        monkeypatch.setattr(nearest, "PACK", pack)
        monkeypatch.setattr(nearest, "FRAME_ROWS", 128)
        got = nearest.nearest(left, right, ["k"], k=n, cell=1.0, keep=("px",)).collect()
        assert {(r.k, r.pid, r.nth): (r.row_idx, round(r.distance, 9)) for r in got} == want and len(got) == len(want)
        assert all(r.px == probes[[p[:2] for p in probes].index((r.k, r.pid))][2] for r in got[:20])


def test_triangle_squares_are_those_of_the_column(spark):
    rng = np.random.default_rng(5)
    corners = rng.uniform(-3, 3, (40, 9)).round(1)
    corners[::9, 3:6] = corners[::9, :3]  # without area
    faces = spark.createDataFrame([("n", i, *map(float, c)) for i, c in enumerate(corners)], "neuron string, face_id long, " + ", ".join(f"{v}{c} double" for v in "uvw" for c in "xyz"))
    prepared = mesh._prepared(faces)
    places = rng.uniform(-4, 4, (30, 3)).round(1)
    probes = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(places)], "pid long, px double, py double, pz double")
    want = {(r.pid, r.face_id): r.d for r in probes.crossJoin(prepared).select("pid", "face_id", mesh.triangle_distance2().alias("d")).collect()}
    told = prepared.orderBy("face_id").toPandas()
    got = mesh.triangle_squares(places, {c: told[c].to_numpy(dtype=float) for c in mesh.FACE_FIELDS})
    assert all(got[i, j] == d for (i, j), d in want.items())


def test_candidates_by_parts_match_all_pairs(spark, monkeypatch):
    rng = random.Random(8)
    sig = {f"n{i:02d}": [rng.randrange(4) for _ in range(16)] for i in range(40)}
    monkeypatch.setattr(retrieval, "TILE", 3)
    table = lambda names: spark.createDataFrame([(n, sig[n]) for n in names], "neuron string, signature array<bigint>")
    queries, held = list(sig)[:25], list(sig)[5:]
    for split in (4096, 7):
        got = {}
        for r in retrieval.top_candidates(table(queries), table(held), 6, split=split).collect():
            got.setdefault(r.query, {})[r.candidate] = r.minhash_jaccard
        for q in queries:
            far = sorted((-sum(a == b for a, b in zip(sig[q], sig[c])) / 16, c) for c in held if c != q)[:6]
            assert got[q] == {c: -d for d, c in far}
    plan = retrieval.top_candidates(table(queries), table(held), 6)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # candidates never meet once per equal place


def test_exact_jaccard_across_blocks(spark):
    rng = random.Random(9)
    cells = {n: {tuple(rng.randrange(-70, 70) // 30 * 30 + rng.randrange(3) for _ in range(3)) for _ in range(300)} for n in "abc"}
    vox = spark.createDataFrame([(n, *v) for n, vs in cells.items() for v in vs], "neuron string, vx long, vy long, vz long")
    pairs = spark.createDataFrame([(a, b) for a in "abc" for b in "abc"], "query string, candidate string")
    for r in retrieval.exact_jaccard(pairs, vox, vox).collect():
        a, b = cells[r.query], cells[r.candidate]
        assert r.shared == len(a & b) and r.jaccard == len(a & b) / len(a | b)


def test_radius_quantiles_equal_those_of_all_samples(spark, make):
    """Level edges, ties between edges, one value only, short edges: the narrowed search gives the quantiles of the whole window."""
    rng = random.Random(5)
    trees = {
        name: [(1, 1, 0, 0, 0, radius(), -1)] + [(i, 0, *(rng.uniform(0, 9000) for _ in "xyz"), radius(), rng.randrange(1, i)) for i in range(2, 60)]
        for name, radius in {"few": lambda: rng.choice([10.0, 20.0, 70.0]), "same": lambda: 5.0, "many": lambda: rng.uniform(-1, 100), "wide": lambda: 10 ** rng.uniform(-9, 9)}.items()
    }
    trees["pair"] = [(1, 1, 0, 0, 0, 3, -1), (2, 0, 100, 0, 0, 4, 1)]
    edges = mesh.sampled_edges(make(trees), spacing=100.0, most=16)
    probs = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q100": 1.0}
    whole = mesh.weighted_quantiles(mesh.samples_of(edges), ["neuron"], "radius", "weight", probs, ["child_id", "k"], rows=1)
    want = {r["neuron"]: r for r in whole.collect()}
    for rounds in (1, 2, 3):
        got = {r["neuron"]: r for r in mesh.radius_quantiles(edges, probs, bands=4, rounds=rounds).collect()}
        assert got.keys() == want.keys()
        for n in want:
            assert [got[n][q] for q in probs] == pytest.approx([want[n][q] for q in probs], rel=1e-9), n


def test_few_faces_with_many_points_spread_over_tasks(spark):
    corners = [[0.0, 0, 0, 1, 0, 0, 0, 1, 0]]
    faces = spark.createDataFrame([("n", 0, *map(float, corners[0]))], "neuron string, face_id bigint, " + ", ".join(f"{v}{c} double" for v in "uvw" for c in "xyz"))
    points = mesh.sample_surface(faces, count=3_000_000, rows=1)
    sizes = [r["n"] for r in points.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 3_000_000 and max(sizes) <= 2_000_000


def test_edge_overlap_equals_that_of_samples(spark, make):
    rng = random.Random(2)
    nodes = make([(1, 1, 0, 0, 0, 1, -1)] + [(i, 0, *(rng.uniform(0, 9000) for _ in "xyz"), 1, rng.randrange(1, i)) for i in range(2, 40)])
    faces = spark.createDataFrame([("n", 0, 1.0, 2.0, 3.0, 5000.0, 2.0, 3.0, 1.0, 4000.0, 6000.0)], "neuron string, face_id bigint, " + ", ".join(f"{v}{c} double" for v in "uvw" for c in "xyz"))
    edges = mesh.sampled_edges(nodes)
    got, want = mesh.edge_overlap(edges, faces).first(), mesh.overlap(mesh.samples_of(edges), faces).first()
    assert tuple(got)[1:] == pytest.approx(tuple(want)[1:])


def test_points_labelled_in_their_cell_shuffle_nothing(spark):
    """Labels equal those of the pair table, and the points go through no exchange."""
    rng = random.Random(8)
    boxes = spark.createDataFrame(
        [(f"R{i % 9}", *(v for _ in "xyz" for lo in [rng.uniform(-20, 20)] for v in (lo, lo + rng.uniform(0, 15)))) for i in range(25)],
        "region string, " + ", ".join(f"{side}_{a} double" for a in "xyz" for side in ("lo", "hi")),
    )
    points = spark.createDataFrame([(i, *(rng.uniform(-25, 40) for _ in "xyz")) for i in range(800)], "pid bigint, px double, py double, pz double")
    told = neuropil.label_in_boxes(points, boxes)
    want = neuropil.label_points(points, neuropil.regions_of_boxes(points, boxes))
    assert {(r["pid"], r["neuropil"]) for r in told.collect()} == {(r["pid"], r["neuropil"]) for r in want.collect()}
    plan = neuropil.label_in_boxes(points, F.broadcast(boxes))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Aggregate") <= 2 and plan.count("Join") == 1


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _wild_forest(seed, n=90):
    rng = random.Random(seed)
    rows = [(1, 0, 0.0, 0.0, 0.0, 1, -1)]
    for i in range(2, n):
        base = rows[-1] if rng.random() < 0.7 else rng.choice(rows)
        rows.append((i, 0, base[2] + rng.gauss(0, 500), base[3] + rng.gauss(0, 500), base[4] + rng.gauss(0, 500), 1, base[0]))
    rows[40] = (*rows[40][:6], 70)  # may close a loop
    return rows


def test_deflection_of_whole_neurons_takes_one_shuffle_and_equals_that_of_runs(make):
    nodes = make({f"n{i}": _wild_forest(i) for i in range(6)})
    nodes = nodes.withColumn("x", morphology.F.expr("CASE WHEN neuron = 'n1' AND id = 30 THEN NULL ELSE x END"))
    whole, runs = morphology.deflection_angles(nodes), morphology.deflection_angles(nodes, run_rows=16)
    assert _exchanges(whole) <= 1
    told = lambda df: sorted((r.neuron, r.fork, r.child, round(r.angle_deg, 6)) for r in df.collect())
    assert told(whole) == told(runs) and len(told(runs)) > 100
