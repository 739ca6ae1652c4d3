"""Text formats: scan modes, verbatim rewrite, round trip, logs, meshes, stream."""

import glob

from pyspark.sql import functions as F

from arborspark.functions.text import root_id, to_bool
from arborspark.operators import neuropil, qc, repair, topology
from arborspark.sources import swc, tables
from arborspark.streaming.ingest import ingest

BODY = "# header\n\n1 1 0 0 0 5 -1\n2.0 0  10 0 0 2 1 7 8\n3 6 20 0 0 1 2\n4 6 10 5 0 1 2.0\nbad line\n5 x 1 1 1 1 4\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_scan_modes(spark, tmp_path):
    write(tmp_path / "in" / "sub" / "11.swc", BODY)
    lines = swc.read_lines(spark, str(tmp_path / "in"))
    assert lines.select("neuron", "relative_path").distinct().collect() == [("11", "sub/11.swc")]
    parsed = swc.parse(lines)
    assert [r.id for r in swc.nodes(parsed).orderBy("row_idx").collect()] == [1, 2, 3, 4]
    assert swc.nodes(parsed).filter("id = 2").first().extra == ["7", "8"]
    strict = swc.problems(swc.parse(lines, "strict")).first()
    assert strict.error == "not numeric"
    assert swc.read_swc(spark, str(tmp_path / "in")).count() == 4


def test_verbatim_rewrite(spark, tmp_path):
    write(tmp_path / "in" / "11.swc", BODY)
    parsed = swc.parse(swc.read_lines(spark, str(tmp_path / "in")))
    changed = repair.retype_zero_branches(swc.nodes(parsed)).filter("changed")
    lines = swc.rewritten_lines(parsed, changed).orderBy("row_idx")
    want = BODY.rstrip("\n").split("\n")
    want[3] = "2.0 5 10 0 0 2 1 7 8"
    assert [r.line for r in lines.collect()] == want


def test_empty_duplicate_and_units(spark, tmp_path, make):
    write(tmp_path / "in" / "1.swc", "# nothing\n")
    write(tmp_path / "in" / "2.swc", "1 0 0 0 0 1 -1\n1 0 0 0 0 1 -1\n")
    found = {r.neuron: r.error for r in swc.problems(swc.parse(swc.read_lines(spark, str(tmp_path / "in")), "strict")).collect()}
    assert found == {"1": "No valid SWC nodes", "2": "Duplicate node IDs"}
    got = swc.to_nm(make([(1, 0, 1, 2, 3, -4, -1)]), "voxel", "um").first()
    assert (got.x, got.y, got.z, got.radius) == (4.0, 8.0, 120.0, 0.0)


def test_round_trip(spark, tmp_path, make):
    nodes = make({"7": [(1, 1, 0.12345, 0, 0, 5, -1), (2, 0, 1, 2, 3, 1, 1)], "8": [(1, 0, 9, 9, 9, 1, -1)]})
    swc.write_swc(nodes, str(tmp_path / "out"), header=swc.TYPE_LEGEND)
    (file,) = glob.glob(str(tmp_path / "out" / "neuron=7" / "part=0" / "*.txt"))
    text = open(file).read().splitlines()
    assert text[: len(swc.TYPE_LEGEND)] == list(swc.TYPE_LEGEND)
    assert text[-2:] == ["1 1 0.123 0.000 0.000 5.000 -1", "2 0 1.000 2.000 3.000 1.000 1"]


def test_metadata_synapses_log(spark, tmp_path):
    write(tmp_path / "m.tsv", "root_id\tnucleus_id\tsoma_x\tsoma_y\tsoma_z\n720575940600000001\t1\t250\t500\t25\n2\t2\t\t1\t1\n")
    meta = tables.read_soma_metadata(spark, str(tmp_path / "m.tsv"))
    got = repair.trusted_somas(meta).collect()
    assert [tuple(r) for r in got] == [("720575940600000001", 1.0, 2.0, 1.0)]
    twice = spark.createDataFrame([("7", 250.0, 0.0, 0.0, 2), ("7", 500.0, 0.0, 0.0, 9), ("7", 750.0, 0.0, 0.0, 4)], "root_id string, soma_x double, soma_y double, soma_z double, row_idx long")
    assert [r.meta_x_um for r in repair.trusted_somas(twice).collect()] == [2.0]
    write(tmp_path / "syn" / "5.txt", "#1 2 100 200 300\na b 1 2 3\n1 2 3\n0 0 4 5 6 9\n")
    syn = tables.read_synapses(spark, str(tmp_path / "syn"), "pre").orderBy("syn_index").collect()
    assert [(r.neuron, r.x, r.z) for r in syn] == [("5", 1.0, 3.0), ("5", 4.0, 6.0)]
    log = spark.createDataFrame([("a.swc", None), ("b.swc", "boom")], "relative_path string, error string")
    tables.write_log(log, str(tmp_path / "log"))
    files = spark.createDataFrame([("a.swc",), ("b.swc",), ("c.swc",)], "relative_path string")
    left = qc.remaining(files, tables.read_log(spark, str(tmp_path / "log")), "relative_path")
    assert sorted(r.relative_path for r in left.collect()) == ["b.swc", "c.swc"]
    one, two = (qc.fingerprint(f, ["relative_path"]).first().signature for f in (files, files.orderBy(F.desc("relative_path"))))
    assert one == two and one != qc.fingerprint(files.limit(2), ["relative_path"]).first().signature


def test_text_helpers(spark):
    df = spark.createDataFrame([("123",), ("x_720575940600000001_v2",), ("720575940600000001-720575940600000002",), ("12a",)], "s string")
    assert [r[0] for r in df.select(root_id(F.col("s"))).collect()] == ["123", "720575940600000001", None, None]
    df = spark.createDataFrame([("TRUE",), ("0",), ("1",), (None,)], "s string")
    assert [r[0] for r in df.select(to_bool(F.col("s"))).collect()] == [True, False, True, False]


def test_obj_mesh_containment(spark, tmp_path):
    cube = "".join(f"v {x} {y} {z}\n" for z in (0, 1) for y in (0, 1) for x in (0, 1))
    quads = "f 1 3 4 2\nf 5 6 8 7\nf 1 2 6 5\nf 3 7 8 4\nf 1 5 7 3\nf 2 4 8 6\n"
    write(tmp_path / "mesh" / "CUBE.obj", cube + quads)
    write(tmp_path / "mesh" / "TETRA.obj", "v 0 0 0\nv 4 0 0\nv 0 4 0\nv 0 0 4\nf 1/1 2/2 3/3\nf 1 2 4\nf 1 3 4\nf 2 3 4\n")
    faces = tables.read_obj_meshes(spark, str(tmp_path / "mesh"))
    assert faces.groupBy("region").count().orderBy("region").collect() == [("CUBE", 12), ("TETRA", 4)]
    points = spark.createDataFrame([(1, 0.5, 0.25, 0.3), (2, 2.0, 0.5, 0.5), (3, 0.9, 0.9, 0.9), (4, 3.0, 3.0, 3.0), (5, 0.9, 1.9, 1.0)], "pid long, px double, py double, pz double")
    labels = neuropil.label_points(points, neuropil.regions_of_points(points, faces, cell=0.7))
    got = {r.pid: r.neuropil for r in labels.collect()}
    assert got == {1: "CUBE|TETRA", 2: "TETRA", 3: "CUBE|TETRA", 4: "OUTSIDE", 5: "TETRA"}


def test_obj_relative_corners(spark, tmp_path):
    """Negative vertex numbers count back from their face, also between later vertices."""
    write(tmp_path / "mesh" / "A b.obj", "v 0 0 0\nv 1 0 0\nv 0 1 0\nf -3 -2 -1\nv 0 0 7\nf -1 1 2 -2\n")
    got = tables.read_obj_meshes(spark, str(tmp_path / "mesh")).orderBy("face_id")
    assert [(r.region, r.ux, r.uz, r.vx, r.vy, r.wx, r.wy) for r in got.collect()] == [("A b", 0, 0, 1, 0, 0, 1), ("A b", 0, 7, 0, 0, 1, 0), ("A b", 0, 7, 1, 0, 0, 1)]


def test_stream_ingest(spark, tmp_path):
    write(tmp_path / "in" / "11.swc", BODY)
    run = lambda: ingest(spark, str(tmp_path / "in"), str(tmp_path / "nodes"), str(tmp_path / "cp")).awaitTermination()
    run()
    write(tmp_path / "in" / "12.swc", "1 0 0 0 0 1 -1\n")
    run()
    got = spark.read.parquet(str(tmp_path / "nodes")).groupBy("neuron").count().orderBy("neuron").collect()
    assert got == [("11", 4), ("12", 1)]
    assert topology.child_counts(spark.read.parquet(str(tmp_path / "nodes"))).filter("n_children = 2").count() == 1


def test_a_point_on_the_mesh_is_inside(spark):
    """Sides, edges and corners of a box count as the SQL's BETWEEN does, whatever the cells."""
    from itertools import product

    from arborspark.operators import neuropil
    from arborspark.plans.forest import box_mesh

    box = spark.createDataFrame([("r", 0.25, 11.25, 20.5, 41.5, 0.05, 70.05)], "region string, lo_x double, hi_x double, lo_y double, hi_y double, lo_z double, hi_z double")
    axes = [(0.0, 0.25, 3.7, 11.25, 12.0), (20.4, 20.5, 27.3, 41.5, 41.6), (0.0, 0.05, 33.3, 70.05, 70.1)]
    rows = [(i, *map(float, p)) for i, p in enumerate(product(*axes))]
    points = spark.createDataFrame(rows, "pid long, px double, py double, pz double")
    inside = {i for i, x, y, z in rows if 0.25 <= x <= 11.25 and 20.5 <= y <= 41.5 and 0.05 <= z <= 70.05}
    for cell in (8.0, 0.5):
        got = [r.pid for r in neuropil.regions_of_points(points, box_mesh(box, "region"), cell=cell).collect()]
        assert len(got) == len(set(got)) and set(got) == inside
