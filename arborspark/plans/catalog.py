"""Every registered query: name -> callable(spark, folder) -> DataFrame.

All of them run over whole tables.  Doubles are rounded so that two engines
adding in different orders agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborspark.operators import (
    mesh, morphology, neuropil, qc, release_report, relink, repair, retrieval, soma, statistics, synapse, topology,
)
from arborspark.functions.text import root_id
from arborspark.plans import forest as inputs
from arborspark.sources.swc import node_line, to_nm

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, turn NaN into null and -0.0 into 0.0."""
    def one(f):
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() not in ("double", "float"):
            return c
        return (F.round(F.when(~F.isnan(c), c.cast("double")), digits) + F.lit(0.0)).alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def _assign(spark: SparkSession, folder: str) -> DataFrame:
    return synapse.assign(inputs.forest(spark, folder), inputs.synapses(spark, folder))


def _detail(spark: SparkSession, folder: str) -> DataFrame:
    """The assignment detail table, written once and read by every summary."""
    return inputs.once(spark, folder, "detail", lambda: _assign(spark, folder))


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    """The order count table, written once and read by every profile."""
    return inputs.once(spark, folder, "order_counts", lambda: neuropil.order_counts(_labelled(spark, folder)))


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of types 2-4 with branch order and region label."""
    nodes = inputs.typed_forest(spark, folder)
    target = nodes.filter(F.col("type").isin(2, 3, 4))
    points = target.select("neuron", "id", "type", *[(F.col(a) / 1000.0).alias(f"p{a}") for a in "xyz"])
    labels = neuropil.label_in_boxes(points, inputs.region_boxes(spark, folder))
    return labels.join(topology.branch_order(nodes), ["neuron", "id"]).select(
        "neuron", F.col("type").alias("node_type"), "neuropil", "branch_order"
    )


# ----------------------------------------------------------- counts, retyping

@query
def child_counts(spark, folder):
    return topology.child_counts(inputs.forest(spark, folder)).select("neuron", "id", "n_children")


@query
def branch_degree_distribution(spark, folder):
    per = morphology.degree_counts(inputs.forest(spark, folder).withColumn("dataset", F.col("neuron") % 3), ("dataset",))
    return tidy(morphology.degree_distribution(per, "dataset"))


@query
def retype_type0(spark, folder):
    return repair.retype_zero_branches(inputs.forest(spark, folder)).select("neuron", "id", "n_children", "new_type", "changed")


@query
def type0_file_log(spark, folder):
    return repair.zero_branch_log(inputs.forest(spark, folder))


@query
def retype_untrusted_soma(spark, folder):
    return repair.retype_somas(inputs.forest(spark, folder)).filter("changed").select("neuron", "id", "new_type")


@query
def retype_0_5(spark, folder):
    kept = inputs.forest(spark, folder).filter("id % 10 <> 9")
    return repair.retype_zero_five(kept).select("neuron", "id", "new_type", "changed")


@query
def release_rules(spark, folder):
    out = repair.release_types(inputs.forest(spark, folder), F.col("neuron") % 2 == 1)
    return out.select("neuron", "id", "final_type", "root_to_type1", "type1_removed", "type0_branch_to_type5")


@query
def release_validation(spark, folder):
    return repair.release_log(repair.release_types(inputs.forest(spark, folder), F.col("neuron") % 2 == 1))


@query
def duplicate_node_ids(spark, folder):
    clashing = inputs.forest(spark, folder).withColumn(
        "id", F.when((F.col("neuron") % 5 == 0) & (F.col("id") % 100 == 0), F.col("id") - 1).otherwise(F.col("id"))
    )
    return repair.duplicate_ids(clashing)


# ------------------------------------------------------------------------ QC

@query
def type0_file_summary(spark, folder):
    return qc.zero_summary(inputs.forest(spark, folder))


@query
def type0_merged_distribution(spark, folder):
    return qc.merged_distribution(qc.zero_summary(inputs.forest(spark, folder)))


@query
def type5_branch_summary(spark, folder):
    return qc.branch_summary(inputs.forest(spark, folder))


@query
def type6_terminal_check(spark, folder):
    return qc.terminal_check(inputs.forest(spark, folder))


@query
def type6_violations(spark, folder):
    return qc.terminal_violations(inputs.forest(spark, folder))


@query
def soma_children(spark, folder):
    return qc.soma_children(inputs.forest(spark, folder))


@query
def edge_lengths(spark, folder):
    return tidy(qc.segment_lengths(inputs.forest(spark, folder)).select("neuron", "id", "parent", "length_um"))


@query
def long_child_screen(spark, folder):
    return qc.long_child_screen(inputs.forest(spark, folder))


@query
def long_child_detail(spark, folder):
    out = qc.long_child_detail(inputs.forest(spark, folder))
    return tidy(out.drop("long_child_lengths_um"))


@query
def folder_summary(spark, folder):
    screen = qc.long_child_screen(inputs.forest(spark, folder))
    return qc.folder_summary(screen, F.concat(F.lit("batch_"), (F.col("neuron") % 4).cast("string")))


@query
def volume_proxy(spark, folder):
    return tidy(repair.soma_scan(inputs.forest(spark, folder)), 3)


@query
def value_counts(spark, folder):
    return qc.value_counts(inputs.forest(spark, folder), "type")


@query
def describe_percentiles(spark, folder):
    nodes = inputs.forest(spark, folder)
    probs = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}
    return tidy(qc.describe(nodes, "radius", probs, ["type"], rows=nodes.count()), 4)


@query
def soma_status(spark, folder):
    scan = repair.soma_scan(inputs.forest(spark, folder))
    out = repair.soma_status(scan, inputs.soma_metadata(spark, folder))
    return tidy(out.select("neuron", "soma_status", "has_trusted_meta_soma", "soma_dist_um"))


@query
def soma_distance_stats(spark, folder):
    scan = repair.soma_scan(inputs.forest(spark, folder))
    status = repair.soma_status(scan, inputs.soma_metadata(spark, folder)).filter("soma_dist_um IS NOT NULL")
    probs = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}
    return tidy(qc.describe(status, "soma_dist_um", probs, rows=inputs.table(spark, folder, "supplier").count()))


@query
def soma_annotation_overlap(spark, folder):
    return qc.annotation_overlap(repair.soma_scan(inputs.forest(spark, folder)), inputs.soma_metadata(spark, folder))


# ------------------------------------------------------------- soma repair

@query
def soma_branch_cable(spark, folder):
    nodes = inputs.forest(spark, folder)
    return tidy(repair.soma_branches(nodes, repair.soma_scan(nodes)).drop("row_idx"), 3)


@query
def adaptive_branch_removal(spark, folder):
    nodes = inputs.forest(spark, folder)
    left, _ = repair.remove_short_branches(nodes, repair.soma_scan(nodes))
    return left.select("neuron", "id")


@query
def adaptive_removal_history(spark, folder):
    nodes = inputs.forest(spark, folder)
    scan = repair.soma_scan(nodes)
    return tidy(repair.removal_plan(repair.soma_branches(nodes, scan), scan)[1], 4)


@query
def soma_repair_log(spark, folder):
    return tidy(repair.repair_somas(inputs.forest(spark, folder), inputs.soma_metadata(spark, folder))[1], 4)


# ---------------------------------------------------------------- synapses

@query
def nearest_node(spark, folder):
    return tidy(_assign(spark, folder).select("neuron", "syn_id", "syn_type", "assigned_node_id", "distance_um"))


@query
def node_synapse_counts(spark, folder):
    out = synapse.node_counts(inputs.forest(spark, folder), _detail(spark, folder))
    return out.select("neuron", "id", "pre_syn_count", "post_syn_count")


@query
def synapse_type(spark, folder):
    out = synapse.visual_type(synapse.node_counts(inputs.forest(spark, folder), _detail(spark, folder)))
    return out.select("neuron", "id", "type")


@query
def synapse_type_log(spark, folder):
    return synapse.visual_type_log(synapse.node_counts(inputs.forest(spark, folder), _detail(spark, folder)))


@query
def synapse_log(spark, folder):
    syn = inputs.synapses(spark, folder)
    return tidy(synapse.assignment_log(inputs.forest(spark, folder), syn, _detail(spark, folder), rows=syn.count()))


@query
def distance_summary(spark, folder):
    return tidy(synapse.distance_summary(_detail(spark, folder), rows=inputs.synapses(spark, folder).count()))


@query
def threshold_coverage(spark, folder):
    return tidy(synapse.threshold_coverage(_detail(spark, folder)))


@query
def distance_cdf(spark, folder):
    near = _detail(spark, folder).withColumn("distance_um", F.round("distance_um", 6))
    return tidy(synapse.histogram(near, F.col("distance_um"), 0.0, 10.0, 2000, ["syn_type"]))


# --------------------------------------------------------------- traversal

@query
def branch_order(spark, folder):
    return topology.branch_order(inputs.forest(spark, folder))


@query
def root_distance(spark, folder):
    return tidy(topology.root_distance(inputs.forest(spark, folder), 1000.0).select("neuron", "id", "root", "hops", "root_distance"), 4)


@query
def subtree_cable(spark, folder):
    return tidy(topology.subtree_cable(inputs.forest(spark, folder), 1000.0), 4)


@query
def parent_first_order(spark, folder):
    return topology.parent_first_order(inputs.tangled_forest(spark, folder), rows=inputs.forest(spark, folder).count()).select("neuron", "id", "position")


SHORT_RUNS = 64  # rows a run, so that the small forest takes the path of neurons of many runs


@query
def branch_order_short_runs(spark, folder):
    return topology.branch_order(inputs.forest(spark, folder), run_rows=SHORT_RUNS)


@query
def root_distance_short_runs(spark, folder):
    return tidy(topology.root_distance(inputs.forest(spark, folder), 1000.0, SHORT_RUNS).select("neuron", "id", "root", "hops", "root_distance"), 4)


@query
def subtree_cable_short_runs(spark, folder):
    return tidy(topology.subtree_cable(inputs.forest(spark, folder), 1000.0, SHORT_RUNS), 4)


@query
def parent_first_order_short_runs(spark, folder):
    nodes = inputs.tangled_forest(spark, folder)
    return topology.parent_first_order(nodes, rows=inputs.forest(spark, folder).count(), run_rows=SHORT_RUNS).select("neuron", "id", "position")


@query
def looped_forest_measures(spark, folder):
    return tidy(topology.node_measures(inputs.looped_forest(spark, folder), 1000.0), 4)


@query
def looped_forest_measures_short_runs(spark, folder):
    return tidy(topology.node_measures(inputs.looped_forest(spark, folder), 1000.0, SHORT_RUNS), 4)


@query
def reroot_at_node(spark, folder):
    nodes = inputs.forest(spark, folder)
    at = nodes.groupBy("neuron").agg(F.max("id").alias("id"))
    return topology.rerooted(nodes, at).select("neuron", "id", "tree_parent")


@query
def soma_proximal_branches(spark, folder):
    shrunk = inputs.forest(spark, folder).withColumns({a: F.col(a) / 20.0 for a in "xyz"})
    return morphology.soma_proximal(shrunk)


@query
def soma_proximal_summary(spark, folder):
    f = soma_proximal_branches(spark, folder).withColumn("dataset", F.col("neuron") % 3)
    return tidy(morphology.feature_summary(f, "soma_branch_count_10um", rows=inputs.table(spark, folder, "supplier").count()))


@query
def soma_branch_histogram(spark, folder):
    f = soma_proximal_branches(spark, folder).withColumn("dataset", F.col("neuron") % 3)
    return tidy(morphology.capped_histogram(f, "soma_branch_count_10um", 4))


@query
def deflection_angle(spark, folder):
    return tidy(morphology.deflection_angles(inputs.forest(spark, folder)).drop("fork"), 4)


def _close_up(spark, folder):
    """The forest at a hundredth of its size: most edges are far below the walked distance."""
    small = [(F.col(c) / 100.0).alias(c) for c in "xyz"]
    return inputs.forest(spark, folder).select("neuron", "id", "row_idx", "type", *small, "radius", "parent")


@query
def deflection_close_up(spark, folder):
    return tidy(morphology.deflection_angles(_close_up(spark, folder)).drop("fork"), 4)


@query
def deflection_close_up_short_runs(spark, folder):
    return tidy(morphology.deflection_angles(_close_up(spark, folder), run_rows=SHORT_RUNS).drop("fork"), 4)


@query
def deflection_features(spark, folder):
    nodes = inputs.forest(spark, folder)
    return tidy(morphology.deflection_features(nodes, rows=nodes.count()), 4)


@query
def deflection_summary(spark, folder):
    nodes = inputs.forest(spark, folder)
    n = nodes.count()
    f = morphology.deflection_features(nodes, rows=n).withColumn("dataset", F.col("neuron") % 3)
    return tidy(morphology.deflection_summary(f, rows=n), 4)


# ---------------------------------------------------------------- neuropils

@query
def neuropil_box(spark, folder):
    return neuropil.file_summary(_labelled(spark, folder))


@query
def neuropil_order_counts(spark, folder):
    return neuropil.order_counts(_labelled(spark, folder))


@query
def order_fraction(spark, folder):
    return tidy(neuropil.order_fractions(_counts(spark, folder)))


@query
def pooled_distribution(spark, folder):
    return tidy(neuropil.pooled(_counts(spark, folder)))


@query
def zero_filled_stats(spark, folder):
    f = neuropil.order_fractions(_counts(spark, folder))
    return tidy(neuropil.zero_filled(f, rows=inputs.forest(spark, folder).count()))


def _profiles(spark, folder, **kw):
    return neuropil.profiles(neuropil.analysed(_counts(spark, folder), **kw))


@query
def order_profile(spark, folder):
    return tidy(neuropil.full_grid(_profiles(spark, folder)))


@query
def minmax_profile(spark, folder):
    return tidy(neuropil.minmax_rows(neuropil.full_grid(_profiles(spark, folder))))


@query
def mean_order_delta(spark, folder):
    return tidy(neuropil.topology_metrics(_profiles(spark, folder, types=(2, 3), dictionary_only=True)))


@query
def js_similarity_pairs(spark, folder):
    return tidy(neuropil.similarity_pairs(_profiles(spark, folder, types=(2, 3))))


@query
def outside_summary(spark, folder):
    n = inputs.table(spark, folder, "supplier").count()
    return tidy(neuropil.outside_summary(neuropil.file_summary(_labelled(spark, folder)), rows=n))


@query
def outside_top_share(spark, folder):
    n = inputs.table(spark, folder, "supplier").count()
    return tidy(neuropil.outside_top_share(neuropil.file_summary(_labelled(spark, folder)), rows=n))


@query
def qcut_distance_order(spark, folder):
    return tidy(neuropil.equal_frequency_bins(_distance_orders(spark, folder), "node_type", "distance_um", "branch_order"))


def _distance_orders(spark, folder):
    nodes, syn = inputs.forest(spark, folder), inputs.synapses(spark, folder)
    per_node = synapse.node_distances(_detail(spark, folder), rows=syn.count()).withColumn("distance_um", F.round("distance_um", 5))
    return per_node.join(topology.branch_order(nodes, soma_only=True), ["neuron", "id"])


# --------------------------------------------------------------- statistics

def _features(spark, folder):
    """Child-count features of three data sets: as is, thinned, and shifted."""
    nodes = inputs.forest(spark, folder)
    raw = morphology.degree_counts(nodes).select("neuron", F.col("n_branch_points").alias("raw"))
    thin = morphology.degree_counts(nodes.filter("id % 11 <> 10")).select("neuron", F.col("n_branch_points").alias("repaired"))
    return raw.join(thin, "neuron").withColumn("other", F.col("raw") - F.col("neuron") % 13)


@query
def avg_rank_mwu(spark, folder):
    f = _features(spark, folder)
    long = f.select(F.inline(F.array(
        F.struct(F.lit("Raw").alias("dataset"), F.col("raw").alias("v")),
        F.struct(F.lit("Other").alias("dataset"), F.col("other").alias("v")),
    )))
    out = statistics.mann_whitney(long, "v", F.col("dataset") == "Raw", F.col("dataset") == "Other")
    return tidy(out)


@query
def signed_rank_w(spark, folder):
    return tidy(statistics.signed_rank(_features(spark, folder), "raw", "repaired"))


@query
def rank_test_p_values(spark, folder):
    f = _features(spark, folder)
    w = statistics.signed_rank(f, "raw", "other").select(F.lit("signed_rank").alias("test"), "rank_biserial", "p_value")
    long = f.select(F.inline(F.array(
        F.struct(F.lit("a").alias("g"), F.col("raw").alias("v")), F.struct(F.lit("b").alias("g"), F.col("other").alias("v")))))
    u = statistics.mann_whitney(long, "v", F.col("g") == "a", F.col("g") == "b").select(F.lit("rank_sum").alias("test"), "rank_biserial", "p_value")
    both = w.unionByName(u).withColumn("p_adjusted", statistics.bonferroni(F.col("p_value"), 3))
    return tidy(both.withColumn("mark", statistics.stars(F.col("p_adjusted"))))


@query
def spearman(spark, folder):
    return tidy(statistics.spearman(_distance_orders(spark, folder), "distance_um", "branch_order", "node_type"))


@query
def change_summary(spark, folder):
    return tidy(statistics.change_summary(_features(spark, folder), "raw", "repaired"))


@query
def sign_permutation_p(spark, folder):
    return tidy(statistics.sign_permutation(neuropil.topology_metrics(_profiles(spark, folder, types=(2, 3), dictionary_only=True))))


@query
def label_permutation_p(spark, folder):
    return tidy(statistics.label_permutation(neuropil.similarity_pairs(_profiles(spark, folder, types=(2, 3)))))


@query
def pooled_asymmetry(spark, folder):
    return tidy(statistics.pooled_asymmetry(neuropil.topology_metrics(_profiles(spark, folder, types=(2, 3), dictionary_only=True))))


@query
def same_or_different_regions(spark, folder):
    return tidy(statistics.same_or_different(neuropil.similarity_pairs(_profiles(spark, folder, types=(2, 3)))))


# --------------------------------------------------------------------- logs

@query
def keep_last(spark, folder):
    log = inputs.table(spark, folder, "orders").select(
        (F.col("o_custkey") % 500).alias("file"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status")
    )
    return qc.keep_last(log, ["file"], "seq")


@query
def set_ops(spark, folder):
    a = inputs.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    b = inputs.table(spark, folder, "orders").select(F.col("o_custkey").alias("id"))
    tag = lambda df, name: df.select("id", F.lit(name).alias("kind"))
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "left_only")).unionByName(tag(b.subtract(a), "right_only"))


@query
def resume_anti(spark, folder):
    files = inputs.forest(spark, folder).select(F.col("neuron").alias("file")).distinct()
    log = inputs.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("file"), F.when(F.col("s_suppkey") % 3 == 0, "failed").otherwise("").alias("error")
    )
    return qc.remaining(files, log, "file")


@query
def operation_rates(spark, folder):
    sheet = inputs.table(spark, folder, "supplier").select(
        F.when(F.col("s_nationkey") % 6 != 0, F.concat(F.lit("class_"), (F.col("s_nationkey") % 6).cast("string"))).alias("classify"),
        F.when(F.col("s_suppkey") % 3 == 0, "TRUE").otherwise("False").alias("remove_soma_branches_automatically"),
        F.when(F.col("s_suppkey") % 4 == 0, "1").alias("prun_soma_region"),
        F.when(F.col("s_acctbal") > 3000, "true").otherwise("0").alias("Multifurcation_Binarization"),
        F.when(F.col("s_acctbal") > 0, "1").otherwise("no").alias("Assign_synapse"),
        F.col("s_name").alias("Unnamed: 0"),
    )
    return tidy(release_report.operation_rates(release_report.clean_metadata(sheet)))


# ------------------------------------------------- relinking and soma pruning

@query
def relink_multifurcations(spark, folder):
    nodes = inputs.tangled_forest(spark, folder)
    out, _, _ = relink.relink(nodes, rows=inputs.forest(spark, folder).count())
    return out.select("neuron", "id", "parent", "type", "position")


@query
def relink_steps(spark, folder):
    return tidy(relink.relink_steps(inputs.tangled_forest(spark, folder)))


@query
def relink_steps_crossing(spark, folder):
    """Moves chosen with the cost of edges that pass within the crossing tolerance."""
    return tidy(relink.relink_steps(inputs.tangled_forest(spark, folder), check_crossing=True))


@query
def relink_node_records(spark, folder):
    nodes = inputs.tangled_forest(spark, folder)
    out, steps, _ = relink.relink(nodes, rows=inputs.forest(spark, folder).count())
    return relink.node_records(nodes, out, steps)


@query
def relink_source_summary(spark, folder):
    nodes = inputs.tangled_forest(spark, folder)
    _, _, log = relink.relink(nodes, rows=inputs.forest(spark, folder).count())
    return qc.source_summary(log.withColumn("source_group", F.concat(F.lit("source_"), (F.col("neuron") % 3).cast("string"))))


@query
def relink_validation(spark, folder):
    nodes = inputs.tangled_forest(spark, folder)
    out, _, _ = relink.relink(nodes, rows=inputs.forest(spark, folder).count())
    return relink.validate(nodes, out)


@query
def soma_prune(spark, folder):
    out, _, _ = soma.prune_somas(inputs.soma_forest(spark, folder), rows=inputs.forest(spark, folder).count())
    return out.select("neuron", "id", "parent", "type")


@query
def soma_prune_log(spark, folder):
    return tidy(soma.prune_somas(inputs.soma_forest(spark, folder), rows=inputs.forest(spark, folder).count())[1])


@query
def radius_states(spark, folder):
    nodes = inputs.soma_forest(spark, folder)
    roots = soma.soma_roots(nodes)
    facts = soma.node_facts(nodes, roots, rows=inputs.forest(spark, folder).count())
    return facts.select("neuron", "id", soma.radius_state(F.col("ratio"), F.col("type") == 1).alias("radius_state"))


# ------------------------------------------------------------- surface meshes

def _samples(spark, folder):
    """Centre samples 20 um apart: the derived edges are tens of micrometres long."""
    return mesh.edge_samples(inputs.forest(spark, folder), spacing=20_000.0, most=4)


@query
def edge_samples(spark, folder):
    return tidy(_samples(spark, folder).drop("edge_row", "n_samples"))


@query
def weighted_quantile(spark, folder):
    s = _samples(spark, folder)
    out = mesh.weighted_quantiles(
        s, ["neuron"], "radius", "weight", {"q50": 0.5, "q90": 0.9, "q95": 0.95}, ["child_id", "k"], rows=4 * inputs.forest(spark, folder).count()
    )
    return tidy(out, 3)


@query
def mesh_center_distance(spark, folder):
    faces = inputs.box_mesh(inputs.neuron_boxes(spark, folder), "neuron")
    return tidy(mesh.to_surface(_samples(spark, folder), faces, cell=20_000.0).drop("face_id"))


def _agreement(spark, folder):
    boxes = inputs.neuron_boxes(spark, folder)
    faces, surface = inputs.box_mesh(boxes, "neuron"), inputs.box_lattice(boxes)
    samples = _samples(spark, folder)
    center, back = mesh.measure(samples, faces, surface, cell=20_000.0)
    return samples, faces, center, back


@query
def mesh_agreement(spark, folder):
    nodes = inputs.forest(spark, folder)
    samples, faces, center, back = _agreement(spark, folder)
    out = mesh.compare(nodes, samples, faces, center, back, thresholds=(2000, 5000, 10000), rows=4 * nodes.count())
    return tidy(out, 3)


@query
def edge_diagnostics(spark, folder):
    _, _, center, back = _agreement(spark, folder)
    out = mesh.edge_diagnostics(center, back, rows=4 * inputs.forest(spark, folder).count())
    # exact decimals reach the seventh place in the means, lengths are irrational
    return tidy(out.withColumn("length_nm", F.round("length_nm", 3)), 7)


@query
def surface_samples(spark, folder):
    faces = inputs.box_mesh(inputs.neuron_boxes(spark, folder), "neuron")
    points = mesh.sample_surface(faces, count=200, rows=12 * inputs.table(spark, folder, "supplier").count())
    return points.groupBy("neuron").agg(F.count(F.lit(1)).alias("n_points"), F.countDistinct("point_id").alias("n_ids"))


@query
def surface_positions(spark, folder):
    """Positions of 500 points a neuron."""
    faces = inputs.box_mesh(inputs.neuron_boxes(spark, folder), "neuron")
    return tidy(mesh.sample_surface(faces, count=500, rows=12 * inputs.table(spark, folder, "supplier").count()), 3)


@query
def mesh_overlap(spark, folder):
    faces = inputs.box_mesh(inputs.neuron_boxes(spark, folder).withColumn("hi_x", F.col("hi_x") - (F.col("neuron") % 5) * 9000.0), "neuron")
    return tidy(mesh.overlap(_samples(spark, folder), faces), 4)


# The same at the operators' own sizes: samples every 250 nm (at most 128 an edge), 80,000 sampled surface points a
# neuron, thresholds of 250, 500 and 1000 nm. Too large for the SQL twins above, so they have none.

def _full_edges(spark, folder):
    """Edges with their numbers of samples; the samples, a hundred times as many, are not stored."""
    return mesh.sampled_edges(inputs.forest(spark, folder))


def _full_samples(spark, folder):
    return mesh.samples_of(_full_edges(spark, folder))


def _full_rows(spark, folder):
    return mesh.MAX_SAMPLES * inputs.forest(spark, folder).count()


def _full_surface(spark, folder):
    faces = inputs.box_mesh(inputs.neuron_boxes(spark, folder), "neuron")
    return faces, mesh.sample_surface(faces, rows=12 * inputs.table(spark, folder, "supplier").count())


def _full_agreement(spark, folder):
    faces, surface = _full_surface(spark, folder)
    samples = _full_samples(spark, folder)
    center, back = mesh.measure(samples, faces, surface)
    return samples, faces, center, back


@query
def edge_samples_full(spark, folder):
    return tidy(_full_samples(spark, folder).drop("edge_row", "n_samples"))


@query
def weighted_quantile_full(spark, folder):
    return tidy(mesh.radius_quantiles(_full_edges(spark, folder), {"q50": 0.5, "q90": 0.9, "q95": 0.95}), 3)


@query
def mesh_center_distance_full(spark, folder):
    faces = inputs.box_mesh(inputs.neuron_boxes(spark, folder), "neuron")
    return tidy(mesh.to_surface(_full_samples(spark, folder), faces, cell=20_000.0).drop("face_id"))


@query
def mesh_agreement_full(spark, folder):
    samples, faces, center, back = _full_agreement(spark, folder)
    out = mesh.compare(inputs.forest(spark, folder), samples, faces, center, back, rows=_full_rows(spark, folder))
    return tidy(out, 3)


@query
def edge_diagnostics_full(spark, folder):
    _, _, center, back = _full_agreement(spark, folder)
    out = mesh.edge_diagnostics(center, back, rows=_full_rows(spark, folder))
    return tidy(out.withColumn("length_nm", F.round("length_nm", 3)), 7)


@query
def surface_samples_full(spark, folder):
    return tidy(_full_surface(spark, folder)[1], 3)


@query
def mesh_overlap_full(spark, folder):
    faces = inputs.box_mesh(inputs.neuron_boxes(spark, folder).withColumn("hi_x", F.col("hi_x") - (F.col("neuron") % 5) * 9000.0), "neuron")
    return tidy(mesh.edge_overlap(_full_edges(spark, folder), faces), 4)


@query
def point_in_mesh(spark, folder):
    points = inputs.typed_forest(spark, folder).select(
        F.struct("neuron", "id").alias("pid"), *[(F.col(a) / 1000.0).alias(f"p{a}") for a in "xyz"]
    )
    faces = inputs.box_mesh(inputs.region_boxes(spark, folder), "region")
    return neuropil.regions_of_points(points, faces).select("pid.neuron", "pid.id", "region")


# ---------------------------------------------------------------- retrieval

def _retrieval_nodes(spark, folder):
    """Raw skeletons and repaired ones that lost every eleventh node."""
    raw = inputs.forest(spark, folder)
    return raw, raw.filter("id % 11 <> 10")


@query
def minhash_signature(spark, folder):
    sig = retrieval.signatures(retrieval.voxels(inputs.forest(spark, folder)))
    return sig.select("neuron", F.posexplode("signature").alias("i", "h"))


def _pairs(spark, folder):
    raw, fixed = _retrieval_nodes(spark, folder)
    q, c = (inputs.land(retrieval.signatures(retrieval.voxels(n)), "signatures") for n in (fixed, raw))
    return retrieval.with_pair(q, c, retrieval.top_candidates(q, c, 30))


@query
def minhash_top_candidates(spark, folder):
    return tidy(_pairs(spark, folder))


@query
def retrieval_incomplete(spark, folder):
    """Queries against every third original: most lack the original of their name, small tables also competitors."""
    raw, fixed = _retrieval_nodes(spark, folder)
    q, c = (inputs.land(retrieval.signatures(retrieval.voxels(n)), "signatures") for n in (fixed, raw.filter("neuron % 3 = 0")))
    return retrieval.incomplete(q, retrieval.with_pair(q, c, retrieval.top_candidates(q, c, 30)), 30)


def _jaccard_ranks(spark, folder):
    raw, fixed = _retrieval_nodes(spark, folder)
    scored = retrieval.exact_jaccard(_pairs(spark, folder), retrieval.voxels(fixed), retrieval.voxels(raw))
    return retrieval.ranked(scored.withColumn("jaccard", F.round("jaccard", 9)), "jaccard")


@query
def voxel_jaccard_topk(spark, folder):
    return tidy(_jaccard_ranks(spark, folder).select("query", "candidate", "shared", "jaccard", "exact_rank"))


@query
def rerank_rank(spark, folder):
    return tidy(retrieval.search_summary(_jaccard_ranks(spark, folder), "jaccard"))


@query
def retrieval_retention(spark, folder):
    summary = retrieval.search_summary(_jaccard_ranks(spark, folder), "jaccard")
    return tidy(retrieval.retention(summary, rows=inputs.table(spark, folder, "supplier").count()))


@query
def shape_rerank(spark, folder):
    raw, fixed = (n.withColumns({a: F.col(a) / 50.0 for a in "xyz"}) for n in _retrieval_nodes(spark, folder))
    # removing nodes leaves pieces; every piece is resampled from its own top
    tops = fixed.join(fixed.select("neuron", F.col("id").alias("parent"), F.lit(True).alias("_p")), ["neuron", "parent"], "left")
    fixed = tops.withColumn("parent", F.when(F.col("_p"), F.col("parent")).otherwise(F.lit(-1))).select(*raw.columns)
    qd, cd = (inputs.land(retrieval.dotprops(retrieval.resampled(n)), "dotprops") for n in (fixed, raw))
    pairs = inputs.land(_pairs(spark, folder), "pairs")
    ranks = retrieval.ranked(retrieval.shape_scores(pairs, qd, cd))
    return tidy(retrieval.search_summary(ranks))


# ------------------------------------------------------- listings and totals

@query
def order_matrix(spark, folder):
    return neuropil.order_matrix(neuropil.full_grid(_profiles(spark, folder)))


@query
def release_log_totals(spark, folder):
    log = repair.release_log(repair.release_types(inputs.forest(spark, folder), F.col("neuron") % 2 == 1))
    return qc.log_totals(log, ["n_nodes", "type1_final", "root_to_type1", "type1_removed", "type0_branch_to_type5"], "error")


@query
def operation_totals(spark, folder):
    sheet = inputs.table(spark, folder, "supplier").select(
        F.lit("all").alias("classify"),
        F.when(F.col("s_suppkey") % 3 == 0, "TRUE").otherwise("False").alias("remove_soma_branches_automatically"),
        F.when(F.col("s_suppkey") % 4 == 0, "1").alias("prun_soma_region"),
        F.when(F.col("s_acctbal") > 3000, "true").otherwise("0").alias("Multifurcation_Binarization"),
        F.when(F.col("s_acctbal") > 0, "1").otherwise("no").alias("Assign_synapse"),
    )
    return tidy(release_report.operation_totals(release_report.clean_metadata(sheet)))


@query
def listing_fingerprint(spark, folder):
    sizes = inputs.forest(spark, folder).groupBy("neuron").agg(F.count(F.lit(1)).alias("n"))
    return qc.fingerprint(sizes, ["neuron", "n"])


@query
def seeded_sample(spark, folder):
    names = inputs.forest(spark, folder).select("neuron").distinct()
    return qc.sample_names(names, "neuron", 50, 42)


def _paired_sample(spark, folder):
    repaired = inputs.forest(spark, folder)
    return qc.paired_sample(repaired, repaired.filter("neuron % 7 <> 3"), "neuron", 50, 42)


@query
def paired_sample(spark, folder):
    return _paired_sample(spark, folder)


@query
def paired_sample_report(spark, folder):
    return qc.sample_report(_paired_sample(spark, folder), "neuron")


@query
def long_segment_sort(spark, folder):
    out = qc.long_child_screen(inputs.forest(spark, folder)).filter("matched")
    return out.orderBy(F.desc("n_matching_parents"), F.desc("n_matching_long_segments"), "neuron").select(
        "neuron", "n_matching_parents", "n_matching_long_segments"
    )


@query
def root_id_from_name(spark, folder):
    c = inputs.table(spark, folder, "customer")
    k = F.col("c_custkey")
    digits = (F.lit(720575940600000000) + k).cast("string")
    name = (
        F.when(k % 4 == 0, digits).when(k % 4 == 1, F.concat(F.lit("cell_"), digits, F.lit("_v2")))
        .when(k % 4 == 2, F.concat(digits, F.lit("-"), digits)).otherwise(F.col("c_name"))
    )
    return c.select(k.alias("c_custkey"), root_id(name).alias("root_id"))


@query
def unit_scaling(spark, folder):
    out = to_nm(inputs.forest(spark, folder), "voxel", "um")
    return tidy(out.select("neuron", "id", "x", "y", "z", "radius"), 4)


@query
def swc_text_lines(spark, folder):
    return inputs.forest(spark, folder).select("neuron", "id", node_line(3).alias("line"))
