"""Soma core detection and pruning of small exits.

Everything that looks at a whole neuron (cable below a node, distance to the
soma, the longest path, what hangs under an exit) is a traversal from
``topology``.  Only the growth of the core is order-dependent; it sees the nodes
within 20 micrometres of the soma and the ten nodes following them, a volume
that does not grow with the neuron.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arborspark.operators import ordering, topology
from arborspark.operators.nearest import codes
from arborspark.operators.repair import retype_zero_five
from arborspark.operators.soma_growth import Rules, core_of
from arborspark.schema import NM_PER_UM
from arborspark.session import land

# Fixed values of the soma pruning.
NEURITE_RATIO, SOMA_RATIO = Rules.neurite_ratio, Rules.soma_ratio
ZONE_UM, AHEAD_WINDOW = Rules.zone_um, Rules.ahead[0]
MAX_SPAN_RATIO = 0.10
MAJOR_RATIO = 0.30
LONG_EXIT_SPANS = 5.0
LONGEST_TOLERANCE_UM = 1e-6


def radius_state(ratio, is_soma):
    """Radius class of a node by its ratio to the neuron's median radius."""
    return (
        F.when(is_soma, "soma_seed")
        .when(ratio.isNull() | F.isnan(ratio), "uncertain")
        .when(ratio <= NEURITE_RATIO, "neurite_like")
        .when(ratio >= SOMA_RATIO, "soma_like")
        .otherwise("uncertain")
    )


# -------------------------------------------------------- facts of each node

def soma_roots(nodes: DataFrame) -> DataFrame:
    """Per neuron: number of somas, the first soma, its parent and position."""
    s = F.col("type") == 1
    first = F.min(F.when(s, F.struct("row_idx", "id", "parent", "x", "y", "z")))
    return nodes.groupBy("neuron").agg(F.count(F.lit(1)).alias("nodes_before"), F.count_if(s).alias("n_soma"), first.alias("_s")).select(
        "neuron", "nodes_before", "n_soma", F.col("_s.id").alias("soma_id"), F.col("_s.parent").alias("soma_parent"),
        *[F.col(f"_s.{a}").alias(f"soma_{a}") for a in "xyz"],
    )


def _valid_radius() -> Column:
    valid = F.col("connected") & (F.col("radius") > 0) & ~F.isnan("radius") & (F.col("radius") < float("inf")) & (F.col("type") != 1)
    return F.coalesce(valid, F.lit(False))


def _medians(neuron: np.ndarray, values: np.ndarray, builtin: bool) -> np.ndarray:
    """Median of the values of every neuron (a number), written as ``ordering.quantiles`` writes it; NaN without values."""
    order = np.lexsort((values, neuron))
    size = np.bincount(neuron)
    start, at = np.cumsum(size) - size, (size - 1) * 0.5
    lo = np.floor(at).astype(np.int64)
    ranked = np.append(values[order], np.nan)
    pick = lambda i: ranked[np.where(size > 0, start + i, len(values))]
    a, b = pick(np.maximum(lo, 0)), pick(np.maximum(np.minimum(lo + 1, size - 1), 0))
    if builtin:
        return np.where((at == lo) | (a == b), a, (lo + 1 - at) * a + (at - lo) * b)
    return a + (b - a) * (at - lo)


def _survey(left: pa.Table, right: pa.Table, builtin: bool, shape: pa.Schema) -> pa.Table:
    """``node_facts`` of the whole neurons of a frame, up to what follows from the columns alone."""
    if not left.num_rows or not right.num_rows:
        return shape.empty_table()
    neuron, tops = codes(left, right, ["neuron"])
    slot = np.full(max(neuron.max(), tops.max()) + 1, -1)
    slot[tops] = np.arange(len(tops))
    value = lambda table, c: table[c].to_numpy().astype(float)
    order = np.argsort(left["row_idx"].to_numpy(), kind="stable")
    order = order[slot[neuron[order]] >= 0]
    left, neuron = left.take(pa.array(order)), neuron[order]
    ids, parent, kind = (left[c].to_numpy() for c in ("id", "parent", "type"))
    at = np.stack([value(left, c) for c in "xyz"], axis=1)
    far = (at - np.stack([value(right, f"soma_{c}") for c in "xyz"], axis=1)[slot[neuron]]) / NM_PER_UM
    at, n = at / NM_PER_UM, len(ids)
    named = topology._parent_rows(pd.Series(neuron), ids, parent)
    step = np.where(named[:, None] >= 0, at - at[named], np.nan)
    length = np.nan_to_num(np.sqrt(step[:, 0] * step[:, 0] + step[:, 1] * step[:, 1] + step[:, 2] * step[:, 2]), nan=0.0)
    over = np.where(parent == -1, -1, named)
    leaf = (np.bincount(over[over >= 0], minlength=n) == 0).astype(float)
    top, (root_dist,), looped = topology._climb(over, [length])
    alive = lambda v: np.where(looped, np.nan, v)
    (cable, n_below, n_leaves), (far_dist,) = topology._gather(over, [length, np.ones(n), leaf], [alive(root_dist)])
    radius, top_type = value(left, "radius") / NM_PER_UM, alive(kind[top])
    valid = (top_type == 1) & (radius > 0) & (kind != 1)
    medians = np.append(_medians(neuron[valid], radius[valid], builtin), np.full(neuron.max(initial=0) + 1, np.nan))[neuron]
    soma_dist = np.sqrt(far[:, 0] * far[:, 0] + far[:, 1] * far[:, 1] + far[:, 2] * far[:, 2])
    doubles = [at[:, 0], at[:, 1], at[:, 2], radius, soma_dist, length, leaf, alive(root_dist), top_type, alive(cable), alive(n_below), alive(n_leaves), alive(far_dist), medians]
    columns = [*[left[c] for c in ("neuron", "id", "row_idx", "parent", "type")], *[pa.array(v, pa.float64(), from_pandas=True) for v in doubles], pa.array(looped)]
    return pa.table(columns, schema=shape)


def node_facts(nodes: DataFrame, roots: DataFrame, rows: int | None = None) -> DataFrame:
    """Scaled nodes with everything the pruning needs to know about them.

    edge_length, cable / n_below / n_leaves (of the whole subtree, own edge
    included), root_dist, far_dist (largest root_dist below), soma_dist, ratio,
    connected, leaf; ``baseline`` is null in neurons without a valid radius.
    Neurons that a task can hold take one shuffle, others joins and traversals.
    """
    nodes = nodes.select("neuron", "id", "row_idx", "parent", "type", "x", "y", "z", "radius")
    roots = roots.select("neuron", "soma_x", "soma_y", "soma_z")
    whole, longer, frame = topology.split_neurons(nodes, F.col("type").isNotNull() & topology.finite_or_null("x", "y", "z", "radius"))
    parts = []
    if whole is not None:
        builtin = rows is not None and rows <= ordering.HOT_ROWS
        doubles = "x y z radius soma_dist edge_length leaf root_dist top_type cable n_below n_leaves far_dist baseline".split()
        shape = T.StructType([T.StructField(c, nodes.schema[c].dataType) for c in ("neuron", "id", "row_idx", "parent", "type")])
        shape = T.StructType([*shape, *[T.StructField(c, T.DoubleType()) for c in doubles], T.StructField("looped", T.BooleanType())])
        arrow = to_arrow_schema(shape)
        # both sides stem from one table: columns of their own tell them apart
        own = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns]).groupBy("_frame")
        met = own(whole).cogroup(own(roots.withColumn("_frame", frame)))
        um = met.applyInArrow(lambda left, right: _survey(left, right, builtin, arrow), shape)
        um = um.withColumn("connected", (F.col("top_type") == 1) & ~F.col("looped")).drop("top_type", "looped").withColumn("valid_radius", _valid_radius())
        parts.append(um.withColumn("ratio", F.when(F.col("valid_radius"), F.col("radius") / F.col("baseline"))))
    if longer is not None:
        parts.append(_facts_by_joins(longer, roots, rows))
    return reduce(DataFrame.unionByName, parts)


def _facts_by_joins(nodes: DataFrame, roots: DataFrame, rows: int | None) -> DataFrame:
    um = nodes.join(roots.select("neuron", "soma_x", "soma_y", "soma_z"), "neuron")
    d = [(F.col(a) - F.col(f"soma_{a}")) / NM_PER_UM for a in "xyz"]
    um = um.select(
        "neuron", "id", "row_idx", "parent", "type",
        *[(F.col(a) / NM_PER_UM).alias(a) for a in "xyz"], (F.col("radius") / NM_PER_UM).alias("radius"),
        F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]).alias("soma_dist"),
    )
    um = topology.child_counts(topology.with_edge_length(um))
    um = um.withColumn("leaf", (F.col("n_children") == 0).cast("double")).drop("n_children")
    paths = topology.root_paths(um, ["edge_length"], carry=["type"])
    um = land(
        um.join(paths.select("neuron", "id", F.col("edge_length").alias("root_dist"), "looped", "top_type"), ["neuron", "id"])
        .withColumn("connected", (F.col("top_type") == 1) & ~F.col("looped"))
        .drop("looped", "top_type"),
        "soma-paths",
    )
    down = um.select(
        "neuron", "id", "row_idx", "parent", F.col("edge_length").alias("cable"), F.lit(1.0).alias("n_below"),
        F.col("leaf").alias("n_leaves"), F.col("root_dist").alias("far_dist"),
    )
    um = um.join(topology.subtree_totals(down, ["cable", "n_below", "n_leaves"], ["far_dist"]), ["neuron", "id"])
    um = land(um.withColumn("valid_radius", _valid_radius()), "soma-tree")
    base = ordering.quantiles(um.filter("valid_radius"), ["neuron"], "radius", {"baseline": 0.5}, rows)
    return um.join(base, "neuron", "left").withColumn("ratio", F.when(F.col("valid_radius"), F.col("radius") / F.col("baseline")))


# ------------------------------------------------------------- core growth

def soma_core(facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Core nodes of every neuron with the growth facts repeated on each row."""
    inside = facts.filter(F.col("connected") & (F.col("soma_dist") <= ZONE_UM))
    reached = topology.root_paths(inside, carry=["type"]).filter("top_type = 1").select("neuron", "id", F.lit(True).alias("_in"))
    marked = facts.join(reached, ["neuron", "id"], "left")
    close = topology.nearest_marked(marked, F.col("_in")).filter(F.col("marked_hops") < AHEAD_WINDOW).select("neuron", "id")
    view = facts.join(close, ["neuron", "id"], "left_semi").select(
        "neuron", "id", "row_idx", "parent", "type", "x", "y", "z", "radius", "edge_length", "cable", "soma_dist", "ratio"
    )
    kind = facts.schema["neuron"].dataType.simpleString()
    return view.groupBy("neuron").applyInPandas(
        lambda pdf: core_of(pdf, rules),
        f"neuron {kind}, id bigint, soma_span_um double, fallback_added bigint, search_truncated boolean, growth_limited boolean",
    )


# -------------------------------------------------------------------- exits

def boundary_exits(facts: DataFrame, core: DataFrame) -> DataFrame:
    """Children of the core outside it, ranked by the cable they carry."""
    ids = core.select("neuron", "id")
    outside = facts.join(ids, ["neuron", "id"], "left_anti").join(ids.withColumnRenamed("id", "parent"), ["neuron", "parent"], "left_semi")
    w = Window.partitionBy("neuron").orderBy(F.desc("cable"), F.desc("n_below"), "row_idx")
    ranked = outside.select(
        "neuron", "id", "parent", "row_idx", "cable", "n_below", "n_leaves", "edge_length",
        (F.col("far_dist") - F.col("root_dist") + F.col("edge_length")).alias("longest_um"),
        F.row_number().over(w).alias("nth"),
    )
    top = ranked.filter("nth = 1").select("neuron", F.col("cable").alias("top_cable"))
    out = ranked.join(top, "neuron")
    ratio = F.when(F.col("nth") == 1, 1.0).when(F.col("top_cable") > 0, F.col("cable") / F.col("top_cable"))
    out = out.withColumn("ratio_to_top", ratio)
    return out.withColumn("retained", (F.col("nth") == 1) | ((F.col("top_cable") > 0) & (F.col("ratio_to_top") >= MAJOR_RATIO)))


def dominant_chains(facts: DataFrame) -> DataFrame:
    """For every node the path that always follows the child carrying most cable:
    its terminal, its length below the node and the hops to the terminal."""
    pick = facts.groupBy("neuron", F.col("parent").alias("id")).agg(
        F.min(F.struct((-F.col("cable")).alias("c"), "row_idx", F.col("id").alias("k"), F.col("edge_length").alias("e"))).alias("_d")
    )
    chain = facts.select("neuron", "id", "row_idx").join(pick, ["neuron", "id"], "left").select(
        "neuron", "id", "row_idx", F.coalesce("_d.k", F.lit(-1)).alias("parent"), F.coalesce("_d.e", F.lit(0.0)).alias("ahead")
    )
    return topology.root_paths(chain, ["ahead"]).select("neuron", "id", F.col("top").alias("terminal"), "hops", F.col("ahead").alias("ahead_um"))


def primary_axis(facts: DataFrame, exits: DataFrame) -> DataFrame:
    """Length, terminal and farthest point of the dominant path through the first exit."""
    chains = land(dominant_chains(facts), "chains")
    first = exits.filter("nth = 1").select("neuron", "id", "edge_length").join(chains, ["neuron", "id"]).select(
        "neuron", "terminal", F.col("hops").alias("exit_hops"), (F.col("edge_length") + F.col("ahead_um")).alias("primary_path_um")
    )
    on_path = chains.join(first, ["neuron", "terminal"]).filter("hops <= exit_hops")
    on_path = on_path.join(facts.select("neuron", "id", "soma_dist"), ["neuron", "id"])
    anchor = on_path.groupBy("neuron").agg(
        F.min(F.struct((-F.col("soma_dist")).alias("d"), (-F.col("hops")).alias("h"), "id")).alias("_a")
    )
    return first.join(anchor, "neuron").select(
        "neuron", "primary_path_um", F.col("terminal").alias("primary_terminal_id"), F.col("_a.id").alias("primary_anchor_id")
    )


def prune_somas(nodes: DataFrame, rows: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes after pruning, log with one row per neuron, exits).

    Neurons that are skipped or unchanged pass through; in modified ones the
    nodes outside the kept exits and their way to the soma are gone and types 0
    and 5 are set anew.
    """
    roots = soma_roots(nodes)
    usable = roots.filter("n_soma = 1 AND soma_parent = -1")
    facts = land(node_facts(nodes, usable, rows).filter("baseline IS NOT NULL"), "soma-facts")
    ready = facts.select("neuron").distinct()
    core = land(soma_core(facts), "core")
    exits = land(boundary_exits(facts, core), "exits")
    axis = primary_axis(facts, exits)

    per_core = core.groupBy("neuron").agg(
        F.count(F.lit(1)).alias("soma_core_nodes"), F.max("soma_span_um").alias("soma_span_um"),
        F.max("fallback_added").alias("fallback_added"), F.max("search_truncated").alias("search_truncated"),
        F.max("growth_limited").alias("growth_limited"),
    )
    reach = core.select("neuron", "id").join(facts.select("neuron", "id", "soma_dist"), ["neuron", "id"]).groupBy("neuron").agg(
        F.max("soma_dist").alias("soma_core_max_distance_um")
    )
    spans = exits.join(per_core.select("neuron", "soma_span_um"), "neuron")
    long_small = (
        (F.col("nth") > 1) & (F.col("ratio_to_top") < MAJOR_RATIO) & (F.col("soma_span_um") > 0)
        & (F.col("longest_um") >= LONG_EXIT_SPANS * F.col("soma_span_um"))
    )
    spans = spans.withColumn("long_submajor", F.coalesce(long_small, F.lit(False)))

    under = topology.nearest_marked(
        facts.join(exits.select("neuron", "id", F.lit(True).alias("_exit")), ["neuron", "id"], "left"), F.col("_exit")
    ).filter("marked IS NOT NULL").select("neuron", "id", F.col("marked").alias("exit_id"))
    under = land(under, "under-exits")
    kept_exit = exits.filter("retained").select("neuron", F.col("id").alias("exit_id"))
    branches = under.join(kept_exit, ["neuron", "exit_id"], "left_semi").select("neuron", "id")
    # a core node stays when a retained exit hangs below it inside the core
    hung = exits.filter("retained").groupBy("neuron", F.col("parent").alias("id")).agg(F.count(F.lit(1)).cast("double").alias("held"))
    in_core = facts.join(core.select("neuron", "id"), ["neuron", "id"], "left_semi").join(hung, ["neuron", "id"], "left").fillna(0.0, ["held"])
    backbone = topology.subtree_totals(in_core, ["held"]).filter("held > 0").select("neuron", "id")
    keep = land(branches.unionByName(backbone), "keep")

    farthest = facts.filter("type = 1 AND connected").select("neuron", F.col("far_dist").alias("longest_path_um"))
    terminals = facts.filter("leaf = 1 AND connected").join(farthest, "neuron").filter(
        F.abs(F.col("root_dist") - F.col("longest_path_um")) <= LONGEST_TOLERANCE_UM
    )
    threatened = terminals.join(keep, ["neuron", "id"], "left_anti").groupBy("neuron").agg(F.count(F.lit(1)).alias("threatened"))

    log = _prune_log(roots, ready, per_core, reach, axis, spans, keep, farthest, threatened, _flagged(spans, under, facts))
    modified = log.filter("status = 'modified'").select("neuron")
    pruned = nodes.join(modified, "neuron", "left_semi").join(keep, ["neuron", "id"], "left_semi")
    retyped = retype_zero_five(pruned)
    counts = retyped.groupBy("neuron").agg(F.count_if("changed").alias("retyped_nodes"))
    out = retyped.withColumn("type", F.col("new_type")).select(*nodes.columns).unionByName(nodes.join(modified, "neuron", "left_anti"))
    return out, log.join(counts, "neuron", "left"), spans


def _flagged(spans: DataFrame, under: DataFrame, facts: DataFrame) -> DataFrame:
    """Listing of the long exits that stop the pruning."""
    long_exits = spans.filter("long_submajor")
    leaves = under.join(long_exits.select("neuron", F.col("id").alias("exit_id")), ["neuron", "exit_id"], "left_semi").join(
        facts.filter("leaf = 1").select("neuron", "id", "root_dist", "row_idx"), ["neuron", "id"]
    )
    far = leaves.groupBy("neuron", "exit_id").agg(F.max(F.struct("root_dist", "row_idx", "id")).alias("_t"))
    listed = long_exits.join(far, (long_exits.neuron == far.neuron) & (long_exits.id == far.exit_id), "left").select(
        long_exits["*"], F.col("_t.id").alias("terminal_id")
    )
    entry = F.struct("nth", "id", "ratio_to_top", "terminal_id", F.col("n_leaves").cast("bigint").alias("leaves"), "longest_um")
    joined = lambda f: F.array_join(F.transform("_f", f), "|")
    six = lambda c: F.format_string("%.6f", c)
    return listed.groupBy("neuron").agg(F.count(F.lit(1)).alias("flagged_exit_n"), F.array_sort(F.collect_list(entry)).alias("_f")).select(
        "neuron", "flagged_exit_n",
        joined(lambda e: e.id.cast("string")).alias("flagged_exit_ids"),
        joined(lambda e: six(e.ratio_to_top)).alias("flagged_exit_ratios"),
        joined(lambda e: e.terminal_id.cast("string")).alias("flagged_terminal_ids"),
        joined(lambda e: e.leaves.cast("string")).alias("flagged_terminal_counts"),
        joined(lambda e: six(e.longest_um)).alias("flagged_max_path_distance_um"),
    )


def _prune_log(roots, ready, per_core, reach, axis, exits, keep, farthest, threatened, flagged) -> DataFrame:
    per_exit = exits.groupBy("neuron").agg(
        F.count(F.lit(1)).alias("boundary_exit_n"),
        F.count_if("long_submajor").alias("long_submajor_n"),
        F.count_if("retained").alias("retained_major_exit_n"),
        F.sum("cable").alias("_all_cable"),
        F.max(F.when(F.col("nth") == 1, F.col("id"))).alias("primary_exit_id"),
        F.max(F.when(F.col("nth") == 1, F.col("parent"))).alias("primary_exit_parent_id"),
        F.max(F.when(F.col("nth") == 1, F.col("cable"))).alias("primary_downstream_cable_um"),
        F.max(F.when((F.col("nth") == 2) & (F.col("top_cable") > 0), F.col("cable") / F.col("top_cable"))).alias("second_to_first_exit_ratio"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.when(F.col("retained"), F.struct("nth", "id")))), lambda e: e.id.cast("string")), ";"
        ).alias("retained_major_exit_ids"),
    )
    kept = keep.groupBy("neuron").agg(F.count(F.lit(1)).alias("_kept"))
    log = roots.join(ready.withColumn("_ready", F.lit(True)), "neuron", "left")
    for part in (per_core, reach, axis, per_exit, kept, farthest, threatened, flagged):
        log = log.join(part, "neuron", "left")
    span_ratio = F.when(F.col("primary_path_um") > 0, F.col("soma_span_um") / F.col("primary_path_um"))
    log = log.withColumns(
        {
            "soma_to_neuron_span_ratio": span_ratio,
            "primary_cable_fraction": F.when(F.col("_all_cable") > 0, F.col("primary_downstream_cable_um") / F.col("_all_cable")),
            "small_soma_fallback_used": F.col("fallback_added") > 0,
            "_deleted": F.col("nodes_before") - F.coalesce("_kept", F.lit(0)),
        }
    )
    cases = [
        (F.col("n_soma") != 1, "skipped", "soma_count", F.concat(F.lit("Type-1 count = "), F.col("n_soma"))),
        (F.col("soma_parent") != -1, "skipped", "soma_not_root", F.lit("Type-1 soma is not root")),
        (F.col("_ready").isNull(), "skipped", "no_radius", F.lit("No valid non-Type-1 radius values")),
        (F.col("boundary_exit_n").isNull(), "skipped", "no_exit", F.lit("No soma-core boundary exit")),
        (F.col("soma_to_neuron_span_ratio") > MAX_SPAN_RATIO, "skipped", "large_soma_primary_neurite_axis_span",
         F.lit("Soma span is too large against the primary path")),
        (F.col("long_submajor_n") > 0, "skipped", "long_submajor_exit", F.lit("A minor exit reaches too far")),
        (F.col("_deleted") == 0, "unchanged", "nothing_to_prune", F.lit("No nodes require pruning")),
        (F.col("threatened") > 0, "unchanged", "primary_neurite_guard", F.lit("Pruning would remove a longest path")),
    ]
    status, category, reason = F.lit("modified"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for test, s, c, why in reversed(cases):
        hit = F.coalesce(test, F.lit(False))
        status, category, reason = F.when(hit, s).otherwise(status), F.when(hit, c).otherwise(category), F.when(hit, why).otherwise(reason)
    log = log.withColumns({"status": status, "skip_category": category, "reason": reason})
    changed = F.col("status") == "modified"
    return log.withColumns(
        {
            "nodes_after": F.col("nodes_before") - F.when(changed, F.col("_deleted")).otherwise(0),
            "deleted_nodes": F.when(changed, F.col("_deleted")).otherwise(0),
        }
    ).drop("_ready", "_all_cable", "_kept", "_deleted", "soma_x", "soma_y", "soma_z")
