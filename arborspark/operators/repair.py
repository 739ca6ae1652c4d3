"""Retyping rules, soma status, adaptive removal of short soma branches, release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborspark.operators import topology
from arborspark.schema import META_SOMA_DIVISOR, NM_PER_UM

# Fixed values of the soma repair.
TRUSTED_UM = 2.0
START_RATIO = 0.15
TINY_RATIO = 0.05
MAX_VOLUME_LOSS = 0.10


def duplicate_ids(nodes: DataFrame) -> DataFrame:
    """Neurons that use a node id more than once."""
    return nodes.groupBy("neuron", "id").count().filter("count > 1").select("neuron").distinct()


def retype_zero_branches(nodes: DataFrame) -> DataFrame:
    """Type 0 becomes 5 where a node has at least two children."""
    counted = topology.child_counts(nodes)
    change = (F.col("type") == 0) & (F.col("n_children") >= 2)
    return counted.withColumns({"new_type": F.when(change, 5).otherwise(F.col("type")).cast("int"), "changed": change})


def zero_branch_log(nodes: DataFrame) -> DataFrame:
    """Per-neuron numbers of the 0 -> 5 retyping."""
    t, hit = F.col("type"), F.col("changed")
    return (
        retype_zero_branches(nodes)
        .groupBy("neuron")
        .agg(
            F.count(F.lit(1)).alias("n_nodes"),
            F.count_if(t == 0).alias("type0_before"),
            F.count_if(t == 5).alias("type5_before"),
            F.count_if(hit).alias("retyped_type0_to_type5"),
            F.count_if(F.col("new_type") == 0).alias("type0_after"),
            F.count_if(F.col("new_type") == 5).alias("type5_after"),
            F.when(F.max(hit.cast("int")) == 1, "rewritten").otherwise("unchanged").alias("output_method"),
        )
    )


def retype_somas(nodes: DataFrame) -> DataFrame:
    """Untrusted somas become branch points (>= 2 children) or unlabeled nodes."""
    counted = topology.child_counts(nodes)
    new = F.when(F.col("type") == 1, F.when(F.col("n_children") >= 2, 5).otherwise(0)).otherwise(F.col("type"))
    return counted.withColumns({"new_type": new.cast("int"), "changed": F.col("type") == 1})


def retype_zero_five(nodes: DataFrame) -> DataFrame:
    """Types 0 and 5 set from the child count among the given rows."""
    counted = topology.child_counts(nodes)
    new = F.when(F.col("type").isin(0, 5), F.when(F.col("n_children") >= 2, 5).otherwise(0)).otherwise(F.col("type"))
    return counted.withColumns({"new_type": new.cast("int"), "changed": new != F.col("type")})


# ------------------------------------------------------------------- somas

def soma_scan(nodes: DataFrame) -> DataFrame:
    """Per neuron: soma centroid (micrometres), first soma, its children, node count, volume proxy."""
    soma = F.col("type") == 1
    r = F.greatest(F.coalesce("radius", F.lit(0.0)), F.lit(0.0))
    scan = nodes.groupBy("neuron").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.sum(r * r * r).alias("volume"),
        F.count_if(soma).alias("n_soma_nodes"),
        F.min_by(F.when(soma, F.col("id")), F.when(soma, F.col("row_idx"))).alias("soma_id"),
        *[(F.avg(F.when(soma, F.col(a))) / F.lit(NM_PER_UM)).alias(f"soma_{a}_um") for a in "xyz"],
    )
    per_parent = nodes.groupBy("neuron", F.col("parent").alias("soma_id")).agg(F.count(F.lit(1)).alias("soma_children"))
    out = scan.join(per_parent, ["neuron", "soma_id"], "left")
    return out.withColumn(
        "soma_children", F.when(F.col("soma_id").isNotNull(), F.coalesce("soma_children", F.lit(0).cast("bigint")))
    )


def last_listed(listed: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the last by ``row_idx``, or the greatest where the list has no order."""
    others = F.struct(*[c for c in listed.columns if c not in (key, "row_idx")])
    last = F.max_by(others, "row_idx") if "row_idx" in listed.columns else F.max(others)
    return listed.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def trusted_somas(metadata: DataFrame) -> DataFrame:
    """Listed soma positions in micrometres, rows with a missing value dropped; of several rows the last counts."""
    place = ["root_id", "soma_x", "soma_y", "soma_z"]
    whole = metadata.dropna(subset=place).select(*place, *[c for c in ("row_idx",) if c in metadata.columns])
    return last_listed(whole, "root_id").select(
        F.col("root_id").alias("neuron"),
        *[(F.col(f"soma_{a}") / F.lit(d)).alias(f"meta_{a}_um") for a, d in zip("xyz", META_SOMA_DIVISOR)],
    )


def soma_status(scan: DataFrame, metadata: DataFrame) -> DataFrame:
    """Soma trust class and distance to the listed soma."""
    joined = scan.join(trusted_somas(metadata), "neuron", "left")
    diff = [F.col(f"meta_{a}_um") - F.col(f"soma_{a}_um") for a in "xyz"]
    dist = F.sqrt(diff[0] * diff[0] + diff[1] * diff[1] + diff[2] * diff[2])
    listed = F.col("meta_x_um").isNotNull()
    found = F.col("n_soma_nodes") > 0
    status = (
        F.when(~found, "swc_no_soma")
        .when(~listed, "no_trusted_meta_soma")
        .when(dist <= TRUSTED_UM, "trusted_soma")
        .otherwise("soma_need_check")
    )
    return joined.select(
        *scan.columns,
        status.alias("soma_status"),
        (found & listed).alias("has_trusted_meta_soma"),
        F.when(found & listed, dist).alias("soma_dist_um"),
    )


def soma_branches(nodes: DataFrame, scan: DataFrame) -> DataFrame:
    """Branches leaving the first soma: cable (edge to the soma included), nodes, volume."""
    r = F.greatest(F.coalesce("radius", F.lit(0.0)), F.lit(0.0))
    measured = topology.with_edge_length(nodes).withColumns({"volume": r * r * r, "nodes_below": F.lit(1.0)})
    totals = topology.subtree_totals(measured, ["edge_length", "volume", "nodes_below"])
    soma = scan.filter("soma_id IS NOT NULL").select("neuron", F.col("soma_id").alias("parent"))
    starts = nodes.join(soma, ["neuron", "parent"]).select("neuron", "id", "row_idx")
    return starts.join(totals, ["neuron", "id"]).select(
        "neuron", F.col("id").alias("branch_id"), "row_idx", F.col("edge_length").alias("cable_length"),
        F.col("volume").alias("branch_volume"), F.col("nodes_below").cast("bigint").alias("branch_nodes"),
    )


def removal_plan(branches: DataFrame, scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which soma branches go: (branches with ``removed``, one decision row per neuron).

    The threshold starts at 0.15 of the longest branch and would fall by 0.01 a
    round.  A round at a lower threshold can only remove branches shorter than
    the lower cutoff; all of those were already below the first cutoff, so
    either the first round removes them or its volume guard ends the search.
    One round therefore gives the final answer.
    """
    longest = branches.groupBy("neuron").agg(F.max("cable_length").alias("longest"), F.count(F.lit(1)).alias("n_branches"))
    marked = branches.join(longest, "neuron").withColumn(
        "short",
        (F.col("n_branches") > 1) & (F.col("longest") > 0) & (F.col("cable_length") < F.col("longest") * F.lit(START_RATIO)),
    )
    per_neuron = marked.groupBy("neuron").agg(
        F.max("longest").alias("max_branch_length"),
        F.max("n_branches").alias("before_children"),
        F.count_if("short").alias("removed_branches"),
        F.sum(F.when(F.col("short"), F.col("branch_nodes")).otherwise(0)).alias("removed_nodes"),
        F.sum(F.when(F.col("short"), F.col("cable_length")).otherwise(0.0)).alias("removed_total_length"),
        F.sum(F.when(F.col("short"), F.col("branch_volume")).otherwise(0.0)).alias("removed_volume"),
        F.max(F.when(F.col("short"), F.col("cable_length"))).alias("_longest_short"),
    )
    loss = F.when(F.col("volume") > 0, 1 - (F.col("volume") - F.col("removed_volume")) / F.col("volume"))
    tiny = F.col("_longest_short") < F.col("max_branch_length") * F.lit(TINY_RATIO)
    decided = (
        per_neuron.join(scan.select("neuron", "volume"), "neuron")
        .withColumns({"volume_loss": loss, "all_removed_are_tiny": F.coalesce(tiny, F.lit(False))})
        .withColumn(
            "accepted",
            (F.col("removed_branches") > 0)
            & ~(F.coalesce(F.col("volume_loss") > MAX_VOLUME_LOSS, F.lit(False)) & ~F.col("all_removed_are_tiny")),
        )
        .withColumns(
            {
                "after_children": F.col("before_children") - F.when(F.col("accepted"), F.col("removed_branches")).otherwise(0),
                "best_threshold": F.when(F.col("accepted"), F.lit(START_RATIO)),
            }
        )
        .drop("_longest_short", "volume")
    )
    out = marked.join(decided.select("neuron", "accepted"), "neuron").withColumn("removed", F.col("short") & F.col("accepted"))
    return out.select(*branches.columns, "removed"), decided


def remove_short_branches(nodes: DataFrame, scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes left after dropping short soma branches, and the decision rows."""
    plan, decisions = removal_plan(soma_branches(nodes, scan), scan)
    gone = plan.filter("removed").select("neuron", F.col("branch_id").alias("id"), F.lit(True).alias("cut"))
    marked = nodes.join(gone, ["neuron", "id"], "left")
    under = topology.nearest_marked(marked, F.coalesce("cut", F.lit(False))).filter("marked IS NOT NULL")
    return nodes.join(under, ["neuron", "id"], "left_anti"), decisions


def repair_somas(nodes: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Soma repair of all neurons: (nodes with ``category``, log).

    Trusted somas with several branches are pruned, untrusted somas are retyped,
    everything else passes through.
    """
    scan = soma_scan(nodes)
    status = soma_status(scan, metadata)
    to_prune = status.filter((F.col("soma_status") == "trusted_soma") & (F.col("soma_children") > 1)).select("neuron")
    to_retype = status.filter(F.col("soma_status") == "no_trusted_meta_soma").select("neuron")
    pruned, decisions = remove_short_branches(
        nodes.join(to_prune, "neuron", "left_semi"), scan.join(to_prune, "neuron", "left_semi")
    )
    retyped = retype_somas(nodes.join(to_retype, "neuron", "left_semi"))
    log = _repair_log(status, decisions, retyped)
    rest = nodes.join(to_prune, "neuron", "left_anti").join(to_retype, "neuron", "left_anti")
    kept = pruned.unionByName(retyped.withColumn("type", F.col("new_type")).select(*nodes.columns)).unionByName(rest)
    return kept.join(log.select("neuron", "category"), "neuron"), log


def _repair_log(status: DataFrame, decisions: DataFrame, retyped: DataFrame) -> DataFrame:
    changed = retyped.groupBy("neuron").agg(
        F.count_if(F.col("changed") & (F.col("new_type") == 0)).alias("reclassified_type0"),
        F.count_if(F.col("changed") & (F.col("new_type") == 5)).alias("reclassified_type5"),
    )
    facts = status.join(decisions, "neuron", "left").join(changed, "neuron", "left")
    s = F.col("soma_status")
    accepted = F.coalesce("accepted", F.lit(False))
    gone_nodes = F.when(accepted, F.col("removed_nodes")).otherwise(0)
    gone_volume = F.when(accepted, F.col("removed_volume")).otherwise(0.0)
    after = (
        F.when(s == "no_trusted_meta_soma", F.lit(None))
        .when(accepted, F.col("after_children"))
        .otherwise(F.col("soma_children"))
    )
    category = (
        F.when(s.isin("swc_no_soma", "no_trusted_meta_soma"), "no_soma")
        .when(s == "soma_need_check", "soma_need_check")
        .when(after == 1, "unipolar")
        .otherwise("non_unipolar")
    )
    repair = (
        F.when(s == "swc_no_soma", "linked_swc_no_soma")
        .when(s == "no_trusted_meta_soma", "reclassified_no_trusted_meta_soma")
        .when(s == "soma_need_check", "linked_soma_need_check_no_repair")
        .when(F.col("soma_children") > 1, "repaired_trusted_soma")
        .otherwise("linked_trusted_soma")
    )
    zero = F.lit(0).cast("bigint")
    retyped_n = F.coalesce("reclassified_type0", zero) + F.coalesce("reclassified_type5", zero)
    return facts.select(
        "neuron",
        category.alias("category"),
        repair.alias("repair_status"),
        "soma_status",
        "has_trusted_meta_soma",
        F.col("n_soma_nodes").alias("n_soma_nodes_before"),
        F.col("soma_id").alias("original_soma_id"),
        F.col("soma_dist_um").alias("soma_dist_before"),
        F.col("soma_children").alias("soma_children_before"),
        after.cast("bigint").alias("soma_children_after"),
        F.col("n_nodes").alias("n_nodes_before"),
        (F.col("n_nodes") - gone_nodes).cast("bigint").alias("n_nodes_after"),
        (gone_nodes / F.col("n_nodes")).alias("node_loss"),
        F.col("volume").alias("volume_before"),
        (F.col("volume") - gone_volume).alias("volume_after"),
        F.when(F.col("volume") > 0, gone_volume / F.col("volume")).alias("volume_loss"),
        "best_threshold",
        F.coalesce("reclassified_type0", zero).alias("reclassified_type0"),
        F.coalesce("reclassified_type5", zero).alias("reclassified_type5"),
        (accepted | (retyped_n > 0)).alias("changed"),
    )


# ----------------------------------------------------------------- release

def release_types(nodes: DataFrame, soma_pruned: Column) -> DataFrame:
    """Final type rules.

    In soma-pruned neurons the only root becomes the soma; elsewhere leftover
    somas become 5 or 0; then branching Type-0 nodes become 5.  ``error`` is set
    on all rows of a soma-pruned neuron without exactly one root.
    """
    counted = topology.child_counts(nodes).withColumn("soma_pruned", soma_pruned)
    roots = nodes.groupBy("neuron").agg(F.count_if(F.col("parent") == -1).alias("n_roots"))
    counted = counted.join(roots, "neuron")
    many = F.col("n_children") >= 2
    ruled = (
        F.when(F.col("soma_pruned"), F.when(F.col("parent") == -1, 1).otherwise(F.col("type")))
        .when(F.col("type") == 1, F.when(many, 5).otherwise(0))
        .otherwise(F.col("type"))
    )
    counted = counted.withColumn("_ruled", ruled)
    final = F.when((F.col("_ruled") == 0) & many, 5).otherwise(F.col("_ruled"))
    return counted.select(
        *nodes.columns, "soma_pruned", "n_children", "n_roots",
        final.cast("int").alias("final_type"),
        (F.col("soma_pruned") & (F.col("parent") == -1) & (F.col("type") != 1)).alias("root_to_type1"),
        (~F.col("soma_pruned") & (F.col("type") == 1)).alias("type1_removed"),
        ((F.col("_ruled") == 0) & many).alias("type0_branch_to_type5"),
        F.when(F.col("soma_pruned") & (F.col("n_roots") != 1), F.concat(F.lit("expected 1 root, found "), F.col("n_roots"))).alias("error"),
    )


def release_log(released: DataFrame) -> DataFrame:
    """Per-neuron release numbers; violated rules appear in ``error``."""
    t = F.col("final_type")
    log = released.groupBy("neuron", "soma_pruned").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.max("n_roots").alias("n_roots"),
        F.count_if(t == 1).alias("type1_final"),
        F.count_if("root_to_type1").alias("root_to_type1"),
        F.count_if("type1_removed").alias("type1_removed"),
        F.count_if("type0_branch_to_type5").alias("type0_branch_to_type5"),
        F.count_if((F.col("parent") == -1) & (t != 1)).alias("_bad_roots"),
        F.count_if((t == 0) & (F.col("n_children") >= 2)).alias("_bad_zero"),
        F.max("error").alias("_error"),
    )
    error = F.coalesce(
        F.col("_error"),
        F.when(F.col("soma_pruned") & (F.col("_bad_roots") > 0), "root is not Type 1"),
        F.when(~F.col("soma_pruned") & (F.col("type1_final") > 0), "Type 1 remains outside soma-pruned neurons"),
        F.when(F.col("_bad_zero") > 0, "Type-0 branch points remain"),
    )
    return log.withColumn("error", error).drop("_bad_roots", "_bad_zero", "_error")
