"""The processing chain from raw skeletons to release tables.

Each stage is landed, so a lost executor repeats at most one stage and later
stages read columns, not lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborspark.operators import qc, relink, repair, soma, synapse
from arborspark.session import land
from arborspark.sources.swc import rounded


@dataclass
class Release:
    nodes: DataFrame
    synapse_detail: DataFrame
    logs: dict[str, DataFrame]


def release(raw: DataFrame, metadata: DataFrame, synapses: DataFrame, review: DataFrame | None = None, strict_text: bool = False) -> Release:
    """All repairs, synapse assignment and final types.

    ``review`` (neuron, target_group) carries manual decisions and overrides the
    automatic category; of several decisions on a neuron the last by ``row_idx``
    counts, without that column the greatest.  ``strict_text`` rounds coordinates to three decimals
    between the stages that would have gone through a text file.
    """
    text = rounded if strict_text else (lambda t: t)
    columns = raw.columns
    logs = {"zero_branches": repair.zero_branch_log(raw)}
    nodes = repair.retype_zero_branches(raw).withColumn("type", F.col("new_type")).select(*columns)
    repaired, logs["soma_repair"] = repair.repair_somas(land(nodes, "typed"), metadata)
    repaired = land(text(repaired), "repaired")
    logs["long_children"] = qc.long_child_screen(repaired)
    if review is not None:
        decided = repair.last_listed(review.select("neuron", "target_group", *[c for c in ("row_idx",) if c in review.columns]), "neuron")
        repaired = repaired.join(decided, "neuron", "left").withColumn("category", F.coalesce("target_group", "category")).drop("target_group")
        repaired = land(repaired, "reviewed")
    groups = repaired.select("neuron", "category").distinct()
    unipolar = repaired.filter("category = 'unipolar'").select(*columns)
    rest = repaired.filter("category IN ('no_soma', 'no_soma_annotation')").select(*columns)
    pruned, logs["soma_prune"], _ = soma.prune_somas(unipolar)
    merged = land(pruned.unionByName(rest), "pruned")
    linked, logs["relink_steps"], logs["relink"] = relink.relink(merged)
    # the parent-first position is the row order of what follows
    linked = land(text(linked.withColumn("row_idx", F.col("position"))).select(*columns), "linked")
    detail = land(synapse.assign(linked, synapses), "detail")
    logs["assignment"] = synapse.assignment_log(linked, synapses, detail)
    logs["distances"] = synapse.distance_summary(detail)
    counted = synapse.node_counts(linked, detail)
    logs["synapse_types"] = synapse.visual_type_log(counted)
    typed = synapse.visual_type(counted).join(groups, "neuron")
    released = repair.release_types(typed, F.col("category") == "unipolar")
    logs["release"] = repair.release_log(released)
    good = released.filter("error IS NULL").withColumn("type", F.col("final_type"))
    return Release(good.select(*columns, "category", "pre_syn_count", "post_syn_count"), detail, logs)
