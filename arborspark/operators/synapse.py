"""Synapse points assigned to their nearest skeleton node, and the summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborspark.operators import ordering
from arborspark.operators.nearest import nearest
from arborspark.schema import NM_PER_UM


def assign(nodes: DataFrame, synapses: DataFrame, cell_um: float = 4.0) -> DataFrame:
    """Detail table: each synapse with its nearest node and distance (micrometres).

    Equidistant nodes resolve to the first file row.  Synapses of neurons
    without nodes are absent.
    """
    um = lambda c: F.col(c) / F.lit(NM_PER_UM)
    probes = synapses.select("neuron", F.col("syn_id").alias("pid"), "syn_type", *[um(a).alias(f"p{a}") for a in "xyz"])
    items = nodes.select("neuron", "row_idx", "id", "type", *[um(a).alias(a) for a in "xyz"])
    hit = nearest(probes, items, ["neuron"], cell=cell_um, carry=("id", "type", "x", "y", "z"), keep=("syn_type", "px", "py", "pz"))
    return hit.select(
        "neuron", "syn_type", F.col("pid").alias("syn_id"), *[F.col(f"p{a}").alias(f"syn_{a}_um") for a in "xyz"],
        F.col("row_idx").alias("assigned_node_row"), F.col("id").alias("assigned_node_id"),
        F.col("type").alias("assigned_node_type"),
        *[F.col(a).alias(f"assigned_{a}_um") for a in "xyz"],
        F.col("distance").alias("distance_um"),
    )


def node_counts(nodes: DataFrame, detail: DataFrame) -> DataFrame:
    """Nodes with their numbers of assigned pre- and post-synapses."""
    counts = detail.groupBy("neuron", F.col("assigned_node_id").alias("id")).agg(
        F.count_if(F.col("syn_type") == "pre").alias("pre_syn_count"),
        F.count_if(F.col("syn_type") == "post").alias("post_syn_count"),
    )
    return nodes.join(counts, ["neuron", "id"], "left").fillna(0, ["pre_syn_count", "post_syn_count"])


def visual_type(counted: DataFrame) -> DataFrame:
    """Types 2, 3 and 4 from the counts; the soma keeps its type."""
    pre, post = F.col("pre_syn_count") > 0, F.col("post_syn_count") > 0
    kind = (
        F.when(F.col("type") == 1, 1)
        .when(pre & post, 4)
        .when(pre, 2)
        .when(post, 3)
        .otherwise(F.col("type"))
    )
    return counted.withColumn("type", kind.cast("int"))


def visual_type_log(counted: DataFrame) -> DataFrame:
    """Per neuron: node numbers by synapse content; somas are counted too."""
    pre, post = F.col("pre_syn_count") > 0, F.col("post_syn_count") > 0
    return counted.groupBy("neuron").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.count_if(pre & ~post).alias("pre_rich_nodes"),
        F.count_if(~pre & post).alias("post_rich_nodes"),
        F.count_if(pre & post).alias("mixed_nodes"),
        F.count_if(pre | post).alias("syn_nodes"),
    )


def assignment_log(nodes: DataFrame, synapses: DataFrame, detail: DataFrame, rows: int | None = None) -> DataFrame:
    """Per-neuron assignment counts and distance statistics."""
    touched = (
        node_counts(nodes, detail)
        .groupBy("neuron")
        .agg(
            F.count(F.lit(1)).alias("n_nodes"),
            F.count_if(F.col("pre_syn_count") > 0).alias("nodes_with_pre"),
            F.count_if(F.col("post_syn_count") > 0).alias("nodes_with_post"),
            F.count_if((F.col("pre_syn_count") > 0) & (F.col("post_syn_count") > 0)).alias("nodes_with_both"),
        )
    )
    given = synapses.groupBy("neuron").agg(
        F.count_if(F.col("syn_type") == "pre").alias("n_pre_syn"),
        F.count_if(F.col("syn_type") == "post").alias("n_post_syn"),
    )
    d = F.col("distance_um")
    side = lambda s: F.when(F.col("syn_type") == s, d)
    stats = detail.groupBy("neuron").agg(
        F.count(side("pre")).alias("assigned_pre_syn"),
        F.count(side("post")).alias("assigned_post_syn"),
        *[f(side(s)).alias(f"{s}_dist_{n}_um") for s in ("pre", "post") for n, f in (("mean", F.avg), ("max", F.max))],
    )
    q = ordering.quantiles(detail, ["neuron", "syn_type"], "distance_um", {"median": 0.5, "p95": 0.95}, rows)
    by_side = q.groupBy("neuron").agg(
        *[
            F.max(F.when(F.col("syn_type") == s, F.col(n))).alias(f"{s}_dist_{n}_um")
            for s in ("pre", "post")
            for n in ("median", "p95")
        ]
    )
    out = touched.join(given, "neuron", "left").join(stats, "neuron", "left").join(by_side, "neuron", "left")
    return out.withColumns({"has_pre": F.coalesce("n_pre_syn", F.lit(0)) > 0, "has_post": F.coalesce("n_post_syn", F.lit(0)) > 0}).fillna(
        0, ["n_pre_syn", "n_post_syn", "assigned_pre_syn", "assigned_post_syn"]
    )


def distance_summary(detail: DataFrame, rows: int | None = None) -> DataFrame:
    """Distance statistics by synapse type."""
    d = F.col("distance_um")
    basic = detail.groupBy("syn_type").agg(
        F.count(d).alias("n"), F.avg(d).alias("mean_um"), F.stddev_samp(d).alias("std_um"),
        F.min(d).alias("min_um"), F.max(d).alias("max_um"),
    )
    q = ordering.quantiles(
        detail, ["syn_type"], "distance_um",
        {"median_um": 0.5, "p90_um": 0.9, "p95_um": 0.95, "p99_um": 0.99}, rows,
    )
    return basic.join(q, "syn_type")


COVERAGE_UM = (0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0)
EXCEED_UM = (1.0, 2.0, 5.0, 10.0, 20.0)


def _valid(detail: DataFrame) -> DataFrame:
    d = F.col("distance_um")
    return detail.filter(d.isNotNull() & ~F.isnan(d) & (d >= 0))


def threshold_coverage(detail: DataFrame, thresholds=COVERAGE_UM) -> DataFrame:
    """Percentage of synapses within, and number beyond, each distance."""
    d = F.col("distance_um")
    wide = _valid(detail).groupBy("syn_type").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(d <= t).alias(f"w{i}") for i, t in enumerate(thresholds)]
    )
    rows = F.array(
        *[F.struct(F.lit(float(t)).alias("threshold_um"), F.col(f"w{i}").alias("within_n")) for i, t in enumerate(thresholds)]
    )
    return wide.select("syn_type", "n", F.inline(rows)).withColumns(
        {"within_percent": F.col("within_n") * 100.0 / F.col("n"), "beyond_n": F.col("n") - F.col("within_n")}
    )


def histogram(values: DataFrame, value: Column, lo: float, hi: float, bins: int, keys=()) -> DataFrame:
    """Equal-width counts on [lo, hi] (last bin closed), density and running share.

    The share divides by all rows, the ones outside the range included.
    """
    keys = list(keys)
    width = (hi - lo) / bins
    slot = F.when((value >= lo) & (value < hi), F.least(F.floor((value - lo) / width), F.lit(bins - 1))).when(value == hi, bins - 1)
    counted = values.select(*keys, slot.cast("bigint").alias("bin")).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    # at most bins + 1 rows per key from here on
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("_all"), F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))).alias("_in"))
    shown = counted.filter("bin IS NOT NULL")
    shown = shown.join(totals, keys) if keys else shown.crossJoin(F.broadcast(totals))  # one row
    cum = ordering.running(shown, keys, ["bin"], {"_cum": F.col("n")}, rows=min(bins, ordering.HOT_ROWS))
    return cum.select(
        *keys, "bin", (F.lit(lo) + F.col("bin") * width).alias("bin_lo"), "n",
        (F.col("n") / (F.col("_in") * width)).alias("density"), (F.col("_cum") / F.col("_all")).alias("cdf"),
    )


def node_distances(detail: DataFrame, rows: int | None = None) -> DataFrame:
    """Median synapse distance of nodes that hold only pre- or only post-synapses."""
    sides = detail.groupBy("neuron", "assigned_node_id").agg(
        F.count_if(F.col("syn_type") == "pre").alias("n_pre"), F.count_if(F.col("syn_type") == "post").alias("n_post")
    )
    pure = sides.filter((F.col("n_pre") == 0) != (F.col("n_post") == 0))
    med = ordering.quantiles(detail, ["neuron", "assigned_node_id"], "distance_um", {"distance_um": 0.5}, rows)
    return pure.join(med, ["neuron", "assigned_node_id"]).select(
        "neuron", F.col("assigned_node_id").alias("id"),
        F.when(F.col("n_pre") > 0, 2).otherwise(3).alias("node_type"), (F.col("n_pre") + F.col("n_post")).alias("n"), "distance_um",
    )
