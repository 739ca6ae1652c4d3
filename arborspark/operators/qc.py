"""Quality checks: child-count summaries, long segments, soma coverage, descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborspark.operators import ordering, topology
from arborspark.schema import NM_PER_UM

# Fixed values of the long-segment screen.
LONG_UM = 5.0
MIN_CHILDREN = 2
MIN_LONG = 2


def zero_summary(nodes: DataFrame) -> DataFrame:
    """Type-0 nodes per neuron by number of children, with the histogram as JSON."""
    zero = topology.child_counts(nodes).withColumn("is0", F.col("type") == 0)
    # first by child count, so that one neuron's nodes are summed before they meet
    by_count = zero.groupBy("neuron", "n_children").agg(F.count(F.lit(1)).alias("n"), F.count_if("is0").alias("n0"))
    n0 = lambda cond: F.sum(F.when(cond, F.col("n0")).otherwise(0))
    c = F.col("n_children")
    pairs = F.array_sort(F.collect_list(F.when(F.col("n0") > 0, F.struct(c.alias("k"), F.col("n0").alias("v")))))
    out = by_count.groupBy("neuron").agg(
        F.sum("n").alias("n_nodes"),
        F.sum("n0").alias("type0_n"),
        n0(c == 0).alias("type0_terminal_n"),
        n0(c == 1).alias("type0_continuation_n"),
        n0(c == 2).alias("type0_bifurcation_n"),
        n0(c >= 3).alias("type0_multifurcation_n"),
        n0(c >= 2).alias("type0_branch_n"),
        F.coalesce(F.max(F.when(F.col("n0") > 0, c)), F.lit(0).cast("bigint")).alias("type0_max_children"),
        pairs.alias("_pairs"),
    )
    text = F.transform("_pairs", lambda p: F.concat(F.lit('"'), p.k.cast("string"), F.lit('":'), p.v.cast("string")))
    return out.withColumns(
        {
            "has_type0_branch": F.col("type0_branch_n") > 0,
            "has_type0_multifurcation": F.col("type0_multifurcation_n") > 0,
            "distribution": F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}")),
        }
    ).drop("_pairs")


def merged_distribution(summary: DataFrame) -> DataFrame:
    """All per-neuron JSON histograms added up."""
    parsed = F.from_json("distribution", "map<string,bigint>")
    entries = summary.select(F.explode(parsed).alias("k", "n"))
    return entries.groupBy(F.col("k").cast("int").alias("n_children")).agg(F.sum("n").alias("n_nodes"))


def branch_summary(nodes: DataFrame) -> DataFrame:
    """Type-5 nodes per neuron by number of children."""
    c = F.col("n_children")
    five = F.col("type") == 5
    return (
        topology.child_counts(nodes)
        .groupBy("neuron")
        .agg(
            F.count_if(five).alias("type5_n"),
            F.count_if(five & (c > 2)).alias("branch_gt2"),
            F.count_if(five & (c == 2)).alias("branch_eq2"),
            F.count_if(five & (c == 1)).alias("no_branch"),
            F.count_if(five & (c == 0)).alias("terminal_n"),
            (F.count_if(five & (c == 0)) > 0).alias("has_terminal"),
        )
    )


def terminal_check(nodes: DataFrame) -> DataFrame:
    """Type-6 nodes per neuron: how many are really terminal."""
    c, six = F.col("n_children"), F.col("type") == 6
    return (
        topology.child_counts(nodes)
        .groupBy("neuron")
        .agg(
            F.count(F.lit(1)).alias("n_nodes"),
            F.count_if(six).alias("type6_n"),
            F.count_if(six & (c == 0)).alias("type6_terminal_n"),
            F.count_if(six & (c > 0)).alias("type6_with_children_n"),
            F.coalesce(F.max(F.when(six, c)), F.lit(0).cast("bigint")).alias("type6_max_children"),
            (F.count_if(six & (c > 0)) == 0).alias("all_type6_terminal"),
        )
    )


def terminal_violations(nodes: DataFrame) -> DataFrame:
    """The Type-6 nodes that have children."""
    return topology.child_counts(nodes).filter("type = 6 AND n_children > 0").select("neuron", F.col("id").alias("node_id"), "n_children")


def soma_children(nodes: DataFrame) -> DataFrame:
    """Rows whose parent is any soma of the neuron, with the soma number."""
    somas = nodes.filter("type = 1").select("neuron", F.col("id").alias("parent"))
    hits = nodes.join(somas, ["neuron", "parent"], "left_semi").groupBy("neuron").agg(F.count(F.lit(1)).alias("soma_children"))
    counts = nodes.groupBy("neuron").agg(F.count_if(F.col("type") == 1).alias("n_soma"))
    return counts.join(hits, "neuron", "left").fillna(0, ["soma_children"])


# ------------------------------------------------------------ long segments

def segment_lengths(nodes: DataFrame) -> DataFrame:
    """Finite child-parent segments in micrometres."""
    e = topology.edges(nodes, NM_PER_UM, carry=["type"])
    finite = ~F.isnan("length") & (F.col("length") < float("inf"))
    return e.filter(finite).select("neuron", "parent", "id", "type", F.col("p_type").alias("parent_type"), F.col("length").alias("length_um"))


def _parents(segments: DataFrame) -> DataFrame:
    far = F.col("length_um") > LONG_UM
    return segments.groupBy("neuron", "parent").agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(far).alias("n_long")
    )


def long_child_screen(nodes: DataFrame) -> DataFrame:
    """Per neuron: parents with at least two children of which two are long."""
    p = _parents(segment_lengths(nodes))
    branching = F.col("n_children") >= MIN_CHILDREN
    hit = branching & (F.col("n_long") >= MIN_LONG)
    per = p.groupBy("neuron").agg(
        F.sum("n_children").alias("n_valid_segments"),
        F.count_if(branching).alias("n_branch_parents"),
        F.count_if(hit).alias("n_matching_parents"),
        F.sum(F.when(hit, F.col("n_long")).otherwise(0)).alias("n_matching_long_segments"),
        F.max("n_long").alias("max_long_children_same_parent"),
    )
    sizes = nodes.groupBy("neuron").agg(F.count(F.lit(1)).alias("n_nodes"))
    out = sizes.join(per, "neuron", "left").fillna(0)
    return out.withColumn("matched", F.col("n_matching_parents") > 0)


def long_child_detail(nodes: DataFrame) -> DataFrame:
    """Matching parents with their long children listed longest first."""
    s = segment_lengths(nodes)
    hits = _parents(s).filter((F.col("n_children") >= MIN_CHILDREN) & (F.col("n_long") >= MIN_LONG))
    far = s.filter(F.col("length_um") > LONG_UM).join(hits, ["neuron", "parent"])
    entry = F.struct((-F.round("length_um", 6)).alias("k"), "id", "type", F.col("length_um").alias("l"))
    g = far.groupBy("neuron", "parent", "parent_type", "n_children", "n_long").agg(
        F.array_sort(F.collect_list(entry)).alias("_c"),
        F.min("length_um").alias("min_long_um"), F.avg("length_um").alias("mean_long_um"), F.max("length_um").alias("max_long_um"),
    )
    listed = lambda f: F.array_join(F.transform("_c", f), "|")
    return g.select(
        "neuron", F.col("parent").alias("parent_id"), "parent_type", "n_children", "n_long",
        listed(lambda c: c.id.cast("string")).alias("long_child_ids"),
        listed(lambda c: c.type.cast("string")).alias("long_child_types"),
        listed(lambda c: F.format_string("%.3f", c.l)).alias("long_child_lengths_um"),
        "min_long_um", "mean_long_um", "max_long_um",
    )


def folder_summary(screen: DataFrame, folder) -> DataFrame:
    """Neurons per folder: all, matching and not matching."""
    return screen.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if("matched").alias("matching_files"),
        F.count_if(~F.col("matched")).alias("non_matching_files"),
    )


# ------------------------------------------------------------- descriptions

def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, column: str, probs: dict[str, float], keys: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Count, mean, spread, extremes and exact percentiles of one column."""
    keys = list(keys)
    v = F.col(column)
    basic = df.groupBy(*keys).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    q = ordering.quantiles(df, keys, column, probs, rows)
    return basic.join(q, keys) if keys else basic.crossJoin(F.broadcast(q))  # one row each


def annotation_overlap(scan: DataFrame, metadata: DataFrame) -> DataFrame:
    """How skeletons with and without a soma meet the soma list."""
    listed = metadata.dropna(subset=["root_id"]).select(F.col("root_id").alias("neuron")).distinct().withColumn("listed", F.lit(True))
    seen = scan.select("neuron", (F.col("n_soma_nodes") > 0).alias("has_soma"))
    both = seen.join(listed, "neuron", "full_outer")
    known, soma = F.col("listed").isNotNull(), F.coalesce("has_soma", F.lit(False))
    skeleton = F.col("has_soma").isNotNull()
    return both.agg(
        F.count_if(skeleton).alias("skeletons"),
        F.count_if(soma).alias("with_soma"),
        F.count_if(skeleton & ~soma).alias("without_soma"),
        F.count_if(known).alias("listed"),
        F.count_if(soma & known).alias("with_soma_listed"),
        F.count_if(soma & ~known).alias("with_soma_unlisted"),
        F.count_if(skeleton & ~soma & known).alias("without_soma_listed"),
        F.count_if(~skeleton & known).alias("listed_without_skeleton"),
    )


def keep_last(rows: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The latest row per key (a resumed log written more than once)."""
    others = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), sequence).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def remaining(files: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Files not yet completed without error in the log."""
    done = log.filter("error IS NULL OR error = ''").select(key).distinct()
    return files.join(done, key, "left_anti")


def fingerprint(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SHA-256 of every row and one order-free digest of the whole listing."""
    line = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)
    # the sum of 52-bit prefixes is independent of row order and needs one pass
    part = F.conv(F.substring(line, 1, 13), 16, 10).cast("decimal(38,0)")
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.sum(part).alias("_s")).select(
        "n_files", F.sha2(F.concat_ws("|", F.col("n_files").cast("string"), F.col("_s").cast("string")), 256).alias("signature")
    )


def sample_names(files: DataFrame, name: str, n: int, seed: int) -> DataFrame:
    """A reproducible sample without replacement: the n smallest seeded digests."""
    return files.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(name).cast("string"))), name).limit(n)


def paired_sample(repaired: DataFrame, raw: DataFrame, name: str, n: int, seed: int) -> DataFrame:
    """(name, has_raw): a sample of the repaired names and whether the raw side has the partner."""
    there = raw.select(name).distinct().withColumn("has_raw", F.lit(True))
    return sample_names(repaired.select(name).distinct(), name, n, seed).join(there, name, "left").fillna({"has_raw": False})


def sample_report(sample: DataFrame, name: str) -> DataFrame:
    """One row: sampled, raw_found, raw_missing and the missing names in order."""
    gone = ~F.col("has_raw")
    return sample.agg(
        F.count(F.lit(1)).alias("sampled"), F.count_if("has_raw").alias("raw_found"), F.count_if(gone).alias("raw_missing"),
        F.array_join(F.sort_array(F.collect_list(F.when(gone, F.col(name)))), ",").alias("missing"),
    )


def source_summary(log: DataFrame) -> DataFrame:
    """Relinking totals per source group."""
    z = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    return log.groupBy("source_group").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("n_relinked_branches") > 0).alias("relinked_files"),
        F.count_if(F.col("output_method") == "fallback_copy").alias("fallback_copies"),
        z("n_nodes_before").alias("n_nodes_before"),
        z("n_nodes_after").alias("n_nodes_after"),
        z("n_type5_relinked").alias("n_type5_relinked"),
        z("n_relinked_branches").alias("n_relinked_branches"),
    )


def log_totals(log: DataFrame, sums: Sequence[str], error: str | None = None) -> DataFrame:
    """One row: number of files, errors and column totals."""
    bad = F.count_if(F.col(error).isNotNull() & (F.col(error) != "")) if error else F.lit(0).cast("bigint")
    return log.agg(F.count(F.lit(1)).alias("files"), bad.alias("errors"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums])
