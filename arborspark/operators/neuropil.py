"""Nodes in brain regions: containment, branch-order tables, profiles and pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborspark.operators import ordering
from arborspark.schema import NEUROPIL_GROUP_OF, NEUROPIL_ORDER
from arborspark.session import land

OUTSIDE = "OUTSIDE"
MIN_ORDER, MAX_ORDER = 1, 60


# -------------------------------------------------------------- containment
# Face tables hold region (or another key), face_id and corners u, v, w:
# ux, uy, uz, vx, ..., wz.

def _prepared(faces: DataFrame) -> DataFrame:
    """Per face: its three sides in one fixed direction and its plane.

    Side s runs from (s_y, s_z) along (s_dy, s_dz); ``s_turned`` tells whether
    the direction was reversed.  Two faces sharing a side see the same numbers,
    so they agree even about a point exactly on it.
    """
    c = F.col
    columns = {}
    for a, b in ("uv", "vw", "wu"):
        turned = (c(f"{a}y") > c(f"{b}y")) | ((c(f"{a}y") == c(f"{b}y")) & (c(f"{a}z") > c(f"{b}z")))
        pick = lambda axis, first, second: F.when(turned, c(f"{second}{axis}")).otherwise(c(f"{first}{axis}"))
        columns |= {
            f"{a}{b}_turned": turned, f"{a}{b}_y": pick("y", a, b), f"{a}{b}_z": pick("z", a, b),
            f"{a}{b}_dy": pick("y", b, a) - pick("y", a, b), f"{a}{b}_dz": pick("z", b, a) - pick("z", a, b),
        }
    e = {a: c(f"v{a}") - c(f"u{a}") for a in "xyz"}
    f = {a: c(f"w{a}") - c(f"u{a}") for a in "xyz"}
    columns |= {
        "nx": e["y"] * f["z"] - e["z"] * f["y"], "ny": e["z"] * f["x"] - e["x"] * f["z"], "nz": e["x"] * f["y"] - e["y"] * f["x"]
    }
    columns |= {f"{side}{a}": f(f"u{a}", f"v{a}", f"w{a}") for a in "xyz" for side, f in (("lo", F.least), ("hi", F.greatest))}
    return faces.withColumns(columns)


def _crosses() -> Column:
    """Does the ray from (px, py, pz) towards +x pass through the prepared face?"""
    c = F.col
    hand = lambda s: (c(f"{s}_dy") * (c("pz") - c(f"{s}_z")) - c(f"{s}_dz") * (c("py") - c(f"{s}_y")) >= 0) != c(f"{s}_turned")
    met = c("ux") - (c("ny") * (c("py") - c("uy")) + c("nz") * (c("pz") - c("uz"))) / c("nx")
    return (c("nx") != 0) & (hand("uv") == hand("vw")) & (hand("vw") == hand("wu")) & (met > c("px"))


def _bounded() -> Column:
    inside = [F.col(f"p{a}").between(F.col(f"lo{a}"), F.col(f"hi{a}")) for a in "xyz"]
    return inside[0] & inside[1] & inside[2]


def _touches() -> Column:
    """Does the prepared face hold (px, py, pz), a point within its bounds, its sides and corners included?

    Plane and bounds are exact; only at a slanting side rounding is allowed for,
    so that no gap opens between two faces sharing it.
    """
    c = F.col
    d = {a: c(f"p{a}") - c(f"u{a}") for a in "xyz"}
    held = c("nx") * d["x"] + c("ny") * d["y"] + c("nz") * d["z"] == 0
    area = c("nx") * c("nx") + c("ny") * c("ny") + c("nz") * c("nz")
    for a, b in ("uv", "vw", "wu"):
        s, q = {x: c(f"{b}{x}") - c(f"{a}{x}") for x in "xyz"}, {x: c(f"p{x}") - c(f"{a}{x}") for x in "xyz"}
        turn = sum((c(f"n{x}") * (s[y] * q[z] - s[z] * q[y]) for x, y, z in ("xyz", "yzx", "zxy")), F.lit(0.0))
        held = held & (turn >= area * -1e-12)
    return held & (area > 0)


def regions_of_points(points: DataFrame, faces: DataFrame, cell: float = 8.0) -> DataFrame:
    """(pid, region) pairs where the closed mesh of the region holds the point.

    ``points``: pid, px, py, pz.  Faces are listed under every (y, z) cell their
    projection touches and points meet only the faces of their own cell; an odd
    number of crossings along +x means inside, and so does a place on a face.
    """
    span = lambda a: F.sequence(
        F.floor(F.least(f"u{a}", f"v{a}", f"w{a}") / cell), F.floor(F.greatest(f"u{a}", f"v{a}", f"w{a}") / cell)
    )
    listed = land(_prepared(faces).withColumn("gy", F.explode(span("y"))).withColumn("gz", F.explode(span("z"))), "faces")
    placed = points.withColumns({"gy": F.floor(F.col("py") / cell), "gz": F.floor(F.col("pz") / cell)})
    met = placed.join(listed, ["gy", "gz"])
    # two short filters: one long one would defeat the JIT
    hits = met.filter(_crosses()).select("pid", "region", F.lit(False).alias("t"))
    held = met.filter(_bounded()).filter(_touches()).select("pid", "region", F.lit(True).alias("t"))
    told = hits.unionByName(held).groupBy("pid", "region").agg(F.count_if(~F.col("t")).alias("n"), F.max("t").alias("on"))
    return told.filter("on OR n % 2 = 1").select("pid", "region")


def regions_of_boxes(points: DataFrame, boxes: DataFrame, cell: float = 8.0) -> DataFrame:
    """(pid, region) pairs for axis-aligned boxes, met through shared (x, y) cells."""
    span = lambda a: F.sequence(F.floor(F.col(f"lo_{a}") / cell), F.floor(F.col(f"hi_{a}") / cell))
    listed = boxes.withColumn("gx", F.explode(span("x"))).withColumn("gy", F.explode(span("y")))
    placed = points.withColumns({"gx": F.floor(F.col("px") / cell), "gy": F.floor(F.col("py") / cell)})
    inside = [F.col(f"p{a}").between(F.col(f"lo_{a}"), F.col(f"hi_{a}")) for a in "xyz"]
    return placed.join(listed, ["gx", "gy"]).filter(inside[0] & inside[1] & inside[2]).select("pid", "region")


def label_in_boxes(points: DataFrame, boxes: DataFrame, cell: float = 8.0) -> DataFrame:
    """``label_points`` of ``regions_of_boxes``: each point meets the list of its cell's boxes once and is not shuffled again."""
    span = lambda a: F.explode(F.sequence(F.floor(F.col(f"lo_{a}") / cell), F.floor(F.col(f"hi_{a}") / cell)))
    bounds = [f"{side}_{a}" for a in "xyz" for side in ("lo", "hi")]
    listed = boxes.withColumn("gx", span("x")).withColumn("gy", span("y"))
    listed = listed.groupBy("gx", "gy").agg(F.collect_list(F.struct("region", *bounds)).alias("_boxes"))
    placed = points.withColumns({"gx": F.floor(F.col("px") / cell), "gy": F.floor(F.col("py") / cell)}).join(listed, ["gx", "gy"], "left")

    def holds(b: Column) -> Column:
        inside = [F.col(f"p{a}").between(b[f"lo_{a}"], b[f"hi_{a}"]) for a in "xyz"]
        return inside[0] & inside[1] & inside[2]

    names = F.array_join(F.array_sort(F.array_distinct(F.filter("_boxes", holds).region)), "|")
    return placed.select(*points.columns, F.coalesce(F.nullif(names, F.lit("")), F.lit(OUTSIDE)).alias("neuropil"))


def label_points(points: DataFrame, pairs: DataFrame) -> DataFrame:
    """Points with one label: region, several joined by ``|`` in name order, or OUTSIDE."""
    names = pairs.groupBy("pid").agg(F.array_join(F.array_sort(F.collect_set("region")), "|").alias("neuropil"))
    return points.join(names, "pid", "left").fillna(OUTSIDE, ["neuropil"])


# ------------------------------------------------------------------- tables
# Labelled nodes: neuron, node_type, neuropil, branch_order.

def file_summary(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("neuron").agg(
        F.count(F.lit(1)).alias("n_target_nodes"),
        F.count_if(F.col("neuropil") == OUTSIDE).alias("n_outside"),
        F.count_if(F.col("neuropil").contains("|")).alias("n_multi"),
    )


def order_counts(labelled: DataFrame, include_outside: bool = False) -> DataFrame:
    """Node numbers by neuron, type, region and branch order."""
    kept = labelled if include_outside else labelled.filter(F.col("neuropil") != OUTSIDE)
    return kept.groupBy("neuron", "node_type", "neuropil", "branch_order").agg(F.count(F.lit(1)).alias("node_count"))


def order_fractions(counts: DataFrame) -> DataFrame:
    """Share of each branch order within neuron, type and region."""
    total = counts.groupBy("neuron", "node_type", "neuropil").agg(F.sum("node_count").alias("_t"))
    joined = counts.join(total, ["neuron", "node_type", "neuropil"])
    return joined.withColumn("fraction", F.col("node_count") / F.col("_t")).drop("_t")


def pooled(counts: DataFrame) -> DataFrame:
    """Counts over all neurons with the share inside type and region."""
    g = counts.groupBy("node_type", "neuropil", "branch_order").agg(
        F.sum("node_count").alias("node_count"), F.countDistinct("neuron").alias("n_neurons")
    )
    # at most (types x regions x orders) rows from here on
    w = Window.partitionBy("node_type", "neuropil")
    return g.withColumn("node_fraction", F.col("node_count") / F.sum("node_count").over(w))


def zero_filled(fractions: DataFrame, rows: int | None = None) -> DataFrame:
    """Per type, region and order: mean, median, spread of the fractions over all
    neurons of the group, neurons without the order counting as zero.

    The zeros are never written out: sums take them as an offset and the median
    is read at the rank shifted by their number.
    """
    group = ["node_type", "neuropil"]
    cell = [*group, "branch_order"]
    size = fractions.groupBy(*group).agg(F.countDistinct("neuron").alias("n_neurons"))
    f = F.col("fraction")
    stats = fractions.groupBy(*cell).agg(
        F.count(f).alias("n"), F.avg(f).alias("m"), F.var_pop(f).alias("v")
    ).join(size, group)
    n, here, mean = F.col("n_neurons"), F.col("n"), F.col("m") * F.col("n") / F.col("n_neurons")
    squares = F.col("v") * here + here * F.pow(F.col("m") - mean, 2) + (n - here) * mean * mean
    sd = F.when(n > 1, F.sqrt(squares / F.greatest(n - 1, F.lit(1)))).otherwise(0.0)
    counted = ordering.value_counts(fractions, cell, "fraction")
    ranked = ordering.running(counted, cell, ["fraction"], {"_cum": F.col("_c")}, rows)
    ranked = ranked.join(stats.select(*cell, "n", "n_neurons"), cell)
    zeros = n - here
    first, last = zeros + F.col("_cum") - F.col("_c"), zeros + F.col("_cum")
    pick = lambda r: F.coalesce(F.max(F.when((r >= first) & (r < last), f)), F.lit(0.0))
    median = ranked.groupBy(*cell).agg(
        ((pick(F.floor((n - 1) / 2)) + pick(F.ceil((n - 1) / 2))) / 2).alias("median_fraction")
    )
    return stats.join(median, cell).select(
        *cell, "n_neurons", mean.alias("mean_fraction"), "median_fraction",
        sd.alias("std_fraction"), F.when(n > 1, sd / F.sqrt(n)).otherwise(0.0).alias("sem_fraction"),
    )


def strip_side(name: Column) -> Column:
    return F.regexp_replace(name, "_(L|R)$", "")


def analysed(counts: DataFrame, types=(2, 3, 4), dictionary_only: bool = False) -> DataFrame:
    """Counts kept for the profiles: wanted types, orders 1-60, one known region, side removed."""
    out = counts.withColumn("neuropil", strip_side(F.col("neuropil"))).filter(
        F.col("node_type").isin(*types) & F.col("branch_order").between(MIN_ORDER, MAX_ORDER)
    )
    if dictionary_only:
        return out.filter(F.col("neuropil").isin(*NEUROPIL_ORDER))
    return out.filter((F.col("neuropil") != OUTSIDE) & ~F.col("neuropil").contains("|"))


def profiles(kept: DataFrame) -> DataFrame:
    """Order profile per type and region: counts and shares of the orders present."""
    g = kept.groupBy("node_type", "neuropil", "branch_order").agg(F.sum("node_count").alias("node_count"))
    w = Window.partitionBy("node_type", "neuropil")
    return g.withColumn("fraction", F.col("node_count") / F.sum("node_count").over(w))


def full_grid(profile: DataFrame) -> DataFrame:
    """Profiles with all orders 1-60, zeros included (60 rows per type and region)."""
    orders = F.explode(F.sequence(F.lit(MIN_ORDER), F.lit(MAX_ORDER)).cast("array<int>")).alias("branch_order")
    grid = profile.select("node_type", "neuropil").distinct().select("node_type", "neuropil", orders)
    out = grid.join(profile, ["node_type", "neuropil", "branch_order"], "left")
    return out.fillna(0).select("node_type", "neuropil", "branch_order", "node_count", "fraction")


def minmax_rows(grid: DataFrame) -> DataFrame:
    """Shares rescaled to 0-1 within type and region (constant rows become 0)."""
    w = Window.partitionBy("node_type", "neuropil")
    lo, hi = F.min("fraction").over(w), F.max("fraction").over(w)
    return grid.withColumn("scaled", (F.col("fraction") - lo) / F.when(hi > lo, hi - lo).otherwise(1.0))


def order_matrix(grid: DataFrame) -> DataFrame:
    """Count matrix: one row per type and region, one column per order."""
    return grid.groupBy("node_type", "neuropil").pivot("branch_order", list(range(MIN_ORDER, MAX_ORDER + 1))).agg(F.sum("node_count"))


def _facing(profile: DataFrame, a: int, b: int) -> DataFrame:
    """Both types' shares per region and order, regions present in both only."""
    pick = lambda t, name: profile.filter(F.col("node_type") == t).select("neuropil", "branch_order", F.col("fraction").alias(name))
    left, right = pick(a, "p"), pick(b, "q")
    shared = left.select("neuropil").distinct().join(right.select("neuropil").distinct(), "neuropil")
    return left.join(right, ["neuropil", "branch_order"], "full_outer").fillna(0.0, ["p", "q"]).join(shared, "neuropil", "left_semi")


def _divergence(p: Column, q: Column) -> Column:
    m = (p + q) / 2
    term = lambda a: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    return (term(p) + term(q)) / 2


def topology_metrics(profile: DataFrame, a: int = 2, b: int = 3) -> DataFrame:
    """Mean order of both types per region, their difference and JS divergence (base 2)."""
    p, q, o = F.col("p"), F.col("q"), F.col("branch_order")
    groups = F.create_map(*[F.lit(x) for kv in NEUROPIL_GROUP_OF.items() for x in kv])
    out = _facing(profile, a, b).groupBy("neuropil").agg(
        F.sum(p * o).alias("pre_mean_order"),
        F.sum(q * o).alias("post_mean_order"),
        F.greatest(F.sum(_divergence(p, q)), F.lit(0.0)).alias("js_divergence"),
    )
    return out.withColumns(
        {"region_group": F.try_element_at(groups, F.col("neuropil")), "delta_post_minus_pre": F.col("post_mean_order") - F.col("pre_mean_order")}
    )


def similarity_pairs(profile: DataFrame, a: int = 2, b: int = 3) -> DataFrame:
    """1 - JS distance between every pre profile and every post profile.

    Only orders both profiles use contribute more than their own mass, so the
    divergence is 1 plus a sum over shared orders.  Regions meet on the order
    column; a zero entry at the first order lets every pair meet at least once.
    """
    shared = _facing(profile, a, b).select("neuropil").distinct()
    zero = shared.select("neuropil", F.lit(MIN_ORDER).alias("branch_order"), F.lit(0.0).alias("fraction"))

    def side(t: int, region: str, share: str) -> DataFrame:
        used = profile.filter(F.col("node_type") == t).join(shared, "neuropil", "left_semi")
        padded = used.select("neuropil", "branch_order", "fraction").unionByName(zero)
        return padded.groupBy(F.col("neuropil").alias(region), "branch_order").agg(F.sum("fraction").alias(share))

    p, q = F.col("p"), F.col("q")
    met = side(a, "pre_region", "p").join(side(b, "post_region", "q"), "branch_order")
    pairs = met.groupBy("pre_region", "post_region").agg(F.sum(_divergence(p, q) - (p + q) / 2).alias("_s"))
    jsd = F.greatest(1 + F.col("_s"), F.lit(0.0))
    return pairs.select(
        "pre_region", "post_region", (F.col("pre_region") == F.col("post_region")).alias("same_region"), (1 - F.sqrt(jsd)).alias("similarity")
    )


# Shares of the top neurons reported.
TOP_SHARES = (0.01, 0.05, 0.10, 0.20, 0.50)


def outside_summary(summary: DataFrame, rows: int | None = None) -> DataFrame:
    """Means and medians of the nodes outside every region, per neuron."""
    s = summary.withColumn("outside_fraction", F.col("n_outside") / F.nullif(F.col("n_target_nodes"), F.lit(0)))
    base = s.agg(
        F.count(F.lit(1)).alias("n_neurons"), F.count_if(F.col("n_outside") > 0).alias("with_outside"),
        F.avg("n_outside").alias("mean_outside"), F.avg("outside_fraction").alias("mean_outside_fraction"),
    )
    m = ordering.quantiles(s, [], "n_outside", {"median_outside": 0.5}, rows)
    f = ordering.quantiles(s, [], "outside_fraction", {"median_outside_fraction": 0.5}, rows)
    return base.crossJoin(F.broadcast(m)).crossJoin(F.broadcast(f))  # one row each


def outside_top_share(summary: DataFrame, rows: int | None = None) -> DataFrame:
    """Share of all outside nodes held by the top 1, 5, 10, 20 and 50 % of neurons."""
    held = summary.filter("n_outside > 0").groupBy("n_outside").agg(F.count(F.lit(1)).alias("c"))
    held = held.withColumn("_desc", -F.col("n_outside"))
    ran = ordering.running(held, [], ["_desc"], {"cn": F.col("c"), "cs": F.col("c") * F.col("n_outside")}, rows)
    total = held.agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("n_outside")).alias("s"))
    shares = F.explode(F.array(*[F.lit(p) for p in TOP_SHARES])).alias("top_share")
    wanted = total.select("n", "s", shares).withColumn(
        "k", F.greatest(F.lit(1), F.ceil(F.round(F.col("n") * F.col("top_share"), 9)))
    )
    # at most five wanted rows
    met = ran.join(F.broadcast(wanted), (F.col("cn") >= F.col("k")) & (F.col("cn") - F.col("c") < F.col("k")))
    return met.select("top_share", "k", ((F.col("cs") - (F.col("cn") - F.col("k")) * F.col("n_outside")) / F.col("s")).alias("share"))


def equal_frequency_bins(rows_df: DataFrame, key: str, x: str, y: str, bins: int = 20) -> DataFrame:
    """``bins`` quantile bins of x per key (right-closed, repeated edges merged) with
    the median of x and the quartiles of y in every bin."""
    rows_df = land(rows_df.select(key, x, y), "points")
    n = rows_df.count()
    probs = {f"e{i:02d}": i / bins for i in range(bins + 1)}
    edges = ordering.quantiles(rows_df, [key], x, probs, n, builtin=False)
    edges = edges.select(key, F.array_distinct(F.array(*probs)).alias("_e"))
    v = F.col(x)
    placed = rows_df.join(edges, key).withColumn("bin", F.greatest(F.size(F.filter("_e", lambda e: e < v)), F.lit(1)))
    placed = land(placed.drop("_e"), "bins")
    keys = [key, "bin"]
    xs = ordering.quantiles(placed, keys, x, {"median_x": 0.5}, n)
    ys = ordering.quantiles(placed, keys, y, {"median_y": 0.5, "q25_y": 0.25, "q75_y": 0.75}, n)
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(xs, keys).join(ys, keys)
