"""Agreement between skeletons and surface meshes.

Skeleton edges become weighted centre samples, meshes become face tables
(neuron, face_id, corners u, v, w as ux..wz) and surface points; both
directions of the comparison are nearest joins inside the neuron.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborspark.operators import ordering, topology
from arborspark.operators.nearest import nearest
from arborspark.session import land

# Fixed values.
SPACING_NM, MAX_SAMPLES = 250.0, 128
SURFACE_COUNT, SURFACE_SEED = 80_000, 42
THRESHOLDS_NM = (250, 500, 1000)
MARGIN_NM, MIN_OVERLAP, GOOD_OVERLAP = 1000.0, 0.1, 0.9


def sampled_edges(nodes: DataFrame, spacing: float = SPACING_NM, most: int = MAX_SAMPLES) -> DataFrame:
    """Edges with both ends and their number of samples: what the samples follow from."""
    e = topology.edges(nodes, carry=["radius", "type"])
    e = e.filter((F.col("parent") >= 0) & (F.col("length") > 0) & (F.col("length") < float("inf")))
    n = F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(F.col("length") / spacing))).cast("int")
    ends = [f"{p}{c}" for c in ("x", "y", "z", "radius", "type") for p in ("", "p_")]
    return e.select("neuron", "id", "parent", "row_idx", *ends, "length", n.alias("n_samples"))


def samples_of(edges: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The samples of ``sampled_edges``; nothing is shuffled, so they are better expanded again than stored."""
    e = edges.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_samples") - 1)))
    return e.select(
        "neuron", F.col("id").alias("child_id"), F.col("parent").alias("parent_id"), F.col("row_idx").alias("edge_row"), "k", "n_samples",
        *[_sampled(c, F.col("k")).alias(f"s{c}") for c in "xyz"], _sampled("radius", F.col("k")).alias("radius"),
        (F.col("length") / F.col("n_samples")).alias("weight"), F.col("length").alias("length_nm"),
        ((F.col("type") == 1) | (F.col("p_type") == 1)).alias("soma_edge"), *keep,
    )


def _sampled(c: str, k: Column) -> Column:
    """Value of ``c`` at sample ``k`` of an edge: never falls, or never rises, along the edge."""
    return F.col(f"p_{c}") + (k + 0.5) / F.col("n_samples") * (F.col(c) - F.col(f"p_{c}"))


def edge_samples(nodes: DataFrame, spacing: float = SPACING_NM, most: int = MAX_SAMPLES) -> DataFrame:
    """Evenly spaced midpoints on every edge with linear radius and cable weight."""
    return samples_of(sampled_edges(nodes, spacing, most))


def weighted_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, probs: dict[str, float], tie: Sequence[str] = (), rows: int | None = None
) -> DataFrame:
    """Quantiles on the midpoint distribution (cumulated weight minus half the own),
    linear between points and clamped at both ends."""
    keys = list(keys)
    v, w = F.col(value), F.col(weight)
    ok = df.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) & (w > 0) & (w < float("inf")))
    ran = ordering.running(ok.select(*keys, v.alias("v"), w.alias("w"), *tie), keys, ["v", *tie], {"_cum": F.col("w")}, rows)
    total = ok.groupBy(*keys).agg(F.sum(w).alias("_t"))
    ran = ran.join(total, keys) if keys else ran.crossJoin(F.broadcast(total))  # one row
    c = (F.col("_cum") - F.col("w") / 2) / F.col("_t")
    point = F.struct(c.alias("c"), F.col("v").alias("v"))
    picks = [F.min(point).alias("_first"), F.max(point).alias("_last")]
    for name, p in probs.items():
        picks += [F.max(F.when(c <= p, point)).alias(f"_a_{name}"), F.min(F.when(c > p, point)).alias(f"_b_{name}")]
    out = ran.groupBy(*keys).agg(*picks)

    def read(name: str, p: float) -> Column:
        a, b = F.col(f"_a_{name}"), F.col(f"_b_{name}")
        between = a.v + (b.v - a.v) * (F.lit(p) - a.c) / (b.c - a.c)
        return F.when(a.isNull(), F.col("_first.v")).when(b.isNull(), F.col("_last.v")).otherwise(between).alias(name)

    return out.select(*keys, *[read(n, p) for n, p in probs.items()])


def radius_quantiles(edges: DataFrame, probs: dict[str, float], bands: int = 64, rounds: int = 2) -> DataFrame:
    """``weighted_quantiles`` of the radius over all samples of ``sampled_edges``, per neuron.

    A quantile lies between two neighbouring values, so every round cuts the
    values where each one may lie into ``bands`` and keeps the band in which half
    the sought weight is met.  Only weights per band are shuffled, and at the end
    the samples of the last bands with the values beside them.
    """
    e = edges.select("neuron", "id", "radius", "p_radius", "length", "n_samples")
    ends = [_sampled("radius", k) for k in (F.lit(0), F.col("n_samples") - 1)]
    e = e.withColumns({"_least": F.least(*ends), "_most": F.greatest(*ends)})
    fine = lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))
    e = land(e.filter(fine("radius") & fine("p_radius")), "sampled")
    spans = e.groupBy("neuron").agg(F.min("_least").alias("lo"), F.max("_most").alias("hi"), F.sum("length").alias("total"))
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probs.items()])).alias("_q")
    # from, to: values in question; lo, hi: the values beside them where there are any; before: weight below ``from``
    seek = land(spans.select("neuron", "total", F.col("lo").alias("least"), F.col("hi").alias("most"), named).select(
        "neuron", "_q.name", "_q.p", "total", "least", "most", F.col("least").alias("from"), F.col("most").alias("to"), F.lit(0.0).alias("before"),
        F.lit(None).cast("double").alias("beside_lo"), F.lit(None).cast("double").alias("beside_hi"),
    ), "seek")
    band = F.least(F.lit(bands - 1), F.floor((F.col("v") - F.col("from")) / F.nullif(F.col("to") - F.col("from"), F.lit(0.0)) * bands)).cast("int")
    for _ in range(rounds):
        met = _values_within(e, seek, "from", "to").groupBy("neuron", "from", "to", F.coalesce(band, F.lit(0)).alias("band")).agg(
            F.sum("w").alias("w"), F.min("v").alias("v_lo"), F.max("v").alias("v_hi")
        )
        met = met.join(seek, ["neuron", "from", "to"])
        order = Window.partitionBy("neuron", "name").orderBy("band")
        met = met.withColumns({
            "_upto": F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before"), "_last": F.lead("band").over(order).isNull(),
            "_lo": F.coalesce(F.lag("v_hi").over(order), F.col("beside_lo")), "_hi": F.coalesce(F.lead("v_lo").over(order), F.col("beside_hi")),
        })
        hit = met.filter((F.col("_upto") > F.col("p") * F.col("total")) | F.col("_last"))
        hit = hit.groupBy("neuron", "name").agg(F.min_by(F.struct(
            "p", "total", "least", "most", F.col("v_lo").alias("from"), F.col("v_hi").alias("to"), (F.col("_upto") - F.col("w")).alias("before"),
            F.col("_lo").alias("beside_lo"), F.col("_hi").alias("beside_hi"),
        ), "band").alias("_s"))
        seek = land(hit.select("neuron", "name", "_s.*"), "seek")
    # of equal values only the weight, and that of the first and the last sample, matter
    seek = seek.withColumns({"_a": F.coalesce("beside_lo", "from"), "_b": F.coalesce("beside_hi", "to")})
    v = _values_within(e, seek, "_a", "_b").groupBy("neuron", F.col("from").alias("_a"), F.col("to").alias("_b"), "v").agg(
        F.sum("w").alias("w"), F.min_by("w", "id").alias("first"), F.max_by("w", "id").alias("last")
    )
    v = v.join(seek, ["neuron", "_a", "_b"])
    low = Window.partitionBy("neuron", "name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    # ``before`` counts from ``from``; the value beside it is part of that weight
    v = v.withColumn("_upto", F.col("before") + F.sum(F.when(F.col("v") >= F.col("from"), F.col("w")).otherwise(0.0)).over(low))
    points = v.withColumn("_pt", F.explode(F.array(
        F.struct(((F.col("_upto") - F.col("w") + F.col("first") / 2) / F.col("total")).alias("c"), F.col("v").alias("v")),
        F.struct(((F.col("_upto") - F.col("last") / 2) / F.col("total")).alias("c"), F.col("v").alias("v")),
    ))).select("neuron", "name", "p", "least", "most", "_pt.c", "_pt.v")
    point = F.struct("c", "v")
    picked = points.groupBy("neuron", "name", "p", "least", "most").agg(F.max(F.when(F.col("c") <= F.col("p"), point)).alias("a"), F.min(F.when(F.col("c") > F.col("p"), point)).alias("b"))
    a, b = F.col("a"), F.col("b")
    value = F.when(a.isNull(), F.col("least")).when(b.isNull(), F.col("most")).otherwise(a.v + (b.v - a.v) * (F.col("p") - a.c) / (b.c - a.c))
    read = picked.select("neuron", "name", value.alias("value"))
    return read.groupBy("neuron").agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in probs])


def _values_within(edges: DataFrame, seek: DataFrame, lo: str, hi: str) -> DataFrame:
    """Radius ``v`` and weight ``w`` of the samples from ``lo`` to ``hi`` of the neuron's sought values, with both as from and to."""
    wanted = seek.select("neuron", F.col(lo).alias("from"), F.col(hi).alias("to")).distinct()
    met = edges.join(wanted, "neuron").filter((F.col("_most") >= F.col("from")) & (F.col("_least") <= F.col("to")))
    # samples outside are passed over by their number, one more on both sides against rounding; nearly level edges are read whole
    rise, last = F.col("radius") - F.col("p_radius"), F.col("n_samples") - 1
    steep = F.abs(rise) > 1e-6 * F.greatest(F.abs("radius"), F.abs("p_radius"), F.abs("from"), F.abs("to"))
    shares = [F.greatest(F.lit(-1.0), F.least(F.lit(2.0), (F.col(c) - F.col("p_radius")) / F.when(steep, rise))) for c in ("from", "to")]
    at = [share * F.col("n_samples") - 0.5 for share in shares]
    first = F.greatest(F.lit(0), F.least(last, F.floor(F.least(*at)).cast("int") - 1))
    final = F.greatest(F.lit(0), F.least(last, F.ceil(F.greatest(*at)).cast("int") + 1))
    k = F.explode(F.sequence(F.when(steep, first).otherwise(0), F.when(steep, final).otherwise(last)))
    met = met.select("neuron", "from", "to", "id", "radius", "p_radius", "n_samples", (F.col("length") / F.col("n_samples")).alias("w"), k.alias("k"))
    return met.withColumn("v", _sampled("radius", F.col("k"))).filter(F.col("v").between(F.col("from"), F.col("to")))


# ----------------------------------------------------------------- distances

def _sub(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}{c}") - F.col(f"{b}{c}") for c in "xyz"]


def _dot(a, b) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _prepared(faces: DataFrame) -> DataFrame:
    """Faces with their bounds, unit normal and the products the distance needs."""
    corner = lambda f, c: f(f"u{c}", f"v{c}", f"w{c}")
    e, f, g = _sub("v", "u"), _sub("w", "u"), _sub("w", "v")
    normal = [e[1] * f[2] - e[2] * f[1], e[2] * f[0] - e[0] * f[2], e[0] * f[1] - e[1] * f[0]]
    out = faces.select("neuron", "face_id", *[f"{v}{c}" for v in "uvw" for c in "xyz"])
    columns = {f"l{c}": corner(F.least, c) for c in "xyz"} | {f"h{c}": corner(F.greatest, c) for c in "xyz"}
    columns |= {f"e{c}": x for c, x in zip("xyz", e)} | {f"f{c}": x for c, x in zip("xyz", f)} | {f"m{c}": x for c, x in zip("xyz", normal)}
    columns |= {"ee": _dot(e, e), "ef": _dot(e, f), "ff": _dot(f, f), "gg": _dot(g, g), "mm": _dot(normal, normal)}
    out = out.withColumns(columns)
    unit = {f"n{c}": F.when(F.col("mm") > 0, F.col(f"m{c}") / F.sqrt("mm")).otherwise(0.0) for c in "xyz"}
    det = F.col("ee") * F.col("ff") - F.col("ef") * F.col("ef")
    return out.withColumns(unit | {"inv": F.when(det > 0, 1 / F.nullif(det, F.lit(0.0)))}).drop("mx", "my", "mz", "mm", "wx", "wy", "wz", "vx", "vy", "vz")


def triangle_distance2() -> Column:
    """Squared distance from (px, py, pz) to a prepared face.

    The foot of the perpendicular counts when it falls inside the triangle,
    otherwise the closest of the three sides does.  Everything is written in the
    three products of p - u with itself and the two sides, to stay short.
    """
    c, axis = F.col, lambda name: [F.col(f"{name}{x}") for x in "xyz"]
    d = _sub("p", "u")
    dd, de, df, height = _dot(d, d), _dot(d, axis("e")), _dot(d, axis("f")), _dot(d, axis("n"))

    def side(square: Column, along: Column, norm: str) -> Column:
        t = F.when(along <= 0, 0.0).when(along >= c(norm), 1.0).otherwise(along / c(norm))
        return square - t * (2 * along - t * c(norm))

    s = c("ff") * de - c("ef") * df
    t = c("ee") * df - c("ef") * de
    inside = c("inv").isNotNull() & (s >= 0) & (t >= 0) & ((s + t) * c("inv") <= 1)
    far = df - de - c("ef") + c("ee")
    sides = F.least(side(dd, de, "ee"), side(dd, df, "ff"), side(dd - 2 * de + c("ee"), far, "gg"))
    return F.when(inside, height * height).otherwise(F.greatest(sides, F.lit(0.0)))


FACE_FIELDS = ("ux", "uy", "uz", "ex", "ey", "ez", "fx", "fy", "fz", "nx", "ny", "nz", "ee", "ef", "ff", "gg", "inv")


def triangle_squares(p: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
    """``triangle_distance2`` of every place in ``p`` to every prepared face in ``c``, term by term the same."""
    dot = lambda a, b: a[0] * b[0] + a[1] * b[1] + a[2] * b[2]
    d = [p[:, i : i + 1] - c[f"u{x}"] for i, x in enumerate("xyz")]
    dd, de, df, height = dot(d, d), *(dot(d, [c[f"{name}{x}"] for x in "xyz"]) for name in "efn")

    def side(square, along, norm):
        share = np.divide(along, norm, out=np.zeros_like(along), where=(norm > 0) & np.isfinite(along))
        t = np.where(along <= 0, 0.0, np.where(along >= norm, 1.0, share))
        return square - t * (2 * along - t * norm)

    s = c["ff"] * de - c["ef"] * df
    t = c["ee"] * df - c["ef"] * de
    inside = (s >= 0) & (t >= 0) & ((s + t) * c["inv"] <= 1)  # inv is NaN for faces without area
    far = df - de - c["ef"] + c["ee"]
    sides = np.minimum(np.minimum(side(dd, de, c["ee"]), side(dd, df, c["ff"])), side(dd - 2 * de + c["ee"], far, c["gg"]))
    return np.where(inside, height * height, np.maximum(sides, 0.0))


def to_surface(samples: DataFrame, faces: DataFrame, cell: float = 2000.0, keep: Sequence[str] = ()) -> DataFrame:
    """Distance of every centre sample to the closest face of the same neuron; ``keep`` names sample columns to stay."""
    probes = samples.select("neuron", F.struct("child_id", "k").alias("pid"), *[F.col(f"s{c}").alias(f"p{c}") for c in "xyz"], *keep)
    hit = nearest(
        probes, land(_prepared(faces), "faces"), ["neuron"], cell=cell, lo=("lx", "ly", "lz"), hi=("hx", "hy", "hz"), distance2=triangle_distance2(), tie="face_id",
        measure=triangle_squares, fields=FACE_FIELDS, keep=keep,
    )
    return hit.select("neuron", "pid.child_id", "pid.k", *keep, F.col("distance").alias("center_dist"), "face_id")


def to_vertices(samples: DataFrame, faces: DataFrame, cell: float = 2000.0, keep: Sequence[str] = ()) -> DataFrame:
    """Fallback: distance to the closest mesh vertex."""
    probes = samples.select("neuron", F.struct("child_id", "k").alias("pid"), *[F.col(f"s{c}").alias(f"p{c}") for c in "xyz"], *keep)
    corners = F.array(*[F.struct(*[F.col(f"{v}{c}").alias(c) for c in "xyz"]) for v in "uvw"])
    vertices = faces.select("neuron", F.inline(corners)).groupBy("neuron", "x", "y", "z").agg(F.count(F.lit(1)).alias("row_idx"))
    hit = nearest(probes, vertices, ["neuron"], cell=cell, keep=keep)
    return hit.select("neuron", "pid.child_id", "pid.k", *keep, F.col("distance").alias("center_dist"))


def to_samples(surface: DataFrame, samples: DataFrame, cell: float = 2000.0) -> DataFrame:
    """Closest centre sample of every surface point, with its radius and edge."""
    probes = surface.select("neuron", F.col("point_id").alias("pid"), "px", "py", "pz")
    items = samples.select(
        "neuron", F.struct("edge_row", "k").alias("row_idx"), "child_id", *[F.col(f"s{c}").alias(c) for c in "xyz"], "radius"
    )
    hit = nearest(probes, items, ["neuron"], cell=cell, carry=("child_id", "radius"))
    return hit.select("neuron", F.col("pid").alias("point_id"), "child_id", "radius", F.col("distance").alias("surface_dist"))


def sample_surface(faces: DataFrame, count: int = SURFACE_COUNT, seed: int = SURFACE_SEED, rows: int | None = None) -> DataFrame:
    """``count`` points per neuron spread over the faces in proportion to area.

    Positions come from seeded digests of neuron and point, so the same mesh gives the same points
    on any cluster.
    """
    e, f = _sub("v", "u"), _sub("w", "u")
    cross = [e[1] * f[2] - e[2] * f[1], e[2] * f[0] - e[0] * f[2], e[0] * f[1] - e[1] * f[0]]
    sized = faces.withColumn("area", F.sqrt(_dot(cross, cross)) / 2)
    ran = ordering.running(sized, ["neuron"], ["face_id"], {"_upto": F.col("area")}, rows)
    total = sized.groupBy("neuron").agg(F.sum("area").alias("_total"))
    share = ran.join(total, "neuron").filter("_total > 0 AND area > 0")
    slot = lambda a: F.ceil(F.round(a / F.col("_total") * count, 9) - 0.5)
    first, last = slot(F.col("_upto") - F.col("area")), slot(F.col("_upto")) - 1
    points = share.withColumns({"_f": F.greatest(first, F.lit(0)), "_l": F.least(last, F.lit(count - 1))}).filter("_l >= _f")
    points = _spread(points).withColumn("point_id", F.explode(F.sequence("_f", "_l")))
    points = points.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("neuron").cast("string"), F.col("point_id").cast("string"))))
    roll = lambda i: F.conv(F.substring("_h", 1 + 7 * i, 7), 16, 10).cast("double") / float(1 << 28)
    points = points.withColumns({"_a": F.sqrt(roll(0)), "_b": roll(1)})
    at = lambda c: (1 - F.col("_a")) * F.col(f"u{c}") + F.col("_a") * (1 - F.col("_b")) * F.col(f"v{c}") + F.col("_a") * F.col("_b") * F.col(f"w{c}")
    return points.select("neuron", "point_id", "face_id", *[at(c).alias(f"p{c}") for c in "xyz"])


def _spread(runs: DataFrame, stretch: int = 1 << 12, task: int = 1 << 20) -> DataFrame:
    """Runs of points (_f to _l) in stretches, dealt over as many tasks as the points, not the faces, call for."""
    n = runs.agg(F.sum(F.col("_l") - F.col("_f") + 1)).first()[0] or 0
    cut = runs.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_l") - F.col("_f")) / stretch))))
    first = F.col("_f") + F.col("_s") * stretch
    cut = cut.withColumns({"_f": first, "_l": F.least(F.col("_l"), first + stretch - 1)})
    return cut.repartition(1 + n // task, "neuron", "_f").drop("_s")


def overlap(samples: DataFrame, faces: DataFrame) -> DataFrame:
    """Share of the samples inside the mesh bounds plus a margin, and the verdict."""
    return _overlap(samples.join(_bounds(faces), "neuron"))


def edge_overlap(edges: DataFrame, faces: DataFrame) -> DataFrame:
    """``overlap`` of the samples of ``sampled_edges``: edges meet the bounds, samples only exist within a task."""
    bounds = _bounds(faces)
    return _overlap(samples_of(edges.join(bounds, "neuron"), bounds.columns[1:]))


def _bounds(faces: DataFrame) -> DataFrame:
    low = lambda c: F.min(F.least(f"u{c}", f"v{c}", f"w{c}")).alias(f"lo_{c}")
    high = lambda c: F.max(F.greatest(f"u{c}", f"v{c}", f"w{c}")).alias(f"hi_{c}")
    return faces.groupBy("neuron").agg(*[low(c) for c in "xyz"], *[high(c) for c in "xyz"])


def _overlap(bounded: DataFrame) -> DataFrame:
    inside = F.lit(True)
    for c in "xyz":
        inside = inside & F.col(f"s{c}").between(F.col(f"lo_{c}") - MARGIN_NM, F.col(f"hi_{c}") + MARGIN_NM)
    g = bounded.groupBy("neuron").agg(
        F.avg(inside.cast("double")).alias("inside_fraction"),
        (F.sum(F.when(inside, F.col("weight")).otherwise(0.0)) / F.sum("weight")).alias("center_in_mesh_aabb_fraction"),
    )
    verdict = F.when(F.col("inside_fraction") < MIN_OVERLAP, "error").when(F.col("inside_fraction") < GOOD_OVERLAP, "warning").otherwise("ok")
    return g.withColumn("overlap", verdict)


# ---------------------------------------------------------------- comparison

def match_f1(cable: Column, surface: Column) -> Column:
    return F.when(cable + surface > 0, 2 * cable * surface / (cable + surface)).otherwise(0.0)


def measure(samples: DataFrame, faces: DataFrame, surface: DataFrame, exact: bool = True, cell: float = 2000.0) -> tuple[DataFrame, DataFrame]:
    """(centre samples, surface points) with shell errors and excesses."""
    keep = [c for c in samples.columns if c not in ("neuron", "child_id", "k")]
    r = F.col("radius")
    center = (to_surface if exact else to_vertices)(samples, faces, cell, keep).withColumns(
        {"error": F.abs(F.col("center_dist") - r), "excess": F.greatest(F.col("center_dist") - r, F.lit(0.0))}
    )
    back = to_samples(surface, samples, cell).withColumns(
        {"error": F.abs(F.col("surface_dist") - r), "excess": F.greatest(F.col("surface_dist") - r, F.lit(0.0))}
    )
    return land(center, "center"), land(back, "surface")


def compare(nodes: DataFrame, samples: DataFrame, faces: DataFrame, center: DataFrame, back: DataFrame,
            thresholds: Sequence[int] = THRESHOLDS_NM, exact: bool = True, rows: int | None = None) -> DataFrame:
    """One agreement row per neuron (scope ``all``)."""
    w, key = F.col("weight"), ["neuron"]
    share = lambda cond: F.sum(F.when(cond, w).otherwise(0.0)) / F.sum(w)
    sizes = nodes.groupBy(*key).agg(F.count(F.lit(1)).alias("n_nodes"))
    c = center.groupBy(*key).agg(
        F.count_if(F.col("k") == 0).alias("n_edges"), (F.sum(w) / 1000).alias("cable_length_um"), F.count(F.lit(1)).alias("n_center_samples"),
        *[share(F.col("error") <= t).alias(f"cable_fit_fraction_{t}nm") for t in thresholds],
    )
    s = back.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_surface_samples"),
        *[F.avg((F.col("error") <= t).cast("double")).alias(f"surface_fit_fraction_{t}nm") for t in thresholds],
    )
    tie = ["edge_row", "k"]
    wq = lambda value, probs: weighted_quantiles(center, key, value, "weight", probs, tie, rows)
    parts = [
        wq("error", {f"center_shell_error_p{p}_nm": p / 100 for p in (50, 90, 95)}),
        wq("center_dist", {"center_to_surface_p50_nm": 0.5}),
        wq("excess", {"center_excess_p90_nm": 0.9}),
        ordering.quantiles(back, key, "error", {f"surface_shell_error_p{p}_nm": p / 100 for p in (50, 90, 95)}, rows),
        ordering.quantiles(back, key, "excess", {"surface_excess_p90_nm": 0.9}, rows),
        overlap(samples, faces).select("neuron", "center_in_mesh_aabb_fraction"),
    ]
    out = sizes.join(c, key).join(s, key)
    for part in parts:
        out = out.join(part, key)
    out = out.withColumns({"scope": F.lit("all"), "center_distance_method": F.lit("triangle" if exact else "nearest_vertex")})
    for t in thresholds:
        f1 = match_f1(F.col(f"cable_fit_fraction_{t}nm"), F.col(f"surface_fit_fraction_{t}nm"))
        out = out.withColumns({f"bidirectional_f1_{t}nm": f1, f"match_score_{t}nm": 100 * f1})
    return out


def edge_diagnostics(center: DataFrame, back: DataFrame, rows: int | None = None) -> DataFrame:
    """Per edge: weighted centre statistics and those of the surface points assigned to it."""
    key, w = ["neuron", "child_id"], F.col("weight")
    avg = lambda e: F.sum(w * e) / F.sum(w)
    c = center.groupBy(*key, "parent_id", "length_nm", "n_samples", "soma_edge").agg(
        avg(F.col("error")).alias("center_shell_error_mean_nm"), avg(F.col("excess")).alias("center_excess_mean_nm"),
        avg((F.col("error") <= 500).cast("double")).alias("center_fit_fraction_500nm"),
    )
    c90 = weighted_quantiles(center, key, "error", "weight", {"center_shell_error_p90_nm": 0.9}, ["edge_row", "k"], rows)
    s = back.groupBy(*key).agg(
        F.count(F.lit(1)).alias("surface_points_assigned"), F.avg("error").alias("surface_shell_error_mean_nm"),
        F.avg((F.col("error") <= 500).cast("double")).alias("surface_fit_fraction_500nm"),
    )
    s90 = ordering.quantiles(back, key, "error", {"surface_shell_error_p90_nm": 0.9}, rows)
    out = c.join(c90, key, "left").join(s.join(s90, key), key, "left")
    return out.orderBy(F.desc_nulls_last("center_shell_error_p90_nm"), F.desc_nulls_last("surface_shell_error_p90_nm"))
