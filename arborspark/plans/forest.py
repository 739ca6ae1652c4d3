"""Skeleton inputs derived from the provided tables.

The provided tables hold no skeletons, so a deterministic forest and a synapse
set are derived from ``lineitem`` and ``orders``; the SQL twins that the oracle
engine runs are in ``oracles``.  Each derived table is landed once per
application and folder, the way parsed skeleton files would be, so every query
starts from a columnar node table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborspark.operators import ordering
from arborspark.schema import NEUROPIL_ORDER
from arborspark.session import land, size_by_rows

_LANDED: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def once(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    size_by_rows(spark)
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _LANDED:
        _LANDED[key] = land(build(), name)
    return _LANDED[key]


def _forest(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    numbered = ordering.row_number(
        lines.select(
            F.col("l_suppkey").alias("neuron"), "l_orderkey", "l_linenumber", "l_partkey",
            "l_extendedprice", "l_quantity", "l_tax",
        ),
        ["neuron"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_tax"],
        "id",
        rows=lines.count(),
    )
    i, n = F.col("id"), F.col("neuron")
    parent = (
        F.when(i == 1, F.lit(-1))
        .when(i % 7 == 0, 1 + (i * 7919 + n * 31) % (i - 1))
        .otherwise(i - 1)
    )
    kind = (
        F.when((i == 1) & (n % 4 != 0), 1).when(i % 7 == 3, 0).when(i % 7 == 5, 5).otherwise(6)
    )
    return numbered.select(
        "neuron",
        i.cast("bigint").alias("id"),
        i.cast("bigint").alias("row_idx"),
        kind.cast("int").alias("type"),
        (F.col("l_quantity") * 1000.0).alias("x"),
        F.col("l_extendedprice").alias("y"),
        ((F.col("l_partkey") % 997).cast("double") * 100.0).alias("z"),
        (F.lit(10.0) + F.col("l_tax") * 1000.0).alias("radius"),
        parent.cast("bigint").alias("parent"),
    )


def forest(spark: SparkSession, folder: str) -> DataFrame:
    """Node table: neuron, id, row_idx, type, x, y, z, radius, parent (nm)."""
    return once(spark, folder, "forest", lambda: _forest(spark, folder))


def typed_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The forest with synapse-derived node types 2, 3 and 4 outside the somas."""
    kind = F.when(F.col("type") == 1, 1).otherwise(2 + (F.col("id") * 31 + F.col("neuron")) % 3)
    return forest(spark, folder).withColumn("type", kind.cast("int"))


def tangled_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The forest with more Type-5 nodes of several children, to relink."""
    i, n = F.col("id"), F.col("neuron")
    parent = (
        F.when(i == 1, F.lit(-1))
        .when((i % 20 == 15) & (i > 15), i - 11)
        .when((i % 20 == 0) & (i > 20), i - 16)
        .when((i % 60 == 17) & (i > 17), i - 13)
        .otherwise(i - 1)
    )
    kind = (
        F.when((i == 1) & (n % 4 != 0), 1)
        .when(i % 5 == 4, 5)
        .when((i % 10 == 8) | (n % 10 == 7), 6)
        .otherwise(0)
    )
    walk = lambda c, a, b: (F.col(c) / 40.0 + i * F.lit(a) - F.floor(i / 50) * F.lit(b))
    return forest(spark, folder).select(
        "neuron", "id", "row_idx", kind.cast("int").alias("type"),
        walk("x", 300.0, 9000.0).alias("x"), walk("y", 200.0, 4000.0).alias("y"), walk("z", 100.0, 2500.0).alias("z"),
        "radius", parent.cast("bigint").alias("parent"),
    )


def looped_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The forest with loops: in every fifth neuron the root hangs under node 40, node 90
    starts a tree of its own, and node 130 is its own parent."""
    i, n = F.col("id"), F.col("neuron")
    odd = n % 5 == 2
    parent = F.when(odd & (i == 1), 40).when(odd & (i == 90), -1).when(odd & (i == 130), i).otherwise(F.col("parent"))
    return forest(spark, folder).withColumn("parent", parent.cast("bigint"))


def soma_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The forest redrawn around a soma, to exercise soma pruning: nodes 2-14 are
    thick, four thin stubs of six nodes leave them, and node 39 starts the trunk.

    By ``neuron % 7``: 0 has no soma, 4 a huge one, 5 one that is not the root,
    and in 2 one stub runs far away.
    """
    i, m = F.col("id"), F.col("neuron") % 7
    stub = F.floor((i - 15) / 6)
    parent = (
        F.when(i == 1, F.lit(-1))
        .when((i >= 15) & (i <= 38) & ((i - 15) % 6 == 0), 4 + 2 * stub)
        .when(i == 39, F.lit(3))
        .when((i > 80) & (i % 40 == 0), i - 30)
        .otherwise(i - 1)
    )
    soma_at = F.when(m == 0, 0).when(m == 5, 2).otherwise(1)
    thick = F.when(i <= 14, F.when(m == 4, F.lit(9000.0)).otherwise(F.lit(300.0))).otherwise(F.lit(50.0)) + F.col("radius")
    along = F.when(i > 38, (i - 38) * 300.0).otherwise(i * 20.0)
    away = F.when((i >= 15) & (i <= 20) & (m == 2), (i - 14) * 9000.0).otherwise(0.0)
    return forest(spark, folder).select(
        "neuron", "id", "row_idx",
        F.when(i == soma_at, 1).when(i % 5 == 4, 5).otherwise(0).cast("int").alias("type"),
        (F.col("x") / 100.0 + along).alias("x"), (F.col("y") / 200.0 + away).alias("y"), (F.col("z") / 200.0).alias("z"),
        thick.alias("radius"), parent.cast("bigint").alias("parent"),
    )


def synapses(spark: SparkSession, folder: str) -> DataFrame:
    """Synapse points: neuron, syn_id, syn_type, x, y, z (nm)."""

    def build() -> DataFrame:
        top = table(spark, folder, "lineitem").agg(F.max("l_suppkey")).first()[0]
        k = F.col("o_orderkey")
        return table(spark, folder, "orders").select(
            (F.col("o_custkey") % (1 + top)).alias("neuron"),
            k.alias("syn_id"),
            F.when(k % 3 == 0, "pre").otherwise("post").alias("syn_type"),
            ((k % 50).cast("double") * 1000.0).alias("x"),
            F.col("o_totalprice").alias("y"),
            ((F.col("o_custkey") % 997).cast("double") * 100.0).alias("z"),
        )

    return once(spark, folder, "synapses", build)


def soma_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """One trusted soma per supplier (voxel units); offsets grow with the balance,
    every fifth supplier is unlisted and every ninth coordinate is missing."""
    roots = forest(spark, folder).filter("id = 1").select("neuron", "x", "y", "z")
    s = table(spark, folder, "supplier").filter("s_suppkey % 5 <> 0").withColumnRenamed("s_suppkey", "neuron")
    off = (F.col("neuron") % 7).cast("double") * 100.0
    return s.join(roots, "neuron").select(
        F.col("neuron").alias("root_id"),
        (F.col("neuron") % 9).alias("nucleus_id"),
        F.when(F.col("neuron") % 9 != 0, (F.col("x") + off * 5) / 4.0).alias("soma_x"),
        (F.col("y") / 4.0).alias("soma_y"),
        ((F.col("z") - off) / 40.0).alias("soma_z"),
    )


def region_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """One axis-aligned region box (micrometres) per nation, partly overlapping."""
    k = F.col("n_nationkey")
    names = F.array(*[F.lit(n) for n in NEUROPIL_ORDER])
    a, b = k % 5, F.floor(k / 5)
    return table(spark, folder, "nation").select(
        F.concat(
            F.element_at(names, (F.floor(k / 2) * 3 + 1).cast("int")),
            F.when(k % 2 == 0, "_L").otherwise("_R"),
        ).alias("region"),
        (a * 10.0 + 0.25).alias("lo_x"), (a * 10.0 + 11.25).alias("hi_x"),
        (b * 20.0 + 0.5).alias("lo_y"), (b * 20.0 + 21.5).alias("hi_y"),
        F.lit(0.05).alias("lo_z"), F.lit(70.05).alias("hi_z"),
    )


def box_mesh(boxes: DataFrame, key: str) -> DataFrame:
    """The twelve triangles of every box as a face table."""
    corner = lambda i: [F.col(("hi_" if i >> axis & 1 else "lo_") + c) for axis, c in enumerate("xyz")]
    # Two triangles per box side, corners numbered by bit (x=1, y=2, z=4).
    sides = [(0, 2, 6), (0, 6, 4), (1, 5, 7), (1, 7, 3), (0, 4, 5), (0, 5, 1),
             (2, 3, 7), (2, 7, 6), (0, 1, 3), (0, 3, 2), (4, 6, 7), (4, 7, 5)]
    faces = [
        F.struct(
            F.lit(f).cast("bigint").alias("face_id"),
            *[value.alias(f"{name}{c}") for name, i in zip("uvw", side) for c, value in zip("xyz", corner(i))],
        )
        for f, side in enumerate(sides)
    ]
    return boxes.select(key, F.inline(F.array(*faces)))


def neuron_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Bounding box of every neuron in the forest (nm), as its surface."""
    return forest(spark, folder).groupBy("neuron").agg(
        *[f(c).alias(f"{side}_{c}") for c in "xyz" for f, side in ((F.min, "lo"), (F.max, "hi"))]
    )


def box_lattice(boxes: DataFrame, steps: int = 4) -> DataFrame:
    """(steps x steps) points on every box side, numbered within the box."""
    i = F.explode(F.sequence(F.lit(0), F.lit(6 * steps * steps - 1))).alias("i")
    p = boxes.select("*", i)
    side = F.floor(F.col("i") / (steps * steps))
    a = (F.floor(F.col("i") / steps) % steps + 0.5) / steps
    b = (F.col("i") % steps + 0.5) / steps
    along = {c: lambda t, c=c: F.col(f"lo_{c}") + t * (F.col(f"hi_{c}") - F.col(f"lo_{c}")) for c in "xyz"}
    fixed = lambda c: F.when(side % 2 == 0, F.col(f"lo_{c}")).otherwise(F.col(f"hi_{c}"))
    axis = F.floor(side / 2)
    return p.select(
        "neuron", F.col("i").cast("bigint").alias("point_id"),
        F.when(axis == 0, fixed("x")).otherwise(along["x"](a)).alias("px"),
        F.when(axis == 1, fixed("y")).when(axis == 0, along["y"](a)).otherwise(along["y"](b)).alias("py"),
        F.when(axis == 2, fixed("z")).otherwise(along["z"](b)).alias("pz"),
    )
