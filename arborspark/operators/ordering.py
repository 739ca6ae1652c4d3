"""Running sums, row numbers, quantiles and ranks that survive hot keys.

A window sorts one key's rows in one task.  When a key may hold a large share
of the table, its rows are first cut into value ranges: running values are
computed inside each range and shifted by the totals of the ranges before it.
Hot keys are those above ``max(HOT_ROWS, total/1000)`` rows, so there are never
more than 1000 of them and their split points fit a small broadcast table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborspark.session import land

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1000
SPLITS = 256


def _hot_splits(df: DataFrame, keys: Sequence[str], lead: str, rows: int | None) -> DataFrame | None:
    """Split points of the hot keys as a literal table, or None without hot keys."""
    if rows is not None and rows <= HOT_ROWS:
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    floor = max(HOT_ROWS, total // MAX_HOT_KEYS)
    hot = counts.filter(F.col("_n") > floor).drop("_n").collect()
    if not hot:
        return None
    spark = df.sparkSession
    if keys:
        fields = [f for f in df.schema.fields if f.name in keys]
        schema = type(df.schema)([f for k in keys for f in fields if f.name == k])
        listed = spark.createDataFrame(hot, schema)
        df = df.join(F.broadcast(listed), list(keys), "left_semi")
    grid = [i / SPLITS for i in range(1, SPLITS)]
    cuts = df.groupBy(*keys).agg(F.percentile_approx(lead, grid, 10000).alias("_cuts"))
    return spark.createDataFrame(cuts.collect(), cuts.schema)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    rows: int | None = None,
) -> DataFrame:
    """Add inclusive running sums per key in ``order`` (leading column numeric).

    ``rows`` is an upper bound of the row count known to the caller; when it is
    small no key can be hot and one plain window is used.
    """
    keys = list(keys)
    cuts = _hot_splits(df, keys, order[0], rows)
    if cuts is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(e).over(w).alias(n) for n, e in sums.items()])
    lead = F.col(order[0])
    if keys:
        df = df.join(F.broadcast(cuts), keys, "left")
    else:
        df = df.crossJoin(F.broadcast(cuts))  # one row
    df = df.withColumn(
        "_band", F.coalesce(F.size(F.filter("_cuts", lambda c: c < lead)), F.lit(0))
    ).withColumn("_hot", F.col("_cuts").isNotNull()).drop("_cuts")
    banded = [*keys, "_band"]
    # only hot keys have more than one band: at most MAX_HOT_KEYS * SPLITS rows
    per_band = df.filter("_hot").groupBy(*banded).agg(*[F.sum(e).alias(f"_o_{n}") for n, e in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_band.select(*banded, *[F.sum(f"_o_{n}").over(before).alias(f"_o_{n}") for n in sums])
    w = Window.partitionBy(*banded).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.select("*", *[F.sum(e).over(w).alias(n) for n, e in sums.items()])
    out = out.join(F.broadcast(offsets), banded, "left")
    keep = [c for c in df.columns if c not in ("_band", "_hot")]
    return out.select(
        *keep, *[(F.col(n) + F.coalesce(F.col(f"_o_{n}"), F.lit(0))).alias(n) for n in sums]
    )


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums per key in ``order``, whatever the size of a key.

    Rows are range-partitioned by key and order, so a key of any size spreads
    over partitions; sums run inside (partition, key) and are shifted by the
    totals of the key's earlier partitions, a table of about one row per
    partition and key.  ``keys`` must not be null and (keys, order) should tell
    all rows apart, else equal rows stay together.  The cut is landed, because
    its bounds are drawn from a sample.
    """
    keys = list(keys)
    cut = df.select("*", *[e.alias(f"_v_{n}") for n, e in sums.items()])
    cut = land(cut.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "cut")
    cell = ["_part", *keys]
    w = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = cut.select(*df.columns, "_part", *[F.sum(f"_v_{n}").over(w).alias(f"_s_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*cell).agg(*[F.sum(f"_v_{n}").alias(f"_v_{n}") for n in sums])
    offsets = totals.select(*cell, *[F.coalesce(F.sum(f"_v_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    return inner.join(offsets, cell).select(*df.columns, *[(F.col(f"_s_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums])


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows: int | None = None) -> DataFrame:
    return running(df, keys, order, {name: F.lit(1).cast("bigint")}, rows)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Finite values with multiplicity: at most one row per key and value."""
    v = F.col(value)
    ok = v.isNotNull() & ~F.isnan(v.cast("double"))
    return df.filter(ok).groupBy(*keys, v.alias(value)).agg(F.count(F.lit(1)).alias("_c"))


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    rows: int | None = None,
    builtin: bool = True,
) -> DataFrame:
    """Exact linearly interpolated quantiles per key.

    With a small known row bound the built-in aggregate is used (it keeps every
    distinct value of a key in one buffer); otherwise ranks come from running
    counts.  ``builtin=False`` asks for the latter at any size.
    """
    keys = list(keys)
    if builtin and rows is not None and rows <= HOT_ROWS:
        v = F.col(value).cast("double")
        grid = F.percentile(F.when(~F.isnan(v), v), F.array(*[F.lit(float(p)) for p in probs.values()]))
        out = df.groupBy(*keys).agg(grid.alias("_q"))
        return out.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)])
    counted = value_counts(df, keys, value)
    ranked = running(counted, keys, [value], {"_cum": F.col("_c")}, rows)
    sizes = counted.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    ranked = ranked.join(sizes, keys) if keys else ranked.crossJoin(F.broadcast(sizes))
    v = F.col(value).cast("double")
    picks = []
    for name, p in probs.items():
        at = F.round((F.col("_n") - 1) * F.lit(float(p)), 9)
        lo, hi = F.floor(at), F.least(F.floor(at) + 1, F.col("_n") - 1)
        holds = lambda r: (r >= F.col("_cum") - F.col("_c")) & (r < F.col("_cum"))
        picks += [
            F.max(F.when(holds(lo), v)).alias(f"_lo_{name}"),
            F.max(F.when(holds(hi), v)).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_f_{name}"),
        ]
    out = ranked.groupBy(*keys).agg(*picks)
    return out.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n)
            for n in probs
        ],
    )


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, rows: int | None = None) -> DataFrame:
    """Average rank (ties share the mean) of every distinct value per key, with its count."""
    counted = value_counts(df, keys, value)
    ranked = running(counted, keys, [value], {"_cum": F.col("_c")}, rows)
    return ranked.select(
        *keys, value, F.col("_c").alias("ties"), (F.col("_cum") - (F.col("_c") - 1) / 2).alias("rank")
    )
