"""Exact k-nearest-neighbour join.

Keys of up to ``PACK`` items are packed into frames: probes and items are
shuffled once, by frame, and each key is searched inside one task over blocks
of neighbouring items.  The probes of a key are cut into slices of about
``PACK``, so a key of many probes spreads over frames.

Keys of more items take a pyramid of cells.  Items are summarised into cubic cells (count and tight bounding box) and the
cells into cells four times larger, up to eight per key.  Probes walk down the
pyramid level by level; at each level a probe keeps only the cells whose closest
possible distance does not exceed the farthest distance that already guarantees
``k`` items.  Every step is an equi-join on (key, cell), so one hot key spreads
over its cells, and no probe is ever paired with all items.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborspark.session import land

#: Items of a key that one task searches, and probes of a key in one slice.
PACK = 1 << 18
#: Probes and items of a frame, unless one key alone has more.
FRAME_ROWS = 1 << 16
BLOCK, PROBE_GROUP, BRUTE_ITEMS, CHUNK = 32, 32, 1024, 1 << 18

FACTOR = 4
LEAF_ITEMS, CROWDED_ITEMS, MAX_REFINEMENTS, MAX_DOUBLINGS = 8, 32, 8, 10
AXES = ("x", "y", "z")
CELL = ["_cx", "_cy", "_cz"]
BOX = [f"_{side}{a}" for a in AXES for side in ("lo", "hi")]


def _lower() -> Column:
    """Squared distance from the probe to the closest point of the cell's box."""
    gaps = [F.greatest(F.col(f"_lo{a}") - F.col(f"p{a}"), F.col(f"p{a}") - F.col(f"_hi{a}"), F.lit(0.0)) for a in AXES]
    return gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]


def _upper() -> Column:
    """Squared distance from the probe to the farthest point of the cell's box."""
    far = [F.greatest(F.abs(F.col(f"p{a}") - F.col(f"_lo{a}")), F.abs(F.col(f"p{a}") - F.col(f"_hi{a}"))) for a in AXES]
    return far[0] * far[0] + far[1] * far[1] + far[2] * far[2]


def _coarser(level: DataFrame, keys: list[str], factor: int) -> DataFrame:
    up = [F.floor(F.col(c) / factor).alias(c) for c in CELL]
    return level.groupBy(*keys, *up).agg(
        F.sum("_n").alias("_n"), *[(F.min if b.startswith("_lo") else F.max)(b).alias(b) for b in BOX]
    )


def _cells(items: DataFrame, keys: list[str], size: float, lo: Sequence[str], hi: Sequence[str]) -> DataFrame:
    placed = items.withColumns(_cell_of(size, lo))
    return land(
        placed.groupBy(*keys, *CELL).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.min(c).alias(f"_lo{a}") for a, c in zip(AXES, lo)],
            *[F.max(c).alias(f"_hi{a}") for a, c in zip(AXES, hi)],
        ),
        "cells",
    )


def _cell_of(size: float, lo: Sequence[str]) -> dict[str, Column]:
    return {f"_c{a}": F.floor(F.col(c) / F.lit(size)) for a, c in zip(AXES, lo)}


def _fitted_leaves(items: DataFrame, keys: list[str], size: float, lo, hi) -> tuple[DataFrame, float]:
    """Cell table and cell size holding a few items per cell on average.

    Crowded cells are cut to a quarter until it no longer separates items;
    sparse ones are doubled, from the cell table alone.
    """
    level = _cells(items, keys, size, lo, hi)
    total, cells = level.agg(F.sum("_n"), F.count(F.lit(1))).first()
    for _ in range(MAX_REFINEMENTS):
        if not cells or total / cells <= CROWDED_ITEMS:
            break
        finer = _cells(items, keys, size / FACTOR, lo, hi)
        n = finer.count()
        if n < 1.5 * cells:
            break
        level, cells, size = finer, n, size / FACTOR
    factor = 1
    while cells and total / cells < LEAF_ITEMS and factor < 1 << MAX_DOUBLINGS:
        factor *= 2
        cells = level.select(*keys, *[F.floor(F.col(c) / factor).alias(c) for c in CELL]).distinct().count()
    return (_coarser(level, keys, factor), size * factor) if factor > 1 else (level, size)


def point_distance2() -> Column:
    d = [F.col(f"p{a}") - F.col(a) for a in AXES]
    return d[0] * d[0] + d[1] * d[1] + d[2] * d[2]


# ------------------------------------------------------------- within a task

def _squared(p: np.ndarray, c: dict[str, np.ndarray], lo: Sequence[str]) -> np.ndarray:
    d = [p[:, i : i + 1] - c[a] for i, a in enumerate(lo)]
    return d[0] * d[0] + d[1] * d[1] + d[2] * d[2]


def _spatial_order(at: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order along a Z curve of 1024 steps an axis."""
    step = np.nan_to_num((at - low) / size * 1023, nan=0.0, posinf=1023, neginf=0).clip(0, 1023).astype(np.int64)
    code = np.zeros(len(at), dtype=np.int64)
    for bit in range(10):
        for axis in range(3):
            code |= (step[:, axis] >> bit & 1) << (3 * bit + axis)
    return np.argsort(code, kind="stable")


def _closest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest values of every row, in order; the first column wins ties, NaN comes last."""
    worth = np.where(np.isnan(d), np.inf, d)
    if k == 1:
        return np.arange(len(d)), worth.argmin(axis=1)
    rows, cols = np.nonzero(worth <= np.partition(worth, k - 1, axis=1)[:, k - 1 : k])
    order = np.lexsort((cols, worth[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], cols[keep]


def _search(p: np.ndarray, low: np.ndarray, high: np.ndarray, distance2, k: int):
    """(probe, item, squared distance) of the ``k`` closest of the items, which are in tie order, for every probe."""
    k, m = min(k, len(low)), len(low)
    found = []

    def take(rows: np.ndarray, items: np.ndarray | None) -> None:
        step = max(1, CHUNK // (m if items is None else len(items)))
        for s in range(0, len(rows), step):
            part = rows[s : s + step]
            d = distance2(p[part], items)
            i, j = _closest(d, k)
            found.append((part[i], j if items is None else items[j], d[i, j]))

    sound = np.isfinite(p).all(axis=1)
    if m <= BRUTE_ITEMS or not sound.any():
        take(np.arange(len(p)), None)
    else:
        take(np.flatnonzero(~sound), None)
        corner = np.nan_to_num(low, nan=0.0, posinf=0.0, neginf=0.0).min(axis=0)
        size = np.maximum(np.nan_to_num(high, nan=0.0, posinf=0.0, neginf=0.0).max(axis=0) - corner, 1e-300)
        order = _spatial_order((low + high) / 2, corner, size)
        starts = np.arange(0, m, BLOCK)
        sizes = np.diff(np.append(starts, m))
        b_low, b_high = np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts)
        first = min(len(starts) - 1, 1 + -(-k // BLOCK))
        rows = np.flatnonzero(sound)
        base = p[rows].min(axis=0)
        rows = rows[_spatial_order(p[rows], base, np.maximum(p[rows].max(axis=0) - base, 1e-300))]
        for s in range(0, len(rows), PROBE_GROUP):
            part = rows[s : s + PROBE_GROUP]
            q = p[part]
            least = np.zeros((len(q), len(starts)))
            for x in range(3):
                at = q[:, x : x + 1]
                gap = np.maximum(np.maximum(b_low[:, x] - at, at - b_high[:, x]), 0.0)
                least += np.nan_to_num(gap * gap, nan=0.0, posinf=np.inf)
            # the closest blocks of every probe tell how far it has to look
            near = np.zeros(len(starts), dtype=bool)
            near[np.argpartition(least, first, axis=1)[:, : first + 1].ravel()] = True
            d = distance2(q, order[np.repeat(near, sizes)])
            bound = np.partition(np.where(np.isnan(d), np.inf, d), k - 1, axis=1)[:, k - 1 : k]
            near |= (least <= bound * (1 + 1e-9) + 1e-12).any(axis=0)
            take(part, np.sort(order[np.repeat(near, sizes)]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _flat(table: pa.Table, name: str) -> list[pa.ChunkedArray]:
    """A column, or the fields of a struct column down to plain values."""
    if not pa.types.is_struct(table.schema.field(name).type):
        return [table[name]]
    inner = pa.table(table[name].combine_chunks().flatten(), names=[str(i) for i in range(table.schema.field(name).type.num_fields)])
    return [c for n in inner.column_names for c in _flat(inner, n)]


def codes(left: pa.Table, right: pa.Table, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """One number per combination of key values, for both tables."""
    code = np.zeros(left.num_rows + right.num_rows, dtype=np.int64)
    for name in names:
        both = pa.chunked_array([*left[name].chunks, *right[name].chunks]).combine_chunks().dictionary_encode()
        code = np.unique(code * (len(both.dictionary) + 1) + both.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return code[: left.num_rows], code[left.num_rows :]


def _packed(probes: DataFrame, items: DataFrame, keys: list[str], k: int, lo, hi, measure, fields: Sequence[str], tie: str, carry, keep) -> DataFrame:
    """Nearest items of keys whose items fit a task; both sides have ``_frame`` and ``_slice``."""
    group = [*keys, "_slice"]
    sent = list(dict.fromkeys([*group, "pid", "px", "py", "pz", *keep]))
    held = list(dict.fromkeys([*group, tie, *carry, *lo, *hi, *fields]))
    kind = lambda df, names: [T.StructField(c, df.schema[c].dataType) for c in names]
    shape = T.StructType([*kind(probes, [*keys, "pid", *keep]), *kind(items, [tie, *carry]), T.StructField("_d2", T.DoubleType()), T.StructField("nth", T.IntegerType())])

    def seek(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, cols, far = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if left.num_rows and right.num_rows:
            parts = _flat(right, tie)
            ranks = pa.table(parts, names=[str(i) for i in range(len(parts))])
            right = right.take(pc.sort_indices(ranks, sort_keys=[(n, "ascending") for n in ranks.column_names], null_placement="at_start"))
            ours, theirs = codes(left, right, group)
            by_probe, by_item = np.argsort(ours, kind="stable"), np.argsort(theirs, kind="stable")
            ours, theirs = ours[by_probe], theirs[by_item]
            value = lambda table, c: table[c].to_numpy().astype(float)
            p = np.stack([value(left, f"p{a}") for a in AXES], axis=1)[by_probe]
            c = {name: value(right, name)[by_item] for name in dict.fromkeys([*lo, *hi, *fields])}
            low, high = (np.stack([c[n] for n in side], axis=1) for side in (lo, hi))
            both = np.intersect1d(ours, theirs)
            spans = (np.searchsorted(a, both, side) for a in (ours, theirs) for side in ("left", "right"))
            for a, b, u, v in zip(*spans):
                own = {name: x[u:v] for name, x in c.items()}
                look = lambda q, at, own=own: measure(q, own if at is None else {n: own[n][at] for n in (fields or lo)})
                i, j, d = _search(p[a:b], low[u:v], high[u:v], look, k)
                rows.append(by_probe[a + i])
                cols.append(by_item[u + j])
                far.append(d)
        i, j, d = np.concatenate(rows), np.concatenate(cols), np.concatenate(far)
        # the places of a probe follow each other in order
        starts = np.flatnonzero(np.diff(i, prepend=-1) != 0)
        nth = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i)))) + 1
        if not len(i):
            return shape_arrow.empty_table()
        mine, other = left.take(pa.array(i)), right.take(pa.array(j))
        columns = [*[mine[c] for c in (*keys, "pid", *keep)], *[other[c] for c in (tie, *carry)], pa.array(d), pa.array(nth.astype(np.int32))]
        return pa.table(columns, names=shape.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    shape_arrow = to_arrow_schema(shape)
    # both sides may stem from one table: columns of their own tell them apart
    side = lambda df, names: df.select(*[F.col(c).alias(c) for c in ("_frame", *names)]).groupBy("_frame")
    met = side(probes, sent).cogroup(side(items, held)).applyInArrow(seek, shape)
    return met.select(*keys, "pid", *keep, tie, *carry, F.sqrt("_d2").alias("distance"), "nth")


# ------------------------------------------------------------------ the join

def nearest(
    probes: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    k: int = 1,
    cell: float = 4.0,
    lo: Sequence[str] = AXES,
    hi: Sequence[str] = AXES,
    distance2: Column | None = None,
    tie: str = "row_idx",
    carry: Sequence[str] = (),
    measure: Callable | None = None,
    fields: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` closest items of the same key for every probe.

    ``probes`` carries the keys, a unique ``pid`` and ``px, py, pz``; ``items``
    carries the keys, the tie-breaking column and either points or boxes
    (``lo``/``hi`` columns).  Returns keys, pid, the tie column, the item columns
    in ``carry``, the probe columns in ``keep``, ``distance`` and ``nth`` (1..k).
    Probes whose key has no items are absent.  ``distance2`` names another
    squared distance than that of points; ``measure`` is the same over arrays: of
    (n, 3) probe places and a mapping of the item columns ``fields``.
    """
    keys, lo, hi = list(keys), list(lo), list(hi)
    if distance2 is None:
        measure, fields = lambda p, c: _squared(p, c, lo), lo
    probes, items = probes.dropna(subset=[*keys, "px", "py", "pz"]), items.dropna(subset=[*keys, *lo, *hi])
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    sizes = land(count(items, "_items").join(count(probes, "_probes"), keys), "sizes")
    total, most, asked = sizes.agg(F.sum(F.col("_items") + F.col("_probes")), F.max("_items"), F.max("_probes")).first()
    frames = -(-(total or 1) // FRAME_ROWS)
    large = None
    if (most or 0) > PACK:
        large = sizes.filter(F.col("_items") > PACK).select(*keys)
    slices = F.lit(1)
    packed, sought = items, probes
    if large is not None:
        packed, sought = items.join(large, keys, "left_anti"), probes.join(large, keys, "left_anti")
    if (asked or 0) > PACK:
        # keys of many probes: at most one for every PACK probes
        cut = sizes.filter(F.col("_probes") > PACK).select(*keys, F.ceil(F.col("_probes") / PACK).cast("int").alias("_slices"))
        slices = F.coalesce("_slices", F.lit(1))
        packed, sought = packed.join(cut, keys, "left"), sought.join(cut, keys, "left")
    packed = packed.withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    sought = sought.withColumn("_slice", F.pmod(F.xxhash64("pid"), slices).cast("int"))
    frame = F.pmod(F.xxhash64(*keys, "_slice"), F.lit(frames))
    out = _packed(sought.withColumn("_frame", frame), packed.withColumn("_frame", frame), keys, k, lo, hi, measure, fields, tie, carry, keep)
    if large is None:
        return out
    rest = _pyramid(probes.join(large, keys, "left_semi"), items.join(large, keys, "left_semi"), keys, k, cell, lo, hi, distance2, tie, carry)
    if keep:
        rest = rest.join(probes.select(*keys, "pid", *keep), [*keys, "pid"])
    return out.unionByName(rest)


def _pyramid(probes, items, keys: list[str], k: int, cell: float, lo, hi, distance2: Column | None, tie: str, carry) -> DataFrame:
    by_point = distance2 is None
    distance2 = point_distance2() if by_point else distance2
    level, size = _fitted_leaves(items, keys, cell, lo, hi)
    placed = items.withColumns(_cell_of(size, lo))
    # widest extent of any single key, in cells
    extent = level.groupBy(*keys).agg(*[(F.max(c) - F.min(c)).alias(c) for c in CELL])
    spans = extent.agg(*[F.max(c) for c in CELL]).first()
    width = max(s or 0 for s in spans) + 1
    pyramid = [level]
    while width > 2:
        level = _coarser(level, keys, FACTOR)
        pyramid.append(level)
        width = -(-width // FACTOR) + 1 if width > FACTOR else 2

    probe = [*keys, "pid", "px", "py", "pz"]
    # at most two cells per axis are left at the top
    front = probes.select(*probe).join(pyramid[-1], keys)
    per_probe = Window.partitionBy(*keys, "pid")
    for depth in range(len(pyramid) - 1, -1, -1):
        front = front.withColumns({"_lb": _lower(), "_ub": _upper()})
        if k == 1:
            bound = F.min("_ub").over(per_probe)
        else:
            near_first = per_probe.orderBy("_ub").rowsBetween(Window.unboundedPreceding, 0)
            front = front.withColumn("_have", F.sum("_n").over(near_first))
            bound = F.coalesce(F.min(F.when(F.col("_have") >= k, F.col("_ub"))).over(per_probe), F.lit(float("inf")))
        front = front.withColumn("_bound", bound * (1 + 1e-9) + 1e-12).filter(F.col("_lb") <= F.col("_bound"))
        front = front.select(*probe, *CELL, *([] if depth else ["_bound"]))
        if depth:
            finer = pyramid[depth - 1].select(
                *keys, *[F.col(c).alias(f"{c}f") for c in CELL], *[F.floor(F.col(c) / FACTOR).alias(c) for c in CELL], "_n", *BOX
            )
            front = front.join(finer, [*keys, *CELL]).drop(*CELL).withColumnsRenamed({f"{c}f": c for c in CELL})
    met = front.join(placed, [*keys, *CELL]).withColumn("_d2", distance2)
    if by_point:
        # only items within the guaranteed distance can be among the k closest; a
        # long distance expression would be evaluated twice by this filter
        met = met.filter(F.col("_d2") <= F.col("_bound"))
    met = met.select(*keys, "pid", F.struct("_d2", tie, *carry).alias("_m"))
    if k == 1:
        best = met.groupBy(*keys, "pid").agg(F.min("_m").alias("_m")).withColumn("nth", F.lit(1))
    else:
        best = met.withColumn("nth", F.row_number().over(per_probe.orderBy("_m"))).filter(F.col("nth") <= k)
    return best.select(*keys, "pid", *[F.col(f"_m.{c}").alias(c) for c in (tie, *carry)], F.sqrt("_m._d2").alias("distance"), "nth")
