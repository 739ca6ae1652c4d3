"""Edges, child counts and tree traversal.

A traversal never gathers a whole neuron.  Rows are cut into runs of
``CHUNK_ROWS`` file rows, and a directory packs the runs into frames by their
row counts, so the number of frames follows the data: small neurons share one,
a huge neuron spreads over many.  In each frame NumPy pointer doubling links
every node to the top-most ancestor of its run and, in the same pass, gathers
sums and maxima over subtrees.  The tops of runs that hang under another run
form a much smaller forest, closed by joins on ``(neuron, node)`` in log2(depth)
rounds, each landed in the workspace; it is empty if every neuron is one run.

A pointer that is still open after log2(n) doublings lies on or below a loop:
such rows are marked ``looped`` and get no path and no totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborspark.operators import ordering
from arborspark.session import land, shuffle_width, size_by_rows

CHUNK_ROWS = 1 << 16
RACK_FRAMES = 64
FEW_ROWS = 1 << 12
KEY = ["neuron", "id"]


# ---------------------------------------------------------------- relational

def child_counts(nodes: DataFrame) -> DataFrame:
    """Every node with its number of children (rows naming it as parent)."""
    per_parent = (
        nodes.filter(F.col("parent") != -1)
        .groupBy("neuron", F.col("parent").alias("id"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    return nodes.join(per_parent, KEY, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))
    )


def edges(nodes: DataFrame, scale: float = 1.0, carry: Sequence[str] = ()) -> DataFrame:
    """Child rows joined to their parent rows; rows with a missing parent drop out."""
    up = nodes.select(
        "neuron",
        F.col("id").alias("parent"),
        *[F.col(c).alias(f"p_{c}") for c in dict.fromkeys(["x", "y", "z", *carry])],
    )
    joined = nodes.filter(F.col("parent") != -1).join(up, ["neuron", "parent"])
    squares = [F.pow((F.col(a) - F.col(f"p_{a}")) / F.lit(scale), 2) for a in "xyz"]
    return joined.withColumn("length", F.sqrt(squares[0] + squares[1] + squares[2]))


def with_edge_length(nodes: DataFrame, scale: float = 1.0) -> DataFrame:
    """All nodes plus the length of the edge to their parent (0 where there is none)."""
    up = nodes.select("neuron", F.col("id").alias("parent"), *[F.col(c).alias(f"p_{c}") for c in "xyz"])
    joined = nodes.join(up, ["neuron", "parent"], "left")
    squares = [F.pow((F.col(a) - F.col(f"p_{a}")) / F.lit(scale), 2) for a in "xyz"]
    return joined.withColumn(
        "edge_length", F.coalesce(F.sqrt(squares[0] + squares[1] + squares[2]), F.lit(0.0))
    ).select(*nodes.columns, "edge_length")


# ------------------------------------------------------------ in-batch passes

def _parent_rows(neuron: pd.Series, ids: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Row position of each row's parent inside the batch, -1 when absent."""
    group = pd.factorize(neuron)[0].astype(np.int64)
    known, slot = np.unique(ids, return_inverse=True)
    at = np.searchsorted(known, parent)
    at[at == len(known)] = 0
    named = known[at] == parent
    keys = group * len(known) + slot
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    wanted = group * len(known) + at
    pos = np.searchsorted(sorted_keys, wanted)
    pos[pos == len(keys)] = 0
    return np.where(named & (sorted_keys[pos] == wanted), order[pos], -1)


def _climb(up: np.ndarray, weights: list[np.ndarray]):
    """Doubling towards the top: (top row, sums along the path, cycle flag)."""
    n = len(up)
    jump = np.append(np.where(up < 0, n, up), n)
    top = np.arange(n + 1)
    sums = [np.append(w, w.dtype.type(0)) for w in weights]
    for _ in range(n.bit_length() + 1):
        live = jump != n
        if not live.any():
            break
        sums = [s + s[jump] for s in sums]
        top = np.where(live, top[jump], top)
        jump = jump[jump]
    return top[:n], [s[:n] for s in sums], jump[:n] != n


def _gather(up: np.ndarray, sums: list[np.ndarray], maxes: list[np.ndarray]):
    """Doubling towards the leaves: totals and maxima over each row's subtree."""
    n = len(up)
    jump = np.where(up < 0, n, up)
    sums, maxes = [s.astype(float) for s in sums], [m.astype(float).copy() for m in maxes]
    for _ in range(n.bit_length() + 1):
        live = jump != n
        if not live.any():
            break
        target = jump[live]
        sums = [s + np.bincount(target, s[live], n) for s in sums]
        grown = []
        for m in maxes:
            m2 = m.copy()
            np.maximum.at(m2, target, m[live])
            grown.append(m2)
        maxes = grown
        jump = np.where(live, np.append(jump, n)[jump], n)
    return sums, maxes


def _positions(neuron: np.ndarray, up: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Depth-first positions of whole neurons in file order, as in ``parent_first_order``; -1 where no root reaches."""
    n = len(up)
    _, _, looped = _climb(up, [])
    (size,), _ = _gather(up, [np.ones(n)], [])
    size = np.where(looped, 0, size).astype(np.int64)
    order = np.lexsort((parent, neuron))  # siblings, in file order
    upto = np.cumsum(size[order])
    opens = np.append(True, (neuron[order][1:] != neuron[order][:-1]) | (parent[order][1:] != parent[order][:-1]))[:n]
    before = (upto - size[order])[opens][np.cumsum(opens) - 1]
    offset = np.zeros(n, dtype=np.int64)
    offset[order] = upto - before - size[order] + 1
    top, (position,), looped = _climb(up, [offset])
    return np.where(looped | (parent[top] != -1), -1, position - 1)


# ------------------------------------------------------------------ plumbing

def frames(nodes: DataFrame, run_rows: int | None = None) -> DataFrame:
    """``nodes`` with ``_run`` (stretch of its file) and ``_frame``: runs packed up to ``CHUNK_ROWS`` rows.

    Runs have ``run_rows`` (``CHUNK_ROWS``) file rows; however short they are, a
    frame holds as many as fit, so the number of frames follows the rows alone.
    The directory has one row per run.  Runs are dealt over racks by hash, enough
    of them for about ``RACK_FRAMES`` frames each, and a running sum of row
    counts within a rack tells a run's frame.
    """
    size_by_rows(nodes.sparkSession)
    rows, frame = run_rows or CHUNK_ROWS, max(run_rows or 0, CHUNK_ROWS)
    run = F.floor(F.col("row_idx") / F.lit(rows)).cast("bigint").alias("_run")
    labelled = nodes.select("*", run)
    counted = labelled.groupBy("neuron", "_run").agg(F.count(F.lit(1)).alias("_rows"))
    racks = counted.agg(F.greatest(F.ceil(F.sum("_rows") / F.lit(RACK_FRAMES * frame)), F.lit(1)).alias("_racks"))
    counted = counted.crossJoin(F.broadcast(racks))  # one row
    rack = F.pmod(F.xxhash64("neuron", "_run"), F.col("_racks")).alias("_rack")
    before = Window.partitionBy("_rack").orderBy("neuron", "_run").rowsBetween(Window.unboundedPreceding, 0)
    place = F.floor((F.sum("_rows").over(before) - F.col("_rows") / 2) / F.lit(frame)).cast("bigint")
    directory = counted.select("*", rack).select("neuron", "_run", F.struct("_rack", place.alias("_place")).alias("_frame"))
    return labelled.join(directory, ["neuron", "_run"])


def whole_neurons(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows of neurons of up to ``CHUNK_ROWS`` rows with ``_frame``, rows of longer ones, None where there are none).

    Neurons are dealt over frames by hash, enough of them for ``CHUNK_ROWS`` rows each on average, so what needs a
    whole neuron takes one shuffle.  There is at most one longer neuron per ``CHUNK_ROWS`` rows.
    """
    size_by_rows(nodes.sparkSession)
    counted = land(nodes.groupBy("neuron").agg(F.count(F.lit(1)).alias("_rows")), "neurons")
    total, longest = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0))).first()
    n_frames = max(1, -(-total // CHUNK_ROWS), min(shuffle_width(nodes.sparkSession), total // FEW_ROWS))
    framed = nodes.withColumn("_frame", F.pmod(F.xxhash64("neuron"), F.lit(n_frames)))
    if longest <= CHUNK_ROWS:
        return framed, None
    longer = counted.filter(F.col("_rows") > CHUNK_ROWS).select("neuron")
    return framed.join(longer, "neuron", "left_anti"), nodes.join(longer, "neuron", "left_semi")


def split_neurons(nodes: DataFrame, sound: Column, most: int | None = None) -> tuple[DataFrame | None, DataFrame | None, Column]:
    """(rows of neurons that one task can hold, with ``_frame``; rows of all others; a neuron's frame), None for a side without neurons.

    A task holds neurons of up to ``most`` (``CHUNK_ROWS``) rows whose ids differ and whose rows are all ``sound``; as in
    ``whole_neurons`` they are dealt over frames by hash.  Rows without a neuron are left out.
    """
    size_by_rows(nodes.sparkSession)
    nodes = nodes.filter(F.col("neuron").isNotNull())
    fine = F.col("id").isNotNull() & F.col("row_idx").isNotNull() & F.col("parent").isNotNull() & F.coalesce(sound, F.lit(False))
    per_id = nodes.groupBy("neuron", "id").agg(F.count(F.lit(1)).alias("_n"), F.min(fine).alias("_fine"))
    held = (F.sum("_n") <= (most or CHUNK_ROWS)) & (F.max("_n") == 1) & F.min("_fine")
    counted = land(per_id.groupBy("neuron").agg(F.sum("_n").alias("_rows"), held.alias("_held")), "neurons")
    total, whole, rest = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count_if("_held"), F.count_if(~F.col("_held"))).first()
    n_frames = max(1, -(-total // CHUNK_ROWS), min(shuffle_width(nodes.sparkSession), total // FEW_ROWS))
    frame = F.pmod(F.xxhash64("neuron"), F.lit(n_frames))
    framed = nodes.withColumn("_frame", frame)
    if not rest:
        return framed, None, frame
    if not whole:
        return None, nodes, frame
    pick = lambda df, flag: df.join(counted.filter(F.col("_held") == flag).select("neuron"), "neuron", "left_semi")
    return pick(framed, True), pick(nodes, False), frame


def finite_or_null(*columns: str) -> Column:
    """No NaN and no infinity in ``columns``; NumPy then reads a NaN as a null."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(True))
    return out


def _same_run(pdf: pd.DataFrame) -> pd.Series:
    """One label per (neuron, run) so that a frame never links across runs."""
    if pdf["_run"].eq(pdf["_run"].iat[0]).all():
        return pdf["neuron"]
    run, runs = pd.factorize(pdf["_run"])
    return pd.Series(pd.factorize(pdf["neuron"], use_na_sentinel=False)[0] * len(runs) + run)


def _ddl(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


# ----------------------------------------------------------------- traversal

def traverse(
    nodes: DataFrame, up: Mapping[str, Column] | None = None, carry: Mapping[str, Column] | None = None, stop: Column | None = None,
    sums: Mapping[str, Column] | None = None, maxes: Mapping[str, Column] | None = None, run_rows: int | None = None,
) -> DataFrame:
    """Paths to the top and subtree totals of every node, in one pass over the frames.

    Returns neuron, id, ``top`` (last node reached going up), ``hops`` to it, and
    by name: ``up`` totals over the path with both ends, ``carry`` values read at
    the top, ``sums`` and ``maxes`` over the node's subtree, the node included.
    The climb ends at a root, at a node whose parent is missing, or at a node
    where ``stop`` holds; subtrees don't end there.  Rows on or below a loop of
    parents (``looped``) have null in all of these but the ids; a row below a
    ``stop`` within a loop has a path, but no totals.
    """
    up, carry, sums, maxes = dict(up or {}), dict(carry or {}), dict(sums or {}), dict(maxes or {})
    below = [*sums, *maxes]
    halt = F.coalesce(stop, F.lit(False)) if stop is not None else F.lit(False)
    work = nodes.select(
        "neuron", "id", "row_idx", "parent", halt.alias("_halt"),
        *[e.cast("double").alias(f"u_{n}") for n, e in up.items()], *[e.cast("double").alias(f"t_{n}") for n, e in carry.items()],
        *[e.cast("double").alias(f"d_{n}") for n, e in [*sums.items(), *maxes.items()]],
    )
    labelled = frames(work, run_rows)
    kind = _ddl(work, "neuron")
    ups, tops, downs = [f"u_{n}" for n in up], [f"t_{n}" for n in carry], [f"d_{n}" for n in below]
    add, peak = downs[: len(sums)], downs[len(sums) :]

    def pass_frame(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_run", "row_idx"], kind="stable", ignore_index=True)
        ids, parent = pdf["id"].to_numpy(), pdf["parent"].to_numpy()
        over = np.where(parent == -1, -1, _parent_rows(_same_run(pdf), ids, parent))
        free = np.where(pdf["_halt"].to_numpy(dtype=bool), -1, over)
        top, (hops, *totals), looped = _climb(free, [(free >= 0).astype(np.int64), *[pdf[c].to_numpy() for c in ups]])
        link = np.where(pdf["_halt"].to_numpy(dtype=bool), -1, parent)[top]
        out = {"neuron": pdf["neuron"], "id": ids, "_run": pdf["_run"], "top": ids[top], "hops": hops, "link": link, "looped": looped}
        out.update(dict(zip(ups, totals)))
        out.update({c: pdf[c].to_numpy()[top] for c in tops})
        if downs:
            whole_top, _, whole_loop = (top, None, looped) if (free == over).all() else _climb(over, [])
            grown, peaks = _gather(over, [pdf[c].to_numpy() for c in add], [pdf[c].to_numpy() for c in peak])
            out.update({"root": ids[whole_top], "root_link": parent[whole_top], "ringed": whole_loop})
            out.update(dict(zip(downs, [*grown, *peaks])))
        return pd.DataFrame(out)

    numbers = "".join(f", {c} double" for c in [*ups, *tops])
    below_ddl = ", root bigint, root_link bigint, ringed boolean" + "".join(f", {c} double" for c in downs) if downs else ""
    schema = f"neuron {kind}, id bigint, _run bigint, top bigint, hops bigint, link bigint, looped boolean{numbers}{below_ddl}"
    local = land(labelled.groupBy("_frame").applyInPandas(pass_frame, schema), "frames")
    paths = _close_paths(local, ["hops", *ups], ["top", *tops])
    if downs:
        paths = _close_totals(local, labelled, paths, add, peak)
    alive = lambda c: F.when(~F.col("looped"), F.col(c))
    return paths.select(
        "neuron", "id", alive("top").alias("top"), alive("hops").alias("hops"), *[alive(f"u_{n}").alias(n) for n in up], *[alive(f"t_{n}").alias(n) for n in carry],
        *[F.when(~F.col("ringed"), F.col(f"d_{n}")).alias(n) for n in below], "looped",
    )


def _extended(measures: list[str], tags: list[str]) -> list[Column]:
    """A path prolonged by the matching ``_``-prefixed path, where there is one."""
    return [
        *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in measures],
        *[F.coalesce(f"_{c}", c).alias(c) for c in tags],
        (F.col("looped") | F.coalesce("_looped", F.lit(False))).alias("looped"),
    ]


def _close_paths(local: DataFrame, measures: list[str], tags: list[str]) -> DataFrame:
    """Prolong every node's path by what lies above the top of its run."""
    links = local.filter((F.col("id") == F.col("top")) & (F.col("link") != -1) & ~F.col("looped")).select("neuron", "id", "link")
    if links.isEmpty():
        return local
    above = local.select("neuron", F.col("id").alias("link"), "looped", *measures, *tags)
    step = links.join(above, ["neuron", "link"])
    step = step.withColumn("hops", F.col("hops") + 1).withColumn("jump", F.col("top")).drop("link")
    step = land(step, "tops")
    size = step.count()
    for _ in range(size.bit_length() + 1):
        far = step.select("neuron", F.col("id").alias("jump"), F.col("jump").alias("_jump"), F.col("looped").alias("_looped"), *[F.col(c).alias(f"_{c}") for c in [*measures, *tags]])
        grown = step.join(far, ["neuron", "jump"], "left")
        step = land(grown.select("neuron", "id", F.col("_jump").alias("jump"), *_extended(measures, tags)), "tops")
        if step.filter(F.col("jump").isNotNull()).isEmpty():
            break
    step = step.withColumn("looped", F.col("looped") | F.col("jump").isNotNull())
    far = step.select("neuron", F.col("id").alias("_at"), F.col("looped").alias("_looped"), *[F.col(c).alias(f"_{c}") for c in [*measures, *tags]])
    met = local.withColumn("_at", F.col("top")).join(far, ["neuron", "_at"], "left")
    kept = [c for c in local.columns if c not in ("looped", *measures, *tags)]
    return met.select(*kept, *_extended(measures, tags))


def _close_totals(local: DataFrame, labelled: DataFrame, paths: DataFrame, add: list[str], peak: list[str]) -> DataFrame:
    """Bring the totals of runs that hang under other runs up to their ancestors.

    Run tops pass their values on by doubling; runs that something hangs on are
    gathered once more with the values of what hangs on each node added to it.
    """
    downs = [*add, *peak]
    links = local.filter((F.col("id") == F.col("root")) & (F.col("root_link") != -1) & ~F.col("ringed")).select("neuron", "id", F.col("root_link").alias("link"))
    if links.isEmpty():
        return paths
    attach = land(links.join(local.select("neuron", F.col("id").alias("link"), F.col("root").alias("jump"), "_run", F.col("ringed").alias("_under")), ["neuron", "link"]), "attach")
    size = attach.count()
    tops = local.filter(F.col("id") == F.col("root")).select("neuron", "id", "ringed", *downs)
    step = tops.join(attach, KEY, "left").withColumn("ringed", F.col("ringed") | F.coalesce("_under", F.lit(False))).drop("_under")
    step = land(step, "hang")
    for _ in range(size.bit_length() + 1):
        rising = step.filter(F.col("jump").isNotNull()).groupBy("neuron", F.col("jump").alias("id")).agg(*[F.sum(c).alias(f"_{c}") for c in add], *[F.max(c).alias(f"_{c}") for c in peak])
        far = step.select("neuron", F.col("id").alias("jump"), F.col("jump").alias("_jump"), F.col("ringed").alias("_ringed"))
        grown = step.join(rising, KEY, "left").join(far, ["neuron", "jump"], "left")
        step = land(grown.select(
            "neuron", "id", "link", "_run", (F.col("ringed") | F.coalesce("_ringed", F.lit(False))).alias("ringed"), F.col("_jump").alias("jump"), *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0.0))).alias(c) for c in add], *[F.greatest(c, f"_{c}").alias(c) for c in peak],
        ), "hang")
        if step.filter(F.col("jump").isNotNull()).isEmpty():
            break
    # a top whose pointer never closes lies on a loop of runs, and so does all that has it as its root
    rings = step.filter(F.col("jump").isNotNull() | F.col("ringed")).select("neuron", F.col("id").alias("root"), F.lit(True).alias("_ring")).distinct()
    hung = step.filter(F.col("link").isNotNull() & F.col("jump").isNull())
    extra = land(hung.groupBy("neuron", "_run", F.col("link").alias("id")).agg(*[F.sum(c).alias(f"_{c}") for c in add], *[F.max(c).alias(f"_{c}") for c in peak]), "extra")
    busy = extra.select("neuron", "_run").distinct()
    again = labelled.join(busy, ["neuron", "_run"], "left_semi").join(extra, ["neuron", "_run", "id"], "left")
    again = again.select(
        "neuron", "_run", "_frame", "row_idx", "id", "parent", *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0.0))).alias(c) for c in add], *[F.greatest(c, f"_{c}").alias(c) for c in peak],
    )

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_run", "row_idx"], kind="stable", ignore_index=True)
        ids, parent = pdf["id"].to_numpy(), pdf["parent"].to_numpy()
        over = np.where(parent == -1, -1, _parent_rows(_same_run(pdf), ids, parent))
        grown, peaks = _gather(over, [pdf[c].to_numpy() for c in add], [pdf[c].to_numpy() for c in peak])
        return pd.DataFrame({"neuron": pdf["neuron"], "id": ids, **dict(zip([f"_{c}" for c in downs], [*grown, *peaks]))})

    whole = again.groupBy("_frame").applyInPandas(gather, f"neuron {_ddl(labelled, 'neuron')}, id bigint" + "".join(f", _{c} double" for c in downs))
    met = paths.join(whole, KEY, "left").join(rings, ["neuron", "root"], "left")
    kept = [c for c in paths.columns if c not in ("ringed", *downs)]
    return met.select(*kept, (F.col("ringed") | F.coalesce("_ring", F.lit(False))).alias("ringed"), *[F.coalesce(f"_{c}", c).alias(c) for c in downs])


def root_paths(nodes: DataFrame, sums: Sequence[str] = (), stop: Column | None = None, carry: Sequence[str] = (), run_rows: int | None = None) -> DataFrame:
    """``traverse`` upwards: totals of the columns ``sums`` over each path, and ``top_<name>`` for those in ``carry``."""
    return traverse(nodes, up={c: F.col(c) for c in sums}, carry={f"top_{c}": F.col(c) for c in carry}, stop=stop, run_rows=run_rows)


def subtree_totals(nodes: DataFrame, sums: Sequence[str] = (), maxes: Sequence[str] = (), run_rows: int | None = None) -> DataFrame:
    """Totals and maxima of columns over every node's subtree, the node included; null on and below loops."""
    return traverse(nodes, sums={c: F.col(c) for c in sums}, maxes={c: F.col(c) for c in maxes}, run_rows=run_rows).select("neuron", "id", *sums, *maxes)


# ------------------------------------------------------------------- orders

def parent_first_order(nodes: DataFrame, rows: int | None = None, order: Sequence[str] = ("row_idx",), run_rows: int | None = None) -> DataFrame:
    """Depth-first position of every node: parents before children, siblings in
    file order, roots in file order.  ``position`` is null for rows that no root
    reaches; ``problem`` names the reason."""
    sizes = subtree_totals(nodes.withColumn("size", F.lit(1.0)), ["size"], run_rows=run_rows)
    placed = nodes.join(sizes, KEY)
    placed = ordering.running(placed, ["neuron", "parent"], list(order), {"_upto": F.col("size")}, rows)
    placed = placed.withColumn("offset", F.col("_upto") - F.col("size") + 1)
    paths = root_paths(placed.withColumn("above", F.col("parent")), ["offset"], carry=["above"], run_rows=run_rows)
    out = nodes.join(paths.withColumnRenamed("offset", "position"), KEY)
    dangling = F.col("top_above") != -1
    return out.select(
        *nodes.columns,
        F.when(~F.col("looped") & ~dangling, (F.col("position") - 1).cast("bigint")).alias("position"),
        F.when(F.col("looped"), "cycle").when(dangling, "missing parent").alias("problem"),
    )


def branch_order(nodes: DataFrame, soma_only: bool = False, run_rows: int | None = None) -> DataFrame:
    """Branch order of every node: 0 at a soma root, 1 along the first run, plus
    one at every later node that branches and is not a soma."""
    counted = child_counts(nodes)
    step = F.when((F.col("n_children") >= 2) & (F.col("type") != 1), 1).otherwise(0)
    out = root_paths(counted.withColumn("turns", step), ["turns"], carry=["type", "turns"], run_rows=run_rows)
    order = (
        F.when(F.col("looped"), F.lit(1))
        .when(F.col("hops") == 0, F.when(F.col("top_type") == 1, 0).otherwise(1))
        .otherwise(1 + F.col("turns") - F.col("top_turns"))
        .cast("int")
    )
    out = out.select("neuron", "id", order.alias("branch_order"))
    if soma_only:
        with_soma = nodes.filter(F.col("type") == 1).select("neuron").distinct()
        out = out.join(with_soma, "neuron", "left_semi")
    return out


def root_distance(nodes: DataFrame, scale: float = 1.0, run_rows: int | None = None) -> DataFrame:
    """Cable distance to the root, hop count and the root reached."""
    paths = root_paths(with_edge_length(nodes, scale), ["edge_length"], run_rows=run_rows)
    return paths.withColumnRenamed("edge_length", "root_distance").withColumnRenamed("top", "root")


def subtree_cable(nodes: DataFrame, scale: float = 1.0, run_rows: int | None = None) -> DataFrame:
    """Node count and cable below (and including the edge into) every node."""
    measured = with_edge_length(nodes, scale).withColumn("n_nodes", F.lit(1.0))
    out = subtree_totals(measured, ["edge_length", "n_nodes"], run_rows=run_rows)
    return out.select("neuron", "id", F.col("edge_length").alias("cable_length"), F.col("n_nodes").cast("bigint").alias("n_nodes"))


def node_measures(nodes: DataFrame, scale: float = 1.0, run_rows: int | None = None) -> DataFrame:
    """Root, hops and cable to it, and nodes and cable below, of every node in one traversal; null on and below loops."""
    length = F.col("edge_length")
    out = traverse(with_edge_length(nodes, scale), up={"root_distance": length}, sums={"n_nodes": F.lit(1.0), "cable_length": length}, run_rows=run_rows)
    return out.select("neuron", "id", F.col("top").alias("root"), "hops", "root_distance", F.col("n_nodes").cast("bigint").alias("n_nodes"), "cable_length", "looped")


def nearest_marked(nodes: DataFrame, mark: Column) -> DataFrame:
    """Closest marked ancestor-or-self of every node (null when there is none)."""
    flagged = nodes.withColumn("_mark", F.coalesce(mark, F.lit(False)))
    flagged = flagged.withColumn("hit", F.col("_mark").cast("int"))
    paths = root_paths(flagged, stop=F.col("_mark"), carry=["hit"])
    met = F.col("top_hit") == 1
    return paths.select("neuron", "id", F.when(met, F.col("top")).alias("marked"), F.when(met, F.col("hops")).alias("marked_hops"))


def rerooted(nodes: DataFrame, at: DataFrame) -> DataFrame:
    """Trees turned so that the node listed in ``at`` (neuron, id) is the root.

    Only the nodes on the way from the new root up to the old one change their
    parent.  Nodes outside the new root's tree get a null ``tree_parent``.
    """
    goal = at.select("neuron", "id", F.lit(1.0).alias("below"))
    tagged = nodes.join(goal, KEY, "left").fillna(0.0, ["below"])
    tagged = tagged.join(subtree_totals(tagged, ["below"]).withColumnRenamed("below", "spine"), KEY)
    spine = tagged.filter("spine > 0").select("neuron", F.col("parent").alias("id"), F.col("id").alias("below_id"))
    flipped = tagged.join(spine, KEY, "left")
    tops = root_paths(nodes).select("neuron", "id", "top")
    goal_top = at.join(tops, KEY).select("neuron", F.col("top").alias("goal_top"))
    flipped = flipped.join(tops, KEY).join(goal_top, "neuron", "left")
    parent = (
        F.when(F.col("goal_top").isNull() | ~F.col("top").eqNullSafe(F.col("goal_top")), F.lit(None))
        .when(F.col("spine") > 0, F.coalesce("below_id", F.lit(-1)))
        .otherwise(F.col("parent"))
    )
    turned = flipped.select(*nodes.columns, parent.cast("bigint").alias("tree_parent"))
    return turned
