"""Multifurcations turned into bifurcations by moving children to nearby nodes.

A Type-5 node with more than two children looks at most nine steps down, and
what it changes lies there too.  Two such nodes can influence each other only
when one is at most nine steps below the other, so the work splits into
clusters of mutually reachable nodes.  Each cluster, with the few nodes in
view, is one group; nothing larger than that is ever gathered.

Neurons that fit a frame are packed into frames and done there from child counts
to the new order, the clusters of a frame side by side; longer ones find their
clusters by joins.

Within a cluster every node keeps its branch, hops and path from the node being
resolved, and every pair of a branch and an anchor its cost.  A move shifts the
moved branch's hops and paths by one number each and closes one branch and one
anchor; only the branch that takes it is measured anew.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborspark.operators import repair, topology
from arborspark.schema import NM_PER_UM
from arborspark.session import land

# Fixed values of the relinking.
TARGET_TYPE = 5
EXCLUDED_TYPES = (1, 6)
MAX_HOPS, MAX_PATH_UM = 8, 8.0
DIRECTION_HOPS, DIRECTION_UM = 8, 8.0
W_PATH, W_ANGLE, W_LENGTH, W_CROSSING = 0.45, 0.35, 0.15, 0.05
CROSSING_TOLERANCE_UM = 0.05
PAIRS = 1 << 20  # moves by edges held at a time
LOOK_HOPS = max(MAX_HOPS, DIRECTION_HOPS) + 1
VIEW_HOPS = LOOK_HOPS + 1  # and the edges that leave what is looked at


def clusters(nodes: DataFrame) -> DataFrame:
    """Nodes in view of a multifurcation: all columns, ``cluster`` and ``is_target``."""
    counted = topology.child_counts(nodes).withColumn(
        "is_target", (F.col("type") == TARGET_TYPE) & (F.col("n_children") > 2)
    )
    counted = land(counted, "relink")
    above = land(topology.nearest_marked(counted, F.col("is_target")), "in-view")
    targets = counted.filter("is_target").select("neuron", "id", "parent")
    higher = above.select("neuron", F.col("id").alias("parent"), F.col("marked").alias("higher"), F.col("marked_hops").alias("h"))
    linked = targets.join(higher, ["neuron", "parent"], "left")
    heads = linked.filter(F.col("higher").isNull() | (F.col("h") + 1 > LOOK_HOPS)).select("neuron", "id", F.lit(True).alias("_head"))
    marked = counted.join(heads, ["neuron", "id"], "left")
    cluster_of = topology.nearest_marked(marked, F.col("_head")).select("neuron", F.col("id").alias("marked"), F.col("marked").alias("cluster"))
    view = above.filter(F.col("marked_hops") <= VIEW_HOPS).join(cluster_of, ["neuron", "marked"])
    parents = counted.select("neuron", F.col("id").alias("parent"), *[F.col(c).alias(f"p_{c}") for c in "xyz"])
    return counted.join(view.select("neuron", "id", "cluster"), ["neuron", "id"]).join(parents, ["neuron", "parent"], "left")


def _units(v: np.ndarray) -> np.ndarray:
    """Vectors scaled to length one; shorter than 1e-12 they become zero."""
    size = np.sqrt((v**2).sum(axis=-1, keepdims=True))
    return np.where(size > 1e-12, v / np.where(size > 1e-12, size, 1.0), 0.0)


def segment_gaps(p0: np.ndarray, p1: np.ndarray, q0: np.ndarray, q1: np.ndarray) -> np.ndarray:
    """Smallest distances between segments p and q, row by row: ends to segments, or the crossing of their lines."""
    dot = lambda a, b: (a * b).sum(axis=-1)
    size = lambda a: np.sqrt(dot(a, a))
    out = np.full(np.broadcast_shapes(p0.shape, q0.shape)[:-1], np.inf)
    for start, end, others in ((p0, p1, (q0, q1)), (q0, q1, (p0, p1))):
        along = end - start
        square = dot(along, along)
        for other in others:
            share = np.clip(dot(other - start, along) / np.where(square > 0, square, 1.0), 0.0, 1.0)
            out = np.minimum(out, size(start + share[..., None] * along - other))
    u, v, w = p1 - p0, q1 - q0, p0 - q0
    a, b, c, d, e = dot(u, u), dot(u, v), dot(v, v), dot(u, w), dot(v, w)
    det = a * c - b * b
    fine = det > 1e-15
    det = np.where(fine, det, 1.0)
    s, t = (b * e - c * d) / det, (a * e - b * d) / det
    inner = fine & (s >= 0) & (s <= 1) & (t >= 0) & (t <= 1)
    return np.where(inner, np.minimum(out, size(w + s[..., None] * u - t[..., None] * v)), out)


def _norm(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v**2).sum(axis=-1))


def _stretches(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every stretch, one stretch after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


class _Trees:
    """Nodes in view of multifurcations, clusters side by side, and who hangs under whom.

    A row's children are those it had, as far as they still name it, and the one it took: a row takes one at most.
    """

    def __init__(self, ids: np.ndarray, kind: np.ndarray, xyz: np.ndarray, above: np.ndarray, up: np.ndarray):
        self.ids, self.type, self.xyz, self.above, self.up = ids, kind.copy(), xyz, above.copy(), up.copy()
        self.has_parent = ~np.isnan(above).any(axis=1)
        self.had = np.bincount(up[up >= 0], minlength=len(up))
        self.start = np.cumsum(self.had) - self.had
        self.child = np.argsort(up, kind="stable")[(up < 0).sum() :]
        self.n_kids, self.took = self.had.copy(), np.full(len(up), -1)

    def below(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All children of ``rows``: (place of the parent in ``rows``, row of the child)."""
        at, kid = np.repeat(np.arange(len(rows)), self.had[rows]), self.child[_stretches(self.start[rows], self.had[rows])]
        still, more = self.up[kid] == rows[at], np.flatnonzero(self.took[rows] >= 0)
        return np.concatenate([at[still], more]), np.concatenate([kid[still], self.took[rows[more]]])

    def rehang(self, child: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        self.n_kids[old] -= 1
        self.n_kids[new] += 1
        self.up[child], self.above[child], self.type[new], self.took[new] = new, self.xyz[new], TARGET_TYPE, child


class _Views:
    """What one multifurcation of every cluster sees: its branches, level by level, and the cost of every move.

    Arrays run over the nodes seen, over branches and over moves, which are pairs of a branch and an anchor of one
    multifurcation; branch ``b`` begins at the node seen as number ``b``.
    """

    def __init__(self, trees: _Trees, sources: np.ndarray, check_crossing: bool):
        self.t, self.sources, self.check_crossing = trees, sources, check_crossing
        of, row = trees.below(sources)
        order = np.argsort(of, kind="stable")
        self.of, self.heads = of[order], row[order]
        row, branch, over = self.heads, np.arange(len(order)), np.full(len(order), -1)
        path, seen, levels = _norm(trees.xyz[row] - trees.xyz[sources[self.of]]), 0, []
        self.old_edge = path
        for depth in range(1, VIEW_HOPS + 1):
            levels.append((row, branch, np.full(len(row), depth), path, over))
            at, kid = trees.below(row)
            if not len(kid):
                break
            path, branch, over = path[at] + _norm(trees.xyz[kid] - trees.xyz[row[at]]), branch[at], seen + at
            seen, row = seen + len(row), kid
        self.rows, self.branch, self.hop, self.path, self.over = (np.concatenate(c) for c in zip(*levels))
        self.n_kids = trees.n_kids[self.rows]
        self.under = np.full(len(self.rows), -1)
        self.under[self.over[self.over >= 0]] = np.flatnonzero(self.over >= 0)
        self.live = np.ones(len(self.heads), dtype=bool)
        anchors = np.flatnonzero(self.reach() & (self.n_kids == 1) & ~np.isin(trees.type[self.rows], EXCLUDED_TYPES))
        home = self.of[self.branch[anchors]]
        anchors, per = anchors[np.argsort(home, kind="stable")], np.bincount(home, minlength=len(sources))
        self.count = per[self.of]
        self.first = np.cumsum(self.count) - self.count
        self.b = np.repeat(np.arange(len(self.heads)), self.count)
        self.a = anchors[_stretches((np.cumsum(per) - per)[self.of], self.count)]
        self.new_edge = _norm(trees.xyz[self.heads[self.b]] - trees.xyz[self.rows[self.a]])
        self.angle = np.zeros(len(self.b))
        self._aim(np.arange(len(self.heads)))

    def reach(self) -> np.ndarray:
        return (self.hop <= MAX_HOPS) & (self.path <= MAX_PATH_UM)

    def _aim(self, branches: np.ndarray) -> None:
        """Turning cost of ``branches`` at every anchor, by the point 8 micrometres along their unbranched run."""
        run = [branches]
        for _ in range(DIRECTION_HOPS):
            following = np.where(self.n_kids[run[-1]] == 1, self.under[run[-1]], -1)
            run.append(np.where(following >= 0, following, run[-1]))
        run, each = np.stack(run, axis=1), np.arange(len(branches))
        last = (run[:, 1:] != run[:, :-1]).sum(axis=1)
        path, points = self.path[run], self.t.xyz[self.rows[run]]
        before = ((path <= DIRECTION_UM) & (np.arange(run.shape[1]) <= last[:, None])).sum(axis=1) - 1
        low, inner = np.maximum(before, 0), (before >= 0) & (before < last)
        high = np.where(inner, low + 1, low)
        stretch = np.where(inner, path[each, high] - path[each, low], 1.0)
        point = (points[each, high] - points[each, low]) / stretch[:, None] * np.where(inner, DIRECTION_UM - path[each, low], 0.0)[:, None] + points[each, low]
        moves = _stretches(self.first[branches], self.count[branches])
        which = np.repeat(each, self.count[branches])
        away = _units(point - self.t.xyz[self.sources[self.of[branches]]])
        cosine = (_units(point[which] - self.t.xyz[self.rows[self.a[moves]]]) * away[which]).sum(axis=1)
        self.angle[moves] = 0.5 * (1.0 - np.clip(cosine, -1.0, 1.0))

    def _crossings(self, slot: int, moves: np.ndarray) -> np.ndarray:
        """For every one of ``moves`` of a multifurcation, how near its new edge comes to the edges in view that it doesn't touch, 1 at contact."""
        t, kept = self.t, self.reach()
        mine = np.flatnonzero(self.of[self.branch] == slot)
        rows, above = self.rows[mine], self.over[mine]
        near = np.append(rows[(above < 0) | kept[above]], self.sources[slot])
        ends = np.union1d(near, rows[np.isin(t.up[rows], near)])
        ends = ends[t.has_parent[ends]]
        over, here, there = t.up[ends], t.xyz[ends], t.above[ends]
        low, high = np.minimum(here, there) - CROSSING_TOLERANCE_UM, np.maximum(here, there) + CROSSING_TOLERANCE_UM
        out, step = np.zeros(len(moves)), max(1, PAIRS // max(len(ends), 1))
        for start in range(0, len(moves), step):
            some = moves[start : start + step]
            head, anchor = self.heads[self.b[some]], self.rows[self.a[some]]
            p, q = t.xyz[anchor], t.xyz[head]
            meet = np.ones((len(head), len(ends)), dtype=bool)
            for axis in range(3):
                meet &= (np.minimum(p, q)[:, axis, None] <= high[None, :, axis]) & (np.maximum(p, q)[:, axis, None] >= low[None, :, axis])
            for own in (head, anchor):
                meet &= (ends[None, :] != own[:, None]) & (over[None, :] != own[:, None])
            move, end = np.nonzero(meet)
            closest = np.full(len(head), np.inf)
            np.minimum.at(closest, move, segment_gaps(p[move], q[move], here[end], there[end]))
            out[start : start + step] = np.maximum(0.0, 1.0 - closest / CROSSING_TOLERANCE_UM)
        return out

    def crowded(self) -> np.ndarray:
        """Which multifurcations still have more than two branches."""
        return np.bincount(self.of[self.live], minlength=len(self.sources)) > 2

    def cheapest(self, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """The move of least cost of every multifurcation ``wanted`` that has one; by path, new edge and ids among equals."""
        t, open_to = self.t, (self.n_kids == 1) & self.reach()
        at = np.flatnonzero((self.live & wanted[self.of])[self.b] & open_to[self.a] & (self.branch[self.a] != self.b))

        def dearest(cost: np.ndarray) -> np.ndarray:
            least = np.full(len(self.sources), np.inf)
            np.minimum.at(least, self.of[self.b[at]], cost)
            return least[self.of[self.b[at]]]

        def costs() -> tuple[np.ndarray, np.ndarray]:
            length = np.maximum(0.0, self.new_edge[at] - self.old_edge[self.b[at]]) / MAX_PATH_UM
            return W_PATH * (self.path[self.a[at]] / MAX_PATH_UM) + W_ANGLE * self.angle[at] + W_LENGTH * length, length

        cost, length = costs()
        crossing = np.zeros(len(at))
        if self.check_crossing:  # a crossing costs W_CROSSING at most, so dearer moves cannot win
            fine = cost <= dearest(cost) + W_CROSSING
            at, cost, length, slot = at[fine], cost[fine], length[fine], self.of[self.b[at[fine]]]
            crossing = np.zeros(len(at))
            for one in np.unique(slot):
                crossing[slot == one] = self._crossings(one, at[slot == one])
        cost = cost + W_CROSSING * crossing
        fine = cost == dearest(cost)
        at, cost, length, crossing = at[fine], cost[fine], length[fine], crossing[fine]
        b, a = self.b[at], self.a[at]
        order = np.lexsort((t.ids[self.rows[a]], t.ids[self.heads[b]], self.new_edge[at], self.path[a], self.of[b]))
        order = order[np.unique(self.of[b][order], return_index=True)[1]]
        at, b, a = at[order], b[order], a[order]
        return {
            "slot": self.of[b], "branch": b, "anchor": a, "moved_child": self.heads[b], "new_parent": self.rows[a], "anchor_root": self.heads[self.branch[a]],
            "anchor_hops": self.hop[a], "anchor_path_distance_um": self.path[a], "anchor_original_type": t.type[self.rows[a]],
            "original_edge_um": self.old_edge[b], "new_edge_um": self.new_edge[at], "angular_cost": self.angle[at], "length_cost": length[order],
            "crossover_cost": crossing[order], "total_cost": cost[order],
        }

    def move(self, b: np.ndarray, anchor: np.ndarray, new_edge: np.ndarray) -> None:
        """Hang branches ``b`` under their anchors: their nodes join the anchor's branch, farther by one stretch."""
        taker, farther, deeper, joins = self.branch[anchor], np.zeros(len(self.heads)), np.zeros(len(self.heads), dtype=int), np.arange(len(self.heads))
        farther[b], deeper[b], joins[b] = self.path[anchor] + new_edge - self.old_edge[b], self.hop[anchor], taker
        self.path, self.hop, self.branch = self.path + farther[self.branch], self.hop + deeper[self.branch], joins[self.branch]
        self.over[b] = anchor
        self.n_kids[anchor] += 1
        self.live[b] = False
        self.t.rehang(self.heads[b], self.sources[self.of[b]], self.rows[anchor])
        self._aim(taker)


def _resolve(trees: _Trees, targets: np.ndarray, cluster: np.ndarray, check_crossing: bool) -> dict[str, np.ndarray]:
    """Moves of all ``targets`` (rows in file order), by cluster up to the first that has no way out.

    Clusters don't touch each other, so the first targets of all clusters are resolved together, then the second ones.
    Nodes are told by row.
    """
    order = np.argsort(cluster[targets], kind="stable")
    targets = targets[order]
    _, first, slot = np.unique(cluster[targets], return_index=True, return_inverse=True)
    turn, stuck, out = np.arange(len(targets)) - first[slot], np.zeros(len(first), dtype=bool), []
    queue = np.argsort(turn, kind="stable")
    for at in np.split(queue, np.cumsum(np.bincount(turn))[:-1]) if len(targets) else ():
        at = at[~stuck[slot[at]]]
        if not len(at):
            break
        views, step, wanted = _Views(trees, targets[at], check_crossing), 0, np.ones(len(at), dtype=bool)
        while (wanted := wanted & views.crowded()).any():
            told, step = views.cheapest(wanted), step + 1
            found = np.isin(np.arange(len(at)), told["slot"])
            lost = np.flatnonzero(wanted & ~found)
            if len(lost):
                stuck[slot[at[lost]]], wanted = True, wanted & found
                out.append({"type5_node": targets[at[lost]], "failed": np.ones(len(lost), dtype=bool)})
            if len(told["slot"]):
                views.move(told.pop("branch"), told.pop("anchor"), told["new_edge_um"])
                source = targets[at[told.pop("slot")]]
                out.append({"type5_node": source, "failed": np.zeros(len(source), dtype=bool), "step": np.full(len(source), step), **told})
    sizes = [len(o["failed"]) for o in out]
    blank = lambda c, n: np.full(n, -1 if c in _STEP_ROWS or c in _STEP_COUNTS else np.nan)
    return {c: np.concatenate([o[c] if c in o else blank(c, n) for o, n in zip(out, sizes)] or [np.zeros(0, dtype=int)]) for c in _STEP_COLUMNS}


class _Cluster:
    """Nodes in view of some multifurcations, in file order."""

    def __init__(self, pdf: pd.DataFrame, check_crossing: bool):
        pdf = pdf.sort_values("row_idx", kind="stable")
        self.ids, self.check_crossing = pdf["id"].to_numpy(), check_crossing
        xyz, above = pdf[["x", "y", "z"]].to_numpy(float) / NM_PER_UM, pdf[["p_x", "p_y", "p_z"]].to_numpy(float) / NM_PER_UM
        up = topology._parent_rows(pdf["neuron"], self.ids, pdf["parent"].to_numpy())
        self.trees = _Trees(self.ids, pdf["type"].to_numpy(), xyz, above, up)
        self.targets = np.flatnonzero(pdf["is_target"].to_numpy(dtype=bool))

    def resolve(self) -> list[dict]:
        """Moves of all targets in file order, up to the first that has no way out."""
        told = _resolve(self.trees, self.targets, np.zeros(len(self.ids), dtype=int), self.check_crossing)
        told.update({c: self.ids[told[c]] for c in _STEP_ROWS})
        rows = [dict(zip(told, values)) for values in zip(*told.values())]
        return [{k: r[k] for k in ("type5_node", "failed")} if r["failed"] else r for r in rows]


_STEP = (
    "type5_node bigint, failed boolean, step int, moved_child bigint, new_parent bigint, anchor_root bigint, anchor_hops int, "
    "anchor_path_distance_um double, anchor_original_type int, original_edge_um double, new_edge_um double, "
    "angular_cost double, length_cost double, crossover_cost double, total_cost double"
)
_STEP_FIELDS = dict(c.split() for c in _STEP.split(", "))
_STEP_COLUMNS = list(_STEP_FIELDS)
_STEP_TYPES = {c: {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}[k] for c, k in _STEP_FIELDS.items()}
_STEP_ROWS = ("type5_node", "moved_child", "new_parent", "anchor_root")
_STEP_COUNTS = ("step", "anchor_hops", "anchor_original_type")


class _Frame:
    """Whole neurons in file order, and the moves in them."""

    def __init__(self, table: pa.Table, check_crossing: bool):
        code, row_idx = pd.factorize(table["neuron"].to_pandas())[0], table["row_idx"].to_numpy()
        order = np.lexsort((row_idx, code))
        self.table, self.neuron, self.row_idx = table.take(pa.array(order)), code[order], row_idx[order]
        self.ids, self.type = self.table["id"].to_numpy(), self.table["type"].to_numpy()
        self.parent = pc.fill_null(self.table["parent"], np.iinfo(np.int64).min).to_numpy()
        self.up = np.where(self.parent == -1, -1, topology._parent_rows(pd.Series(self.neuron), self.ids, self.parent))
        same = np.lexsort((self.ids, self.neuron))
        again = np.flatnonzero((self.neuron[same][1:] == self.neuron[same][:-1]) & (self.ids[same][1:] == self.ids[same][:-1]))
        self.repeats = np.zeros(len(order), dtype=bool)  # rows of neurons with an id twice: nothing is moved there
        self.repeats[np.isin(self.neuron, self.neuron[same][again])] = True
        self.told = self._moves(check_crossing)

    def _moves(self, check_crossing: bool) -> dict[str, np.ndarray]:
        """``clusters`` and ``_resolve`` within the frame; nodes are told by row."""
        up, n_kids = self.up, np.bincount(self.up[self.up >= 0], minlength=len(self.up))
        target = (self.type == TARGET_TYPE) & (n_kids > 2) & ~self.repeats
        top, (hops,), looped = topology._climb(np.where(target, -1, up), [(~target & (up >= 0)).astype(np.int64)])
        below = ~looped & target[top]
        at = np.flatnonzero(target)
        head = np.zeros(len(up), dtype=bool)
        head[at] = (up[at] < 0) | ~below[up[at]] | (hops[up[at]] + 1 > LOOK_HOPS)
        highest, _, ring = topology._climb(np.where(head, -1, up), [])
        own = np.where(head[highest] & ~ring, highest, -1 - self.neuron)  # targets in a ring without a head are one cluster
        rows = np.flatnonzero(below & (hops <= VIEW_HOPS))
        cluster, place = own[top[rows]], np.full(len(up), -1)
        place[rows] = np.arange(len(rows))
        over = np.where(up[rows] >= 0, place[up[rows]], -1)
        over = np.where((over >= 0) & (cluster[over] == cluster), over, -1) if len(rows) else over
        xyz = np.stack([self.table[c].to_numpy().astype(float) for c in "xyz"], axis=1) / NM_PER_UM
        above = np.where((up[rows] >= 0)[:, None], xyz[up[rows]], np.nan)
        trees = _Trees(self.ids[rows], self.type[rows], xyz[rows], above, over)
        told = _resolve(trees, np.flatnonzero(target[rows]), cluster, check_crossing)
        told["failed"] = told["failed"].astype(bool)
        for c in _STEP_ROWS:
            told[c] = np.where(told[c] >= 0, rows[told[c]], -1) if len(rows) else told[c].astype(int)
        return told

    def step_columns(self, at: np.ndarray, size: int, to: np.ndarray) -> dict[str, pa.Array]:
        """Moves ``at`` as columns of ``size`` rows, each move in its row ``to``, the others null."""
        out = {}
        for name, kind in _STEP_TYPES.items():
            if name != "failed":
                values, blank = np.zeros(size, dtype=kind.to_pandas_dtype()), np.ones(size, dtype=bool)
                told = self.told[name][at]
                values[to], blank[to] = self.ids[told] if name in _STEP_ROWS else told, False
                if name != "type5_node":
                    blank[to] = self.told["failed"][at]
                out[name] = pa.array(values, mask=blank)
        return out

    def steps(self) -> pa.Table:
        """All moves and failures, as ``relink_steps`` tells them."""
        n = len(self.told["failed"])
        told = self.step_columns(np.arange(n), n, np.arange(n))
        told["failed"] = pa.array(self.told["failed"], type=pa.bool_())
        return pa.table({"neuron": self.table["neuron"].take(pa.array(self.told["type5_node"])), **{c: told[c] for c in _STEP_COLUMNS}})

    def relinked(self, columns: list[str]) -> pa.Table:
        """All nodes after their moves, with position, former Type-5, fallback, and the move of a moved node."""
        stuck, moved = self.told["failed"], self.told["moved_child"]
        at = np.flatnonzero(~stuck)
        up, parent, kind = self.up.copy(), self.parent.copy(), np.zeros(len(self.up), dtype=bool)
        at = at[~np.isin(self.neuron[moved[at]], self.neuron[self.told["type5_node"][stuck]])]
        up[moved[at]], parent[moved[at]], kind[self.told["new_parent"][at]] = self.told["new_parent"][at], self.ids[self.told["new_parent"][at]], True
        position = topology._positions(self.neuron, up, parent)
        unfit = np.isin(self.neuron, np.concatenate([self.neuron[position < 0], self.neuron[self.repeats], self.neuron[self.told["type5_node"][stuck]]]))
        at = at[~unfit[moved[at]]]
        shifted = np.zeros(len(up), dtype=bool)
        shifted[moved[at]] = True
        old = self.table["parent"], self.table["type"]
        out = {c: self.table[c] for c in columns}
        out["parent"] = pc.if_else(pa.array(shifted), pa.array(parent), old[0])
        out["type"] = pc.if_else(pa.array(kind & ~unfit), pa.scalar(TARGET_TYPE, type=old[1].type), old[1])
        out.update({"position": pa.array(np.where(unfit, self.row_idx, position)), "_was_target": pa.array(self.type == TARGET_TYPE), "_fallback": pa.array(unfit)})
        return pa.table({**out, **self.step_columns(at, len(up), moved[at])})


def relink_steps(nodes: DataFrame, check_crossing: bool = False) -> DataFrame:
    """Every move, in order per node; a row with ``failed`` where a node has no way out.

    Nothing is moved in a neuron that uses an id twice.
    """
    whole, longer = topology.whole_neurons(nodes.select("neuron", "id", "row_idx", "parent", "type", "x", "y", "z"))
    kind = nodes.schema["neuron"].dataType.simpleString()
    steps = whole.groupBy("_frame").applyInArrow(lambda table: _Frame(table, check_crossing).steps(), f"neuron {kind}, {_STEP}")
    return steps if longer is None else steps.unionByName(_steps_by_joins(longer, check_crossing))


def _steps_by_joins(nodes: DataFrame, check_crossing: bool) -> DataFrame:
    """``relink_steps`` of neurons of any length."""
    nodes = nodes.join(repair.duplicate_ids(nodes), "neuron", "left_anti")
    view = clusters(nodes).select("neuron", "cluster", "id", "row_idx", "parent", "type", "x", "y", "z", "p_x", "p_y", "p_z", "is_target")

    def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(_Cluster(pdf, check_crossing).resolve(), columns=_STEP_COLUMNS)
        for c in ("step", "moved_child", "new_parent", "anchor_root", "anchor_hops", "anchor_original_type"):
            out[c] = out[c].astype("Int64")
        out.insert(0, "neuron", pdf["neuron"].iloc[0])
        return out

    kind = nodes.schema["neuron"].dataType.simpleString()
    return view.groupBy("neuron", "cluster").applyInPandas(resolve, f"neuron {kind}, {_STEP}")


def relink(nodes: DataFrame, rows: int | None = None, check_crossing: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes in parent-first order, steps, log).

    A neuron with a node that cannot be resolved, duplicate ids, a missing
    parent or a cycle is passed through unchanged as ``fallback_copy``.
    """
    whole, longer = topology.whole_neurons(nodes)
    columns = list(nodes.columns)
    told = T.StructType.fromDDL(", ".join(f"{c} {k}" for c, k in _STEP_FIELDS.items() if c != "failed"))
    schema = T.StructType([*nodes.schema.fields, *T.StructType.fromDDL("position bigint, _was_target boolean, _fallback boolean").fields, *told.fields])
    done = land(whole.groupBy("_frame").applyInArrow(lambda table: _Frame(table, check_crossing).relinked(columns), schema), "relinked")
    used = done.filter("step IS NOT NULL").select("neuron", *[F.lit(False).alias(c) if c == "failed" else F.col(c) for c in _STEP_COLUMNS])
    log = done.groupBy("neuron").agg(
        F.count(F.lit(1)).alias("n_nodes_before"), F.count_if("_was_target").alias("n_type5_nodes"), F.count_if(F.col("step") == 1).alias("n_type5_relinked"),
        F.count("step").alias("n_relinked_branches"), F.count(F.lit(1)).alias("n_nodes_after"),
        F.when(F.bool_or("_fallback"), "fallback_copy").otherwise("relinked").alias("output_method"),
    )
    parts = done.select(*columns, "position"), used, log
    return parts if longer is None else tuple(a.unionByName(b) for a, b in zip(parts, _relink_by_joins(longer, rows, check_crossing)))


def _relink_by_joins(nodes: DataFrame, rows: int | None, check_crossing: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``relink`` of neurons of any length."""
    steps = land(_steps_by_joins(nodes, check_crossing), "steps")
    broken = steps.filter("failed").select("neuron").distinct()
    taken = steps.filter("NOT failed").join(broken, "neuron", "left_anti")
    moved = taken.select("neuron", F.col("moved_child").alias("id"), F.col("new_parent").alias("_p"))
    anchors = taken.select("neuron", F.col("new_parent").alias("id"), F.lit(TARGET_TYPE).alias("_t")).distinct()
    changed = nodes.join(moved, ["neuron", "id"], "left").join(anchors, ["neuron", "id"], "left")
    changed = land(
        changed.withColumns({"parent": F.coalesce("_p", "parent"), "type": F.coalesce("_t", "type").cast("int")}).select(*nodes.columns), "relinked"
    )
    placed = land(topology.parent_first_order(changed, rows), "placed")
    unfit = placed.filter("position IS NULL").select("neuron").union(broken).union(repair.duplicate_ids(nodes)).distinct()
    unfit = land(unfit, "unfit")
    good = placed.join(unfit, "neuron", "left_anti").select(*nodes.columns, "position")
    passed = nodes.join(unfit, "neuron", "left_semi").withColumn("position", F.col("row_idx"))
    used = taken.join(unfit, "neuron", "left_anti")
    per = used.groupBy("neuron").agg(F.countDistinct("type5_node").alias("n_type5_relinked"), F.count(F.lit(1)).alias("n_relinked_branches"))
    sizes = nodes.groupBy("neuron").agg(F.count(F.lit(1)).alias("n_nodes_before"), F.count_if(F.col("type") == TARGET_TYPE).alias("n_type5_nodes"))
    log = sizes.join(per, "neuron", "left").join(unfit.withColumn("_bad", F.lit(True)), "neuron", "left").fillna(0)
    method = F.when(F.col("_bad"), "fallback_copy").otherwise("relinked")
    log = log.withColumns({"n_nodes_after": F.col("n_nodes_before"), "output_method": method}).drop("_bad")
    return good.unionByName(passed), used, log


def node_records(nodes: DataFrame, relinked: DataFrame, steps: DataFrame) -> DataFrame:
    """One row per resolved node: its children before and after and where they went."""
    sources = steps.select("neuron", F.col("type5_node").alias("parent")).distinct()

    def listing(df: DataFrame, name: str) -> DataFrame:
        kids = df.join(sources, ["neuron", "parent"], "left_semi")
        g = kids.groupBy("neuron", F.col("parent").alias("type5_node")).agg(F.array_sort(F.collect_list(F.struct("row_idx", "id"))).alias("_k"))
        return g.select("neuron", "type5_node", F.size("_k").alias(f"n_direct_children_{name}"),
                        F.array_join(F.transform("_k", lambda k: k.id.cast("string")), ",").alias(f"children_{name}"))

    g = steps.groupBy("neuron", "type5_node").agg(F.array_sort(F.collect_list(F.struct("step", "moved_child", "new_parent"))).alias("_s"))
    moves = g.select(
        "neuron", "type5_node", F.size("_s").alias("n_relinked_branches"),
        F.array_join(F.transform("_s", lambda s: s.moved_child.cast("string")), ",").alias("moved_children"),
        F.array_join(F.transform("_s", lambda s: s.new_parent.cast("string")), ",").alias("new_parent_nodes"),
    )
    keys = ["neuron", "type5_node"]
    return listing(nodes, "before").join(listing(relinked, "after"), keys).join(moves, keys)


def validate(nodes: DataFrame, relinked: DataFrame) -> DataFrame:
    """Per neuron: lost or new ids, repeated ids, missing parents, Type-5 nodes with more than two children.

    A row per node before, after and as named by a child meet in one grouping.
    """
    zero = F.lit(0).cast("bigint")
    flags = ("_before", "_after", "_crowd", "_kids")

    def rows(df: DataFrame, node: str, **said) -> DataFrame:
        return df.select("neuron", F.col(node).alias("id"), *[said.get(f, zero).cast("bigint").alias(f) for f in flags])

    one = F.lit(1)
    seen = rows(nodes, "id", _before=one).unionByName(
        rows(relinked, "id", _after=one, _crowd=F.when(F.col("type") == TARGET_TYPE, 1).otherwise(0))
    ).unionByName(rows(relinked.filter("parent <> -1"), "parent", _kids=one))
    each = seen.groupBy("neuron", "id").agg(*[F.sum(f).alias(f) for f in flags])
    return each.groupBy("neuron").agg(
        F.count_if((F.col("_before") > 0) != (F.col("_after") > 0)).alias("id_mismatch"), F.count_if(F.col("_after") > 1).alias("repeated_ids"),
        F.sum(F.when(F.col("_after") == 0, F.col("_kids")).otherwise(0)).alias("missing_parents"),
        F.sum(F.when(F.col("_kids") > 2, F.col("_crowd")).otherwise(0)).alias("unresolved"),
    )
