"""Growth of a soma's core over the arrays of its surroundings.

The surroundings are a tree in file order, swept by depth: what holds on the way
from the core to a node (reached, gate passed, hops, thin nodes) follows from
its parent's entry, so one sweep over the levels answers it for all nodes at
once, and a sweep back marks the ways of absorbed nodes.  Clusters are found on
a grid of cells as wide as the radius; only cells next to each other are
compared, slice by slice, and only counts and labels are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd

from arborspark.operators.topology import _parent_rows

SLICE = 4_000_000  # distances held at a time


@dataclass(frozen=True)
class Rules:
    """Fixed values of the growth; no limit on rounds or searched nodes unless given."""

    neurite_ratio: float = 1.5
    soma_ratio: float = 2.0
    zone_um: float = 20.0
    near: tuple[int, int, float] = (5, 4, 0.80)
    ahead: tuple[int, int, float] = (10, 6, 0.75)
    min_samples: int = 3
    eps_quantile: float = 0.30
    eps_factor: float = 2.0
    core_factor: float = 8.0
    path_share: float = 0.40
    path_allowance: int = 2
    small_cable_um: float = 20.0
    small_reach_um: float = 5.0
    small_ratio: float = 1.8
    max_rounds: int | None = None
    max_searched: int | None = None


def distances(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, distances of some rows of ``a`` to all of ``b``), a slice at a time."""
    step = max(1, SLICE // max(len(b), 1))
    for start in range(0, len(a), step):
        yield start, np.sqrt(((a[start : start + step, None, :] - b[None, :, :]) ** 2).sum(axis=2))


def grid_clusters(points: np.ndarray, eps: float, min_samples: int) -> np.ndarray:
    """Density clusters numbered by their first dense point; -1 outside.

    Dense points have ``min_samples`` points within ``eps``, themselves counted.
    A point that is not dense belongs to the first cluster with a dense point
    within ``eps``.
    """
    n = len(points)
    cell = np.floor(points / eps).astype(np.int64)
    names, of = np.unique(cell, axis=0, return_inverse=True)
    of = of.reshape(-1)
    number = {tuple(c): i for i, c in enumerate(names)}
    order = np.argsort(of, kind="stable")
    held = np.split(order, np.searchsorted(of[order], np.arange(1, len(names))))
    beside = [[number[b] for d in product((-1, 0, 1), repeat=3) if (b := tuple(c + np.array(d))) in number] for c in names]

    def close() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for own, around in zip(held, beside):
            others = np.concatenate([held[b] for b in around])
            for start, part in distances(points[own], points[others]):
                yield own[start : start + len(part)], others, part <= eps

    count = np.zeros(n, dtype=np.int64)
    for rows, _, near in close():
        count[rows] = near.sum(axis=1)
    dense = count >= min_samples
    # a dense point's root is hooked under the smallest root around it, and ways to the root are halved
    root = np.append(np.where(dense, np.arange(n), n), n)
    while True:
        while (root[root] != root).any():
            root = root[root]
        label = root[:n]
        hooked = root.copy()
        for rows, others, near in close():
            seen = np.where(near, np.where(dense[others], label[others], n)[None, :], n).min(axis=1)
            np.minimum.at(hooked, label[rows[dense[rows]]], seen[dense[rows]])
        if (hooked == root).all():
            break
        root = hooked
    joined = label.copy()
    for rows, others, near in close():
        edge = ~dense[rows]
        joined[rows[edge]] = np.where(near[edge], np.where(dense[others], label[others], n)[None, :], n).min(axis=1)
    firsts = np.unique(label[dense])
    return np.where(joined < n, np.searchsorted(firsts, joined), -1)


class Surroundings:
    """The tree around one soma, in file order, with its levels by hops from the soma."""

    def __init__(self, pdf: pd.DataFrame, rules: Rules = Rules()):
        pdf = pdf.sort_values("row_idx", kind="stable")
        self.rules, self.ids, n = rules, pdf["id"].to_numpy(), len(pdf)
        self.xyz = pdf[["x", "y", "z"]].to_numpy(float)
        self.edge, self.radius = pdf["edge_length"].to_numpy(float), pdf["radius"].to_numpy(float)
        self.ratio, soma_dist = pdf["ratio"].to_numpy(float), pdf["soma_dist"].to_numpy(float)
        self.soma_dist, self.zone = soma_dist, soma_dist <= rules.zone_um
        self.up = _parent_rows(pdf["neuron"], self.ids, pdf["parent"].to_numpy())
        self.soma = int(np.argmax(pdf["type"].to_numpy() == 1))
        order, count = np.argsort(self.up, kind="stable"), np.bincount(self.up + 1, minlength=n + 1)
        first, count = np.cumsum(count)[:-1], count[1:]
        self.levels, level = [], np.array([self.soma])
        while len(level):
            self.levels.append(level)
            size = count[level]
            level = order[np.repeat(first[level] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        self.preorder = self._preorder()
        self.exit_like = self._exit_like(pdf["cable"].to_numpy(float))

    def _preorder(self) -> np.ndarray:
        """Depth-first position below the soma, siblings in file order."""
        size, place = np.ones(len(self.ids), dtype=np.int64), np.zeros(len(self.ids), dtype=np.int64)
        for level in self.levels[:0:-1]:
            np.add.at(size, self.up[level], size[level])
        for level in self.levels[1:]:
            parent, before = self.up[level], np.cumsum(size[level]) - size[level]
            eldest = np.maximum.accumulate(np.where(np.r_[True, parent[1:] != parent[:-1]], np.arange(len(level)), 0))
            place[level] = place[parent] + 1 + before - before[eldest]
        return place

    def _exit_like(self, cable: np.ndarray) -> np.ndarray:
        """Nodes that are not thick themselves and whose path ahead, by most cable, is that of a thin neurite."""
        n = len(self.ids)
        child = np.flatnonzero(self.up >= 0)
        ranked = child[np.lexsort((child, -cable[child], self.up[child]))]
        heads = ranked[np.r_[True, np.diff(self.up[ranked]) != 0]] if len(ranked) else ranked
        onward = np.full(n + 1, n)
        onward[self.up[heads]] = heads
        path = [np.arange(n)]
        for _ in range(self.rules.ahead[0] - 1):
            path.append(onward[path[-1]])
        seen = np.append(self.ratio, np.nan)[np.array(path).T]
        known = np.isfinite(seen)
        low = known & (np.where(known, seen, np.inf) <= self.rules.neurite_ratio)
        thin = ~(np.isfinite(self.ratio) & (self.ratio >= self.rules.soma_ratio))
        for length, least, share in (self.rules.near, self.rules.ahead):
            count = known[:, :length].sum(axis=1)
            ranked_values = np.sort(np.where(known, seen, np.inf)[:, :length], axis=1)
            rows, middle = np.arange(n), np.maximum(count - 1, 0)
            median = (ranked_values[rows, middle // 2] + ranked_values[rows, (middle + 1) // 2]) / 2
            thin &= (count >= least) & (median <= self.rules.neurite_ratio) & (low[:, :length].sum(axis=1) >= share * count - 1e-12)
        return thin

    def ways_out(self, core: np.ndarray) -> dict[str, np.ndarray]:
        """For all nodes: reached from the core, the core's child passed, hops and thin nodes on the way."""
        n = len(self.ids)
        reached, gate, hops, thin = np.zeros(n, dtype=bool), np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        low = self.ratio <= self.rules.neurite_ratio
        for level in self.levels[1:]:
            parent = self.up[level]
            leaves = core[parent]
            reached[level] = ~core[level] & self.zone[level] & (leaves | (reached[parent] & ~self.exit_like[parent]))
            gate[level] = np.where(leaves, level, gate[parent])
            hops[level] = np.where(leaves, 0, hops[parent]) + 1
            thin[level] = np.where(leaves, 0, thin[parent]) + low[level]
        return {"reached": reached, "gate": gate, "hops": hops, "thin": thin}

    def exits(self, core: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], bool]:
        """Exit-like nodes met first on each way out, in order of search; and whether the search was cut."""
        ways = self.ways_out(core)
        searched = np.flatnonzero(ways["reached"])
        searched = searched[np.lexsort((self.preorder[searched], ways["gate"][searched]))]
        limit = self.rules.max_searched
        cut = limit is not None and len(searched) > limit
        searched = searched[:limit] if cut else searched
        return searched[self.exit_like[searched]], ways, cut

    def absorbable(self, core: np.ndarray, found: np.ndarray, ways: dict[str, np.ndarray]) -> np.ndarray:
        """Members of the best cluster of exits whose ways are those of a soma."""
        rules, none = self.rules, found[:0]
        if len(found) < rules.min_samples:
            return none
        points = self.xyz[found]
        gaps = np.concatenate([np.partition(part, 1, axis=1)[:, 1] for _, part in distances(points, points)])
        gaps = gaps[np.isfinite(gaps) & (gaps > 0)]
        eps = float(np.quantile(gaps, rules.eps_quantile)) * rules.eps_factor if len(gaps) else 0.0
        if not eps > 0:
            return none
        label = grid_clusters(points, eps, rules.min_samples)
        to_core = np.concatenate([part.min(axis=1) for _, part in distances(points, self.xyz[core])])
        allowed = np.maximum(rules.path_allowance, np.ceil(ways["hops"][found] * rules.path_share))
        taken = ways["thin"][found] <= allowed
        ranks = []
        for cluster in range(label.max(initial=-1) + 1):
            own = label == cluster
            size = int((own & taken).sum())
            if size >= rules.min_samples and to_core[own].min() <= rules.core_factor * eps:
                spread = np.linalg.norm(points[own] - points[own].mean(axis=0), axis=1)
                ranks.append((float(np.median(to_core[own])), -size, float(np.median(spread)), cluster))
        return found[(label == min(ranks)[-1]) & taken] if ranks else none

    def with_ways(self, core: np.ndarray, members: np.ndarray) -> np.ndarray:
        """The core and the ways from it to its new members."""
        grown = core.copy()
        grown[members] = True
        for level in self.levels[:0:-1]:
            grown[self.up[level[grown[level]]]] = True
        return grown

    def grow(self) -> tuple[np.ndarray, bool, bool]:
        """(core, search cut somewhere, stopped by the limit of rounds)."""
        core, rounds, limit = np.zeros(len(self.ids), dtype=bool), 0, self.rules.max_rounds
        core[self.soma] = True
        any_cut = False
        while True:
            found, ways, cut = self.exits(core)
            any_cut |= cut
            members = self.absorbable(core, found, ways)
            if not len(members) or rounds == limit:
                break
            core, rounds = self.with_ways(core, members), rounds + 1
        limited = rounds == limit
        return core, any_cut or (limited and len(members) > 0), limited

    def thick_neighbours(self) -> np.ndarray:
        """Core of a small soma: thick nodes next to each other, near it by cable and in space."""
        rules, kept, cable = self.rules, np.zeros(len(self.ids), dtype=bool), np.zeros(len(self.ids))
        kept[self.soma] = True
        fits = (self.soma_dist <= rules.small_reach_um) & (self.ratio >= rules.small_ratio)
        for level in self.levels[1:]:
            cable[level] = cable[self.up[level]] + self.edge[level]
            kept[level] = kept[self.up[level]] & fits[level] & (cable[level] <= rules.small_cable_um)
        return kept

    def span(self, core: np.ndarray) -> float:
        """Largest centre distance plus both radii over the core, one node's diameter at least."""
        points, r = self.xyz[core], self.radius[core]
        r = np.where(np.isfinite(r) & (r > 0), r, 0.0)
        widest = 2.0 * float(r.max())
        for start, part in distances(points, points):
            reach = part + r[start : start + len(part), None] + r[None, :]
            rows = np.arange(len(part))
            reach[rows, start + rows] = 0.0
            widest = max(widest, float(reach.max()))
        return widest


def core_of(pdf: pd.DataFrame, rules: Rules = Rules()) -> pd.DataFrame:
    """Core nodes of one soma's surroundings, with the facts of the growth on each row."""
    around = Surroundings(pdf, rules)
    core, cut, limited = around.grow()
    added = 0
    if core.sum() == 1:
        core = around.thick_neighbours()
        added = int(core.sum()) - 1
    return pd.DataFrame({
        "neuron": pdf["neuron"].iloc[0], "id": around.ids[core], "soma_span_um": around.span(core),
        "fallback_added": added, "search_truncated": cut, "growth_limited": limited,
    })
