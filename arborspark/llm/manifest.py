"""Merkle manifest of a table, with octopus multiproofs of its rows.

Rows are leaves of one tree per group, ordered by key; every ``FANOUT``
consecutive nodes become their hash until one is left, and the groups' roots,
in order of the group (null first), form one more tree in the same way.

Proofs are made block by block.  A block holds ``BLOCK_ROWS`` consecutive
wanted leaves, of one group or of many.  It works out which nodes of the trees
it can't derive from its own leaves, the least set of coordinates that all its
proofs share; these are fetched once by one join, the interior nodes shared by
its leaves are derived from them, and each leaf's proof is spelled out locally.
A block needs at most 2 * (FANOUT - 1) nodes a level and group, whatever the
number of its leaves.

Defined results: a null field counts as absent (not as empty text); null keys
come first; equal rows are leaves each; an empty table gives no rows; columns
other than the hashed ones are left alone.  A group of any size spreads over
tasks, since leaves are numbered by ranges and grouped by ``FANOUT``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborspark.llm.lookup import lookup
from arborspark.operators.ordering import prefix_sums
from arborspark.session import land

FANOUT = 16
BLOCK_ROWS = 4096
TOP = 0  # number of the tree over the groups' roots


def leaf_digest(*fields: Column) -> Column:
    """Hash of the fields: ``-`` for a null, else UTF-8 length, colon, value."""
    parts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(p.isNull(), "-").otherwise(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p)) for p in parts]), 256)


def digests(df: DataFrame, group: str, key: str, fields: Sequence[Column], shown: Sequence[Column] | None = None, where: Column | None = None) -> DataFrame:
    """(grp, key, leaf, shown): digest of ``fields``, and of ``shown`` instead for the rows of ``where``."""
    changed = F.when(where, leaf_digest(*shown)) if shown is not None else F.lit(None).cast("string")
    return df.select(F.col(group).alias("grp"), F.col(key).alias("key"), leaf_digest(*fields).alias("leaf"), changed.alias("changed"))


def number_leaves(rows: DataFrame) -> DataFrame:
    """``digests`` with ``ordinal`` (from 0, over all groups), ``tree`` (from 1), ``pos`` (from 0 in its tree) and ``n`` (its leaves)."""
    rows = land(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    sizes = land(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "sizes")
    trees = land(prefix_sums(sizes, [], ["grp"], {"tree": F.lit(1).cast("bigint"), "upto": F.col("n")}), "trees")
    placed = prefix_sums(rows, [], ["grp", "key", "leaf", "row"], {"ordinal": F.lit(1).cast("bigint")})
    joined = lookup(placed, trees, ["grp"])
    pos = F.col("ordinal") - 1 - (F.col("upto") - F.col("n"))
    return land(joined.select("key", "leaf", F.coalesce("changed", "leaf").alias("shown"), (F.col("ordinal") - 1).alias("ordinal"), "tree", pos.alias("pos"), "n"), "numbered")


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Tables (tree, idx, n, digest) from the leaves up; a tree ends where n is 1."""
    levels = [nodes]
    while most > 1:
        run = F.expr(f"idx div {FANOUT}").alias("idx")
        count = F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")
        above = levels[-1].filter("n > 1").select("tree", run, count, F.struct("idx", "digest").alias("node"))
        listed = F.sort_array(F.collect_list("node"))
        levels.append(land(above.groupBy("tree", "idx", "n").agg(F.sha2(F.array_join(F.transform(listed, lambda e: e["digest"]), ""), 256).alias("digest")), "level"))
        most = -(-most // FANOUT)
    return levels


def build(leaves: DataFrame) -> tuple[DataFrame, str | None]:
    """All nodes (tree, level, idx, n, digest) over numbered leaves with ``leaf``, and the root."""
    top = leaves.agg(F.max("n"), F.max("tree")).first()
    if top[0] is None:
        return leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "n", F.col("leaf").alias("digest")), None
    groups = _levels(leaves.select("tree", F.col("pos").alias("idx"), "n", F.col("leaf").alias("digest")), top[0])
    ends = None
    for level in groups:
        of = level.filter("n = 1").select(F.lit(TOP).cast("bigint").alias("tree"), (F.col("tree") - 1).alias("idx"), F.lit(top[1]).cast("bigint").alias("n"), "digest")
        ends = of if ends is None else ends.unionByName(of)
    tops = _levels(land(ends, "subroots"), top[1])
    root = tops[-1].filter("n = 1").first()["digest"]
    named = [level.withColumn("level", F.lit(i)) for levels in (groups, tops) for i, level in enumerate(levels)]
    nodes = named[0]
    for level in named[1:]:
        nodes = nodes.unionByName(level)
    return nodes.select("tree", "level", "idx", "n", "digest"), root


def missing(known: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Least coordinates (level, indices) that complete the paths of the ``known`` leaves of a tree of ``n``."""
    level, known = 0, np.unique(known)
    while n > 1:
        runs = np.unique(known // FANOUT)
        whole = (runs[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        yield level, np.setdiff1d(whole[whole < n], known, assume_unique=True)
        known, n, level = runs, -(-n // FANOUT), level + 1


def _requests(trees: int):
    def ask(block: pd.DataFrame) -> pd.DataFrame:
        out = [(int(tree), level, idx) for tree, own in block.groupby("tree") for level, idx in missing(own["pos"].to_numpy(), int(own["n"].iloc[0]))]
        out += [(TOP, level, idx) for level, idx in missing(block["tree"].to_numpy() - 1, trees)]
        sizes = [len(idx) for *_, idx in out]
        return pd.DataFrame({
            "block": block["block"].iloc[0], "tree": np.repeat([t for t, *_ in out], sizes).astype("int64"),
            "level": np.repeat([lv for _, lv, _ in out], sizes).astype("int32"), "idx": np.concatenate([idx for *_, idx in out] or [np.empty(0)]).astype("int64"),
        })

    return ask


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Paths:
    """Proof tails of the nodes above one tree's known leaves.

    ``up`` is the tree that carries on from this one's root, if any.
    """

    def __init__(self, leaves: dict[int, str], fetched: dict[int, dict[int, str]], n: int, up: Paths | None = None, up_idx: int = 0):
        self.runs: list[dict[int, list[str]]] = []
        self.tails: list[dict[int, str]] = []
        self.up, self.up_idx = up, up_idx
        known, level = leaves, 0
        while n > 1:
            have, runs = {**fetched.get(level, {}), **known}, {}
            for idx in sorted(have):
                runs.setdefault(idx // FANOUT, []).append(have[idx])
            self.runs.append(runs)
            known, n, level = {run: _hash("".join(nodes)) for run, nodes in runs.items()}, -(-n // FANOUT), level + 1
        self.root = known[0] if known else None

    def siblings(self, idx: int) -> Iterator[tuple[str, str]]:
        """Texts before and behind the node of each level, up to the last root."""
        for runs in self.runs:
            nodes, at = runs[idx // FANOUT], idx % FANOUT
            yield "".join(nodes[:at]), "".join(nodes[at + 1 :])
            idx //= FANOUT
        if self.up is not None:
            yield from self.up.siblings(self.up_idx)

    def tail(self, idx: int, level: int = 0) -> str:
        """Siblings of node ``idx`` of ``level`` and of all nodes above it, joined."""
        if not self.tails:
            self.tails = [{} for _ in range(len(self.runs) + 1)]
        if level == len(self.runs):
            if not self.tails[level] and self.up is not None:
                self.tails[level][0] = self.up.tail(self.up_idx)
            return self.tails[level].get(0, "")
        run = idx // FANOUT
        if run not in self.tails[level]:
            self.tails[level][run] = self.tail(run, level + 1)
        nodes, at = self.runs[level][run], idx % FANOUT
        return "".join(nodes[:at]) + "".join(nodes[at + 1 :]) + self.tails[level][run]


def fold(leaf: str, siblings: Iterator[tuple[str, str]]) -> str:
    """Root that a leaf and its siblings lead to."""
    for before, behind in siblings:
        leaf = _hash(before + leaf + behind)
    return leaf


def _expand(trees: int):
    def prove(block: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        fetched: dict[int, dict[int, dict[int, str]]] = {}
        for tree, level, idx, digest in zip(nodes["tree"], nodes["level"], nodes["idx"], nodes["digest"]):
            fetched.setdefault(tree, {}).setdefault(level, {})[idx] = digest
        own = {int(tree): part for tree, part in block.groupby("tree")}
        paths = {t: Paths(dict(zip(p["pos"], p["leaf"])), fetched.get(t, {}), int(p["n"].iloc[0])) for t, p in own.items()}
        top = Paths({t - 1: p.root for t, p in paths.items()}, fetched.get(TOP, {}), trees)
        for t, p in paths.items():
            p.up, p.up_idx = top, t - 1
        subroot, proof, folded = [], [], []
        for tree, pos, leaf, shown in zip(block["tree"], block["pos"], block["leaf"], block["shown"]):
            path = paths[tree]
            subroot.append(path.root)
            proof.append(_hash(path.tail(pos)))
            folded.append(fold(shown, path.siblings(pos)))
        return block[["key", "leaf"]].assign(subroot=subroot, proof_sha256=proof, folded_root=folded)

    return prove


def prove(leaves: DataFrame, nodes: DataFrame, root: str | None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Proof of every row of ``leaves`` (numbered; any part of the manifest's leaves) against ``root``.

    ``leaf`` is the manifest's digest and ``shown`` the digest now presented.
    Returns (key, leaf, subroot, root, proof_sha256, folded_root, verified).
    """
    kind = dict(leaves.dtypes)["key"]
    trees = nodes.filter(F.col("tree") == TOP).agg(F.max("n")).first()[0] or 0
    blocks = leaves.withColumn("block", F.expr(f"ordinal div {block_rows}"))
    asked = land(blocks.select("block", "tree", "pos", "n").groupBy("block").applyInPandas(_requests(trees), "block long, tree long, level int, idx long"), "asked")
    fetched = asked.join(nodes.drop("n"), ["tree", "level", "idx"])
    own = blocks.select("block", "tree", "pos", "n", "leaf", "shown", F.col("key").cast("string")).groupBy("block")
    proved = own.cogroup(fetched.groupBy("block")).applyInPandas(_expand(trees), "key string, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proved.select(
        F.col("key").cast(kind), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"),
    )
