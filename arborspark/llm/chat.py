"""Chat formatting of reply trees.

A reply tree is a table of messages that name their parents.  Iterative
self-joins double the distance that every message sees towards its root
(pointer doubling), so the number of joins is the logarithm of the depth and
every table keeps one small row per message.  The doubled scores rank the
branches; only chosen branches are spread out into their messages, again one
bit of the distance at a time, and each becomes one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborspark.session import land

OPEN, MID, CLOSE = "<s>[INST]", "[/INST]", "</s>"
# openers and bodies of the control strings <s> </s> [INST] [/INST]; an escape is a backslash after the opener
_HIDE = r"([<\[])(\\*)(/?s>|/?INST\])"
_SHOW = r"([<\[])\\(\\*)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _HIDE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _SHOW, "$1$2$3")


def jumps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestors at distance 1, 2, 4, ... and (tree, node, depth, score up to the root).

    ``messages`` has tree, node, parent (null at a root) and score; nodes are
    unique in a tree.  A parent that does not exist makes its child a root.
    Messages on a cycle of parents have no root: they are left out.
    """
    known = messages.select("tree", F.col("node").alias("parent"), F.lit(True).alias("_known"))
    up = messages.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("_known"), F.col("parent")).alias("anc"), F.lit(1).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("total")
    )
    levels, up = [], land(up, "up")
    total = up.count()
    while True:
        levels.append(up.select("tree", "node", "anc").filter("anc is not null"))
        if up.filter("anc is not null").isEmpty() or 2 ** len(levels) > 2 * total:  # beyond every depth only cycles are left
            break
        far = up.select("tree", F.col("node").alias("anc"), F.col("anc").alias("_anc"), F.col("depth").alias("_depth"), F.col("total").alias("_total"))
        # messages that have met their root are carried on, not joined again
        still = up.filter("anc is not null").join(far, ["tree", "anc"], "left").select(
            "tree", "node", F.col("_anc").alias("anc"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), (F.col("total") + F.coalesce("_total", F.lit(0.0))).alias("total")
        )
        up = land(still.union(up.filter("anc is null").select("tree", "node", "anc", "depth", "total")), "up")
    return levels[:-1], up.filter("anc is null").select("tree", "node", "depth", "total")


def branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """Messages of the chosen branches: (tree, leaf, rank, node, place).

    A branch is the path from the root to a message without replies.  Branches
    of a tree rank by the sum of their scores (a null score is 0), ties by the
    smaller leaf; the ``best`` first are kept (None: all).  ``place`` counts
    from 1 at the root.
    """
    levels, reach = jumps(messages)
    replied = messages.filter("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = reach.join(replied, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "depth", "total")
    ranked = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "leaf")))
    chosen = ranked if best is None else ranked.filter(F.col("rank") <= best)
    paths = land(chosen.select("tree", "leaf", "rank", F.col("leaf").alias("node"), F.col("depth").alias("place")), "paths")
    for bit in range(len(levels) - 1, -1, -1):
        # every message found so far adds the one 2**bit above it
        above = paths.join(levels[bit], ["tree", "node"]).select("tree", "leaf", "rank", F.col("anc").alias("node"), (F.col("place") - (1 << bit)).alias("place"))
        paths = land(paths.union(above), "paths")
    return paths


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One conversation per (tree, leaf): formatted text and the spans under the loss mask.

    Each turn reads ``<s>[INST]role[/INST]text</s>``; control strings inside a
    role or text get a backslash.  ``loss_spans`` lists (start, length) in code
    points of every assistant text.  A null role or text counts as empty.  A
    conversation is one row and has to fit one, as any string column.
    """
    turn = paths.join(messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")), ["tree", "node"])
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID))
    body = escape(F.col("text"))
    turn = turn.select("tree", "leaf", "rank", "place", "role", head.alias("_head"), body.alias("_body"))
    upto = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.length("_head") + F.length("_body") + len(CLOSE)
    turn = turn.withColumn("_at", F.coalesce(F.sum(whole).over(upto), F.lit(0)) + F.length("_head"))
    part = F.struct("place", F.concat("_head", "_body", F.lit(CLOSE)).alias("text"), (F.col("role") == "assistant").alias("loss"), F.col("_at").cast("int").alias("start"), F.length("_body").alias("length"))
    found = turn.groupBy("tree", "leaf").agg(F.first("rank").alias("rank"), F.sort_array(F.collect_list(part)).alias("_parts"))
    spans = F.transform(F.filter("_parts", lambda p: p["loss"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))
    return found.select("tree", "leaf", "rank", F.array_join(F.col("_parts.text"), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    turns = F.filter(F.split(formatted, CLOSE), lambda t: t.startswith(OPEN))
    head = len(OPEN)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring(F.substring_index(t, MID, 1), head + 1, 1 << 30)).alias("role"),
            unescape(F.substring(t, F.instr(t, MID) + len(MID), F.length(t))).alias("text"),
        ),
    )


def masked(formatted: Column, spans: Column) -> Column:
    """Text under the loss mask, unescaped, joined without anything between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def linear(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as reply trees without side branches.

    The reply to a turn is the next row of the conversation by turn, role and
    text, rows without a turn first; repeated rows stay separate messages.  Rows
    without conv_id belong to no conversation and are left out.
    """
    rows = conversations.filter("conv_id is not null").select("conv_id", "turn", "role", "text")
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())).cast("long")
    return rows.select(F.col("conv_id").alias("tree"), at.alias("node"), F.when(at > 1, at - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text")
