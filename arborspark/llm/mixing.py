"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, of all those that meet its source's token target
the one closest in entropy to 1.  With the token target alone
(``tilted``) that is min(cap, exp(multiplier x size)): the constraint acts on
documents, so long ones are tilted most.  With listed ``features`` (``rates``)
the token-weighted means of these are kept as well and the rate is
min(cap, exp(multiplier . x)), x = (1, features).  The convex dual is solved by
Newton steps: Spark sums gradient and Hessian over all documents, each source
takes its own step.  Rates become copies by systematic rounding over documents
sorted by size, which keeps a source within about half its largest document of
its target, and a few single-copy repairs close what remains.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborspark.llm.lookup import lookup
from arborspark.operators.ordering import prefix_sums
from arborspark.session import land

SCALE = 1 << 24
REPAIRS = 3


def token_targets(sources: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Add ``g`` (rank of the source) and ``target`` to (source, source_size).

    Sources by code point, null last, take ``weights`` in turn and share all
    tokens by weight; a target stops at ``cap`` times its source, the excess
    is shared again among the others until none is above.
    """
    ranked = prefix_sums(sources.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"], {"g": F.lit(1).cast("long")})
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = land(ranked.select("source", "source_size", "g", F.get(cycle, ((F.col("g") - 1) % len(weights)).cast("int")).alias("_w")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, closed = 0.0, -1
    while True:
        full = F.col("_w") * F.lit(level) > F.col("source_size") * float(cap)
        held, weight, count = ranked.agg(F.sum(F.when(full, F.col("source_size") * float(cap))), F.sum(F.when(~full, F.col("_w"))), F.count(F.when(full, 1))).first()
        if count == closed or not weight:
            break
        closed, level = count, (total - (held or 0.0)) / weight
    return ranked.select("source", "source_size", "g", F.least(F.col("_w") * F.lit(level), F.col("source_size") * float(cap)).alias("target"))


def _step(width: int, tolerance: float):
    upper = [(i, j) for i in range(width) for j in range(i, width)]

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                grad = np.array([getattr(row, f"g{i}") for i in range(width)], dtype=float) - np.array(row.wanted, dtype=float)
                hess = np.zeros((width, width))
                for i, j in upper:
                    hess[i, j] = hess[j, i] = getattr(row, f"h{i}_{j}")
                at = np.array(row.multiplier, dtype=float)
                off = float(np.abs(grad).max() / max(1.0, abs(row.wanted[0])))
                if off > tolerance:
                    move = np.linalg.lstsq(hess, -grad, rcond=None)[0] if hess[0, 0] > 0 else np.where(np.arange(width) == 0, -np.sign(grad) * 0.5, 0.0)
                    at = at + np.clip(move, -2.0, 2.0)
                out.append((row.g, at.tolist(), list(map(float, row.wanted)), off))
            yield pd.DataFrame(out, columns=["g", "multiplier", "wanted", "off"])

    return solve


def rates(docs: DataFrame, targets: DataFrame, cap: float, features: Sequence[str] = (), tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """``docs`` (g, size, features) plus ``rate``: the entropy-balanced rate of each document.

    Newton stops when every source is within ``tolerance`` of its target, or
    after ``rounds`` steps.
    """
    x = [F.lit(1.0), *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]]
    size = F.col("size").cast("double")
    # a start at the uniform rate of each source: already the solution where no feature and no cap binds
    means = docs.groupBy("g").agg(F.sum(size).alias("_all"), *[F.coalesce(F.sum(size * v) / F.nullif(F.sum(size), F.lit(0.0)), F.lit(0.0)).alias(f"m{i}") for i, v in enumerate(x) if i])
    state = means.join(targets.select("g", "target"), "g").select(
        "g", F.array(F.when((F.col("target") > 0) & (F.col("_all") > 0), F.log(F.col("target") / F.col("_all"))).otherwise(0.0), *[F.lit(0.0)] * (len(x) - 1)).alias("multiplier"), F.array(F.col("target"), *[F.col("target") * F.col(f"m{i}") for i in range(1, len(x))]).alias("wanted")
    )
    state = land(state, "dual")
    for _ in range(rounds):
        held = lookup(docs, state, ["g"])
        power = sum((F.col("multiplier")[i] * v for i, v in enumerate(x)), F.lit(0.0))
        r = F.least(F.lit(float(cap)), F.exp(power))
        free = F.when(F.exp(power) < float(cap), F.exp(power)).otherwise(0.0)
        sums = [F.sum(size * r * v).alias(f"g{i}") for i, v in enumerate(x)]
        sums += [F.sum(size * free * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
        found = held.groupBy("g").agg(*sums).join(state, "g")
        moved = land(found.mapInPandas(_step(len(x), tolerance), "g long, multiplier array<double>, wanted array<double>, off double"), "dual")
        state = moved.drop("off")
        if (moved.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    held = lookup(docs, state, ["g"])
    power = sum((F.col("multiplier")[i] * v for i, v in enumerate(x)), F.lit(0.0))
    return held.withColumn("rate", F.least(F.lit(float(cap)), F.exp(power))).drop("multiplier", "wanted")


def tilted(docs: DataFrame, targets: DataFrame, cap: float, tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """``docs`` (g, size) plus ``rate``: the rates nearest to one, by entropy over documents, that meet the token target.

    Under the constraint sum(rate x size) = target the dual has one multiplier a
    source, and a document's rate is exp(multiplier x size), at most ``cap``.
    The multipliers of all sources take Newton steps at once, one aggregate over
    the documents a round; a step that leaves the bracket known so far is
    replaced by its middle.  Sizes count in units of their source's mean.
    """
    size = F.col("size").cast("double")
    means = docs.groupBy("g").agg(F.sum(size).alias("_all"), F.avg(size).alias("scale"))
    top = F.log(F.lit(float(cap))) * F.col("scale")  # every document of one word or more at the cap
    capped = F.col("target") >= F.col("_all") * (float(cap) * (1 - 1e-12))
    state = means.join(targets.select("g", "target"), "g").select(
        "g", "target", F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0).alias("scale"), F.when(capped & (F.col("_all") > 0), top).otherwise(0.0).alias("at"),
        F.lit(None).cast("double").alias("low"), top.alias("high"),
    )
    state = land(state, "dual")

    def rate() -> tuple[Column, Column]:
        power = F.col("at") * size / F.col("scale")
        return power, F.when(power < F.log(F.lit(float(cap))), F.exp(power)).otherwise(float(cap))

    for _ in range(rounds):
        held = lookup(docs.filter("size > 0").groupBy("g", "size").agg(F.count(F.lit(1)).alias("c")), state, ["g"])
        power, r = rate()
        words = F.col("c") * size * r
        slope = F.when(power < F.log(F.lit(float(cap))), words * size / F.col("scale")).otherwise(0.0)
        found = state.join(held.groupBy("g").agg(F.sum(words).alias("got"), F.sum(slope).alias("slope")), "g", "left").fillna(0.0, ["got", "slope"])
        gap = F.col("target") - F.col("got")
        off = F.when(F.col("got") > 0, F.abs(gap) / F.greatest(F.lit(1.0), F.col("target"))).otherwise(0.0)
        low, high = F.when(gap > 0, F.col("at")).otherwise(F.col("low")), F.when(gap < 0, F.col("at")).otherwise(F.col("high"))
        newton = F.col("at") + gap / F.nullif(F.col("slope"), F.lit(0.0))
        fits = newton.isNotNull() & (F.coalesce(newton > low, F.lit(True))) & (newton < high)
        between = F.when(low.isNull(), 2 * F.col("at") - 1).otherwise((low + high) / 2)
        moved = found.select("g", "target", "scale", off.alias("off"), F.when(off <= tolerance, F.col("at")).when(fits, newton).otherwise(between).alias("at"), low.alias("low"), high.alias("high"))
        moved = land(moved, "dual")
        state = moved.drop("off")
        if (moved.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    # nine digits, so that the order in which sums were added can't show in the copies
    return lookup(docs, state.select("g", F.round("at", 9).alias("at"), "scale"), ["g"]).withColumn("rate", rate()[1]).drop("at", "scale")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3, features: Sequence[str] = ()) -> DataFrame:
    """Copies of every document: (doc_id, source, size, source_size, target, copies, taken).

    ``docs`` has doc_id, source and size (a null size is 0); one row comes back
    per row, repeated rows are documents of their own, other columns are not
    read.  A source without tokens has target 0 and its documents rate 1.
    Copies are a function of the rows alone, so reruns agree; none exceeds
    ``cap``.
    """
    base = land(docs.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"), *features, F.monotonically_increasing_id().alias("_row")), "sizes")
    targets = land(token_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "targets")
    placed = lookup(base, targets.select("source", "g"), ["source"])
    rated = (rates(placed, targets, cap, features) if features else tilted(placed, targets, cap)).select("doc_id", "source", "size", "g", "_row", F.round(F.col("rate") * SCALE).cast("long").alias("_rate"), (-F.col("size")).alias("_down"), F.xxhash64("doc_id").alias("_mixed"))
    run = prefix_sums(rated, ["g"], ["_down", "_mixed", "doc_id", "_row"], {"_upto": F.col("_rate")})
    slot = lambda c: F.floor((c + SCALE // 2) / SCALE)
    cut = land(run.select("doc_id", "source", "size", "g", "_row", "_mixed", (slot(F.col("_upto")) - slot(F.col("_upto") - F.col("_rate"))).alias("copies")), "copies")
    taken = cut.groupBy("g").agg(F.sum(F.col("copies") * F.col("size")).alias("_got"))
    gap = land(targets.join(taken, "g").select("g", (F.col("target") - F.col("_got")).alias("gap")), "gap")
    moves = None
    for _ in range(REPAIRS):
        now = cut if moves is None else lookup(cut, moves, ["_row"]).withColumn("copies", F.col("copies") + F.coalesce("_delta", F.lit(0))).drop("_delta")
        near = lookup(now, gap, ["g"]).filter("size > 0").filter(((F.col("gap") > 0) & (F.col("copies") < cap)) | ((F.col("gap") < 0) & (F.col("copies") > 0)))
        miss = F.abs(F.abs("gap") - F.col("size"))
        best = near.filter(miss < F.abs("gap")).groupBy("g").agg(F.min(F.struct(miss.alias("miss"), "_mixed", "doc_id", "_row", "size", F.signum("gap").cast("long").alias("d"))).alias("b"))
        step = land(best.select("g", "b._row", F.col("b.d").alias("_delta"), (F.col("b.d") * F.col("b.size")).alias("_words")), "repair")
        if step.isEmpty():
            break
        gap = land(gap.join(step.select("g", "_words"), "g", "left").select("g", (F.col("gap") - F.coalesce("_words", F.lit(0))).alias("gap")), "gap")
        fresh = step.select("_row", "_delta")
        moves = fresh if moves is None else moves.union(fresh)
        moves = land(moves.groupBy("_row").agg(F.sum("_delta").alias("_delta")), "moves")
    done = cut if moves is None else lookup(cut, moves, ["_row"]).withColumn("copies", F.col("copies") + F.coalesce("_delta", F.lit(0)))
    out = lookup(done, targets.select("g", "source_size", "target"), ["g"])
    return out.select("doc_id", "source", "size", "source_size", "target", F.col("copies").cast("long").alias("copies"), (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def word_count(text: str) -> Column:
    """Number of words of a text column; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
