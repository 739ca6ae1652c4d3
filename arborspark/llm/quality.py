"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule rejects documents whose measure exceeds a cutoff.  Cutoffs are chosen
on labelled documents per stratum from a fixed grid: exact binomial tails bound
the false rejections of every cutoff, with the error probability ``delta``
shared among all tests made, and the bounds of a stratum's rules add up to at
most ``risk``.  A rule that rejects no bad document, and a stratum without
enough evidence, gets no cutoff.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborspark.llm.lookup import lookup
from arborspark.session import land

_WORD = r"[^\x20\x09-\x0D]"

#: Cutoffs tried; every measure is a share, larger is worse, so one grid serves all.
GRID = tuple(round(0.1 + 0.04 * i, 2) for i in range(23))
RISK, DELTA = 0.02, 0.05
#: Parts of the risk at which a cutoff is tested.
LEVELS = 5


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the counts of every whole text.

    n_words, word_chars (code points in words), n_symbols (characters
    ``#*$%&|<>``), n_dup_lines (lines with a word that equal an earlier line),
    n_repeat_words (words inside 5-word windows found twice or more), n_lines
    (lines with a word) and n_upper (A-Z).  A null text counts as empty;
    columns of the result names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(_WORD))
    kept = [c for c in docs.columns if c not in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")]
    one = docs.select(*kept, words.alias("_w"), lines.alias("_l"), F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), F.regexp_count(whole, F.lit("[A-Z]")).cast("long").alias("n_upper"))
    # the hash of each 5-word window, in order
    n = F.size("_w")
    windows = F.when(n >= 5, F.transform(F.sequence(F.lit(1), n - 4), lambda i: F.xxhash64(F.slice("_w", i, 5)))).otherwise(F.array().cast("array<bigint>"))
    two = one.select(*kept, "n_symbols", "n_upper", n.cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                     F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), windows.alias("_h"))
    # places of windows by hash; only texts with a repeated window are sorted
    pairs = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    three = two.select(*[c for c in two.columns if c != "_h"], pairs.alias("_p"))
    m = F.size("_p")
    twin = F.filter("_p", lambda x, k: ((k > 0) & (F.get("_p", k - 1)["h"] == x["h"])) | ((k < m - 1) & (F.get("_p", k + 1)["h"] == x["h"])))
    four = three.select(*[c for c in three.columns if c != "_p"], F.sort_array(F.transform(twin, lambda x: x["i"])).alias("_i"))
    covered = F.aggregate("_i", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last")), lambda s, i: F.struct((s["n"] + F.least(F.lit(5), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"])
    return four.select(*[c for c in four.columns if c != "_i"], covered.alias("n_repeat_words"))


def shares() -> dict[str, Column]:
    """The rules' measures as shares of the text, from the columns of ``measure``."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeats": F.col("n_repeat_words") / words,
        "short_words": F.when(F.col("n_words") > 0, F.greatest(F.lit(0.0), 1 - F.col("word_chars") / words / 3)).otherwise(0.0),
        "upper": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p): exact, summed in logarithms; for k < n p a bound needs no more."""
    ratio = F.lit(p / (1 - p))
    start = F.struct((n * F.log1p(F.lit(-p))).alias("term"), (n * F.log1p(F.lit(-p))).alias("sum"))

    def add(s, i):
        term = s["term"] + F.log((n - i + 1) / i * ratio)
        high, low = F.greatest(s["sum"], term), F.least(s["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.exp(F.aggregate(steps, start, add, lambda s: s["sum"]))


def cutoffs(labelled: DataFrame, stratum: str, rules: Sequence[str], grid: Sequence[float] = GRID, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff): the rules' cutoffs, which together reject at most ``risk`` of a stratum's good documents.

    ``labelled`` has the stratum, one share per rule and ``good`` (boolean);
    good documents are the holdout on which false rejections are counted, the
    others show what a cutoff is worth.  For each rule and stratum the grid is
    counted in one pass.  Every (stratum, rule, cutoff, level) is one exact
    binomial test, levels being parts of the risk, and the lowest level passed
    bounds the cutoff's false rejections; with Bonferroni's correction over all
    tests the bounds hold together, so any choice whose bounds add up to the
    risk is safe.  A rule takes the loosest cutoff that rejects as many bad
    documents as its smallest safe one, and none if that rejects none; rules
    are taken by bad documents rejected while their bounds fit into the risk.
    k above a level's share of n can never pass, so its tail is not summed.
    """
    step = F.array(*[F.lit(float(g)) for g in grid])
    # how many grid points lie below a share: it is rejected by those
    above = lambda r: F.size(F.filter(step, lambda g: F.col(r) > g))
    held = labelled.select(stratum, "good", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), above(r).alias("over")) for r in rules])).alias("_m")).select(stratum, "good", "_m.*")
    counted = held.groupBy(stratum, "rule", "over").agg(F.count_if("good").alias("c"), F.count_if(~F.col("good")).alias("d"))
    at = land(counted.groupBy(stratum, "rule").agg(F.sum("c").alias("n"), F.collect_list(F.struct("over", "c", "d")).alias("_cs")), "counted")  # at most one entry per grid point
    tests = at.select(stratum).distinct().count() * len(rules) * len(grid) * LEVELS
    zero = F.lit(0).cast("long")
    beyond = lambda c, i: F.aggregate("_cs", zero, lambda s, e: s + F.when(e["over"] > i, e[c]).otherwise(zero))
    spread = at.select(stratum, "rule", "n", F.explode(F.transform(step, lambda g, i: F.struct(g.alias("cutoff"), beyond("c", i).alias("k"), beyond("d", i).alias("bad")))).alias("_g"))
    spread = spread.select(stratum, "rule", "n", "_g.cutoff", "_g.k", "_g.bad")
    level = F.lit(None).cast("int")
    for i in range(LEVELS, 0, -1):
        p = risk * i / LEVELS
        passed = F.when(F.col("k") < F.col("n") * p, binomial_tail(F.col("k"), F.col("n"), p) <= delta / max(tests, 1)).otherwise(False)
        level = F.when(passed, F.lit(i)).otherwise(level)
    safe = spread.withColumn("level", level).filter("level is not null and bad > 0")
    rule = safe.groupBy(stratum, "rule").agg(F.max(F.struct("bad", "cutoff", (-F.col("level")).alias("less"))).alias("_best"))
    fits = Window.partitionBy(stratum).orderBy(F.desc("_best.bad"), F.desc("_best.less"), "rule").rowsBetween(Window.unboundedPreceding, 0)
    return rule.withColumn("_spent", F.sum(-F.col("_best.less")).over(fits)).filter(F.col("_spent") <= LEVELS).select(stratum, "rule", F.col("_best.cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", grid: Sequence[float] = GRID, risk: float = RISK, delta: float = DELTA, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` (without its text unless ``keep_text``) plus the counts of ``measure``, base_failed, failed_rules and kept.

    ``labels`` (doc_id, quality) marks good documents with quality 1; a
    document labelled twice counts as good only if all its labels say so, other
    and null labels are not used.  base_failed: fewer than 10 words, or more
    than a fifth of the words in repeated windows.  kept: not base_failed and
    no share above its stratum's cutoff.  All rules
    together falsely reject at most ``risk`` of a stratum, with confidence 1 -
    ``delta`` over all strata.  A null stratum is one of
    its own; repeated rows are judged each.
    """
    measured = land(measure(docs, text) if keep_text else measure(docs, text).drop(text), "measured")
    shared = shares()
    scored = measured.select("*", *[v.alias(f"_{r}") for r, v in shared.items()])
    marks = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    holdout = scored.filter(~F.col("base_failed")).select("doc_id", F.col(stratum).alias("_stratum"), *[F.col(f"_{r}").alias(r) for r in shared]).join(marks, "doc_id").withColumn("good", F.col("_q") == 1)
    found = cutoffs(holdout, "_stratum", list(shared), grid, risk, delta)
    table = land(found.groupBy("_stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut")), "cutoffs")
    placed = lookup(scored.withColumn("_stratum", F.col(stratum)), table, ["_stratum"])
    over = F.filter(F.array(*[F.when(F.col(f"_{r}") > F.col("_cut")[r], F.lit(r)) for r in shared]), lambda x: x.isNotNull())
    out = placed.withColumn("failed_rules", over)
    kept = ~F.col("base_failed") & (F.size("failed_rules") == 0)
    return out.withColumn("kept", kept).drop("_cut", "_stratum", *[f"_{r}" for r in shared])
