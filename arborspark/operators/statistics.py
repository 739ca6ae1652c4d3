"""Rank tests, correlations and permutation tests over feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborspark.functions import stats
from arborspark.operators import ordering
from arborspark.schema import NEUROPIL_ORDER
from arborspark.session import land


def _ranked(counted: DataFrame, rows: int | None) -> DataFrame:
    """Value table with average ranks; ``c`` is the multiplicity of the value."""
    ran = ordering.running(counted, [], ["v"], {"_cum": F.col("c")}, rows)
    return ran.withColumn("rank", F.col("_cum") - (F.col("c") - 1) / 2)


def mann_whitney(df: DataFrame, value: str, in_first: Column, in_second: Column, rows: int | None = None) -> DataFrame:
    """U of the first sample, rank-biserial correlation and two-sided p."""
    v = F.col(value).cast("double")
    counted = (
        df.filter((in_first | in_second) & v.isNotNull() & ~F.isnan(v))
        .groupBy(v.alias("v"))
        .agg(F.count_if(in_first).alias("c1"), F.count_if(in_second).alias("c2"))
        .withColumn("c", F.col("c1") + F.col("c2"))
    )
    t = F.col("c").cast("double")
    agg = _ranked(counted, rows).agg(
        F.sum("c1").alias("n1"), F.sum("c2").alias("n2"), F.sum(F.col("c1") * F.col("rank")).alias("_r1"), F.sum(t * t * t - t).alias("tie_term")
    )
    u = F.col("_r1") - F.col("n1") * (F.col("n1") + 1) / 2
    return agg.withColumn("u", u).select(
        "n1", "n2", "u", (2 * F.col("u") / (F.col("n1") * F.col("n2")) - 1).alias("rank_biserial"),
        stats.rank_sum_p_col("n1", "n2", "u", "tie_term").alias("p_value"),
    )


def signed_rank(pairs: DataFrame, first: str, second: str, rows: int | None = None) -> DataFrame:
    """Wilcoxon signed-rank sums of second - first, matched-pairs rank-biserial r and p."""
    d = F.col(second).cast("double") - F.col(first).cast("double")
    diffs = pairs.select(d.alias("d")).filter(F.col("d").isNotNull() & ~F.isnan("d"))
    n_pairs = diffs.agg(F.count(F.lit(1)).alias("n_pairs"))
    counted = (
        diffs.filter("d <> 0")
        .groupBy(F.abs("d").alias("v"))
        .agg(F.count_if(F.col("d") > 0).alias("cp"), F.count_if(F.col("d") < 0).alias("cm"))
        .withColumn("c", F.col("cp") + F.col("cm"))
    )
    t = F.col("c").cast("double")
    z = lambda e: F.coalesce(F.sum(e), F.lit(0.0))
    agg = _ranked(counted, rows).agg(
        F.coalesce(F.sum("c"), F.lit(0).cast("bigint")).alias("n"),
        z(F.col("cp") * F.col("rank")).alias("w_plus"), z(F.col("cm") * F.col("rank")).alias("w_minus"), z(t * t * t - t).alias("tie_term"),
    )
    total = F.col("w_plus") + F.col("w_minus")
    return n_pairs.crossJoin(F.broadcast(agg)).select(  # one row each
        "n_pairs", "n", "w_plus", "w_minus", F.least("w_plus", "w_minus").alias("w"),
        F.when(total > 0, (F.col("w_plus") - F.col("w_minus")) / total).otherwise(0.0).alias("rank_biserial"),
        stats.signed_rank_p_col("n", "w_plus", "w_minus", "tie_term", F.col("n_pairs") - F.col("n")).alias("p_value"),
    )


def bonferroni(p: Column, tests: int) -> Column:
    return F.least(p * tests, F.lit(1.0))


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("ns")


def spearman(df: DataFrame, x: str, y: str, key: str, rows: int | None = None) -> DataFrame:
    """Spearman correlation per key, from the table of distinct value pairs."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    ok = fx.isNotNull() & fy.isNotNull() & ~F.isnan(fx) & ~F.isnan(fy)
    both = land(df.filter(ok).groupBy(key, fx.alias("_x"), fy.alias("_y")).agg(F.count(F.lit(1)).alias("c")), "pairs")
    rows = both.count() if rows is None else rows

    def ranks(v: str, name: str) -> DataFrame:
        counted = both.groupBy(key, v).agg(F.sum("c").alias("n"))
        ran = ordering.running(counted, [key], [v], {"_cum": F.col("n")}, rows)
        return ran.select(key, v, (F.col("_cum") - (F.col("n") - 1) / 2).alias(name))

    met = both.join(ranks("_x", "rx"), [key, "_x"]).join(ranks("_y", "ry"), [key, "_y"])
    c, rx, ry = F.col("c"), F.col("rx"), F.col("ry")
    # ranks average (n + 1) / 2 exactly, so centred sums need one more pass only
    size = both.groupBy(key).agg(F.sum("c").alias("n"))
    met = met.join(size, key)
    mid = (F.col("n") + 1) / 2
    agg = met.groupBy(key).agg(
        F.sum("c").alias("n"), F.sum(c * (rx - mid) * (ry - mid)).alias("xy"),
        F.sum(c * (rx - mid) * (rx - mid)).alias("xx"), F.sum(c * (ry - mid) * (ry - mid)).alias("yy"),
    )
    rho = F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))
    return agg.withColumn("rho", rho).select(key, "n", "rho", stats.correlation_p_col("n", F.coalesce("rho", F.lit(0.0))).alias("p_value"))


def change_summary(df: DataFrame, before: str, after: str, rows: int | None = None) -> DataFrame:
    """Mean and median absolute change and the number of rises and falls."""
    d = df.select((F.col(after) - F.col(before)).alias("d")).withColumn("a", F.abs("d"))
    base = d.agg(
        F.count("d").alias("n"), F.avg("a").alias("mean_abs_change"), F.count_if(F.col("d") > 0).alias("rises"), F.count_if(F.col("d") < 0).alias("falls")
    )
    return base.crossJoin(F.broadcast(ordering.quantiles(d, [], "a", {"median_abs_change": 0.5}, rows)))  # one row each


# ------------------------------------------------------------- permutation

# Numbers of draws and seeds.
DRAWS = 10_000
SIGN_SEED = 0
LABEL_SEED = 42


def _draw_key(seed: int, draw: str, name: str) -> Column:
    """Hash that decides what draw number ``draw`` does with row ``name``; the same in every engine with MD5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(draw).cast("string"), F.col(name)))


def _draws(draws: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")


def _at_least(null: Column, observed: Column, draws: int) -> Column:
    """Share of draws that reach the observed value, the observed one counted as a draw."""
    return (F.count_if(F.round(null, 9) >= F.round(observed, 9)) + 1) / (F.lit(draws) + 1)


def sign_permutation(metrics: DataFrame, value: str = "delta_post_minus_pre", draws: int = DRAWS, seed: int = SIGN_SEED) -> DataFrame:
    """Sign-flip test of the mean difference over the regions of the dictionary.

    Every draw is a row group of its own: a region's sign in a draw is the top
    bit of a hash of seed, draw and region, so draws spread over tasks and any
    of them can be recomputed alone.  Means count as equal to nine digits.
    """
    rows = metrics.filter(F.col("neuropil").isin(*NEUROPIL_ORDER) & F.col(value).isNotNull()).select("neuropil", F.col(value).alias("value"))
    flipped = F.when(_draw_key(seed, "draw", "neuropil") < "8", F.col("value")).otherwise(-F.col("value"))
    per_draw = rows.select("*", _draws(draws)).groupBy("draw").agg(F.avg(flipped).alias("null"), F.avg("value").alias("observed"), F.count("value").alias("n"))
    return per_draw.agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("observed").alias("mean_delta"),
        F.when(F.count(F.lit(1)) > 0, _at_least(F.abs("null"), F.abs("observed"), draws)).alias("permutation_p"),
    )


def label_permutation(pairs: DataFrame, draws: int = DRAWS, seed: int = LABEL_SEED) -> DataFrame:
    """Is the same-region similarity higher than under shuffled region labels?

    In each draw the regions in order of name meet the regions in order of a
    hash of seed, draw and name: one row per draw and region, joined with the
    similarities.  ``pairs`` has every pair of the regions.
    """
    names = pairs.filter("same_region").select(F.col("pre_region").alias("name"), F.col("similarity").alias("own"))
    shuffled = names.select("*", _draws(draws)).withColumn("key", _draw_key(seed, "draw", "name")).groupBy("draw").agg(
        F.array_sort(F.collect_list("name")).alias("pre"), F.array_sort(F.collect_list(F.struct("key", "name"))).alias("post"), F.avg("own").alias("observed"), F.count("own").alias("n"),
    )
    met = shuffled.select("draw", "observed", "n", F.inline(F.arrays_zip("pre", "post"))).select("draw", "observed", "n", F.col("pre").alias("pre_region"), F.col("post.name").alias("post_region"))
    per_draw = met.join(pairs.select("pre_region", "post_region", "similarity"), ["pre_region", "post_region"]).groupBy("draw").agg(
        F.avg("similarity").alias("null"), F.first("observed").alias("observed"), F.first("n").alias("n"),
    )
    return per_draw.agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n_regions"), F.max("observed").alias("mean_same"),
        F.when(F.count(F.lit(1)) > 0, _at_least(F.col("null"), F.col("observed"), draws)).alias("permutation_p"),
    )


def pooled_asymmetry(metrics: DataFrame, draws: int = DRAWS, seed: int = SIGN_SEED) -> DataFrame:
    """Mean shift of the branch order with its permutation and signed-rank tests."""
    signed = signed_rank(metrics.filter(F.col("neuropil").isin(*NEUROPIL_ORDER)), "pre_mean_order", "post_mean_order")
    signed = signed.select(F.col("w").alias("wilcoxon_w"), F.col("p_value").alias("wilcoxon_p"))
    return sign_permutation(metrics, draws=draws, seed=seed).crossJoin(F.broadcast(signed))  # one row each


def same_or_different(pairs: DataFrame) -> DataFrame:
    """Similarity of same-region pairs against that of different regions: rank-sum test, means and medians."""
    rounded = pairs.withColumn("similarity", F.round("similarity", 9))
    test = mann_whitney(rounded, "similarity", F.col("same_region"), ~F.col("same_region"))
    middle = F.when(F.col("same_region"), "same").otherwise("different").alias("side")
    sides = rounded.select(middle, "similarity")
    medians = ordering.quantiles(sides, ["side"], "similarity", {"median": 0.5}).join(sides.groupBy("side").agg(F.avg("similarity").alias("mean")), "side")
    pick = lambda side, of: F.max(F.when(F.col("side") == side, F.col(of))).alias(f"{side}_{of}")
    told = medians.agg(*[pick(side, of) for side in ("same", "different") for of in ("median", "mean")])
    return test.crossJoin(F.broadcast(told))  # one row each
