"""Near-duplicate embeddings: iterative quantisation, Hamming tables and an exact rerank.

Rotations are learnt on a bounded sample so that the signs of a rotated vector
are balanced bits that keep angles.  The bits are cut into tables of ``bits``
bits each; vectors that agree in any table meet.  Longer keys agree less often,
so the number of tables follows from the bits: rotations are added until pairs
planted at the threshold meet as often as stated.  Buckets of any size are cut
into blocks and block pairs, so no task sees more than two blocks, and every
pair is judged in the first table where it meets by the cosine of the original
vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborspark.llm import graph
from arborspark.session import land

BLOCK = 256
PAIRS = 1 << 16
#: Keys are shortened rather than cut into more tables than this.
MAX_TABLES = 256


def train(sample: np.ndarray, rotations: int, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, matrix of ``rotations`` stacked ITQ projections) of unit rows.

    Principal axes first, then alternately the signs and the rotation that
    brings the data nearest to them.
    """
    mean = sample.mean(axis=0)
    centred = sample - mean
    width = sample.shape[1]
    axes = np.linalg.svd(centred, full_matrices=True)[2][:width].T if len(sample) else np.eye(width)
    base, draw, found = centred @ axes, np.random.default_rng(seed), []
    for _ in range(rotations):
        turn = np.linalg.qr(draw.normal(size=(width, width)))[0]
        for _ in range(rounds):
            signs = np.where(base @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(base.T @ signs)
            turn = u @ v
        found.append(axes @ turn)
    return mean, np.hstack(found)


def tables_needed(cosine: float, bits: int, recall: float) -> float:
    """Tables of ``bits`` random signs in one of which a pair at ``cosine`` agrees with probability ``recall``."""
    agree = (1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi) ** bits
    return 1 if agree >= recall else math.ceil(math.log1p(-recall) / math.log1p(-agree)) if agree > 1e-9 else math.inf


def planted(unit: np.ndarray, cosine: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(rows, partners at ``cosine``): each row once with a random direction, once towards another row."""
    draw, c = np.random.default_rng(seed), min(1.0, max(-1.0, cosine))
    rows = np.vstack([unit, unit])
    turn = np.vstack([draw.normal(size=unit.shape), unit[draw.permutation(len(unit))]])
    turn = turn - (turn * rows).sum(axis=1)[:, None] * rows
    size = np.linalg.norm(turn, axis=1)[:, None]
    return rows, np.where(size > 1e-6, c * rows + math.sqrt(1 - c * c) * turn / np.maximum(size, 1e-6), rows)


def learn(sample: np.ndarray, cosine: float, bits: int, recall: float, rotations: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(offset, matrix, bits): ``rotations`` or more, until both kinds of planted pairs meet with ``recall``.

    The pairs are planted on every fourth row of the sample, which the rotations
    do not see: rows that were learnt from agree more often.  Where learnt bits still miss pairs at twice the columns that random signs
    need (data close to its mean, few dimensions), random signs about the origin
    follow: they agree by the angle alone, whatever the data.
    """
    while bits and tables_needed(cosine, bits, recall) > MAX_TABLES:
        bits -= 1
    width = sample.shape[1]
    if not bits:
        return np.zeros(0), np.zeros((width, 0)), 0
    apart = np.arange(len(sample)) % 4 == 3 if len(sample) > 3 else np.ones(len(sample), bool)
    a, b = planted(sample[apart], cosine)
    sample = sample[~apart] if len(sample) > 3 else sample
    need, met, kinds = int(tables_needed(cosine, bits, recall)) * bits, np.zeros(len(a), bool), len(a) // 2
    mean, matrix = train(sample, rotations)
    seen = 0
    while True:
        upto = matrix.shape[1] // bits * bits
        fresh = matrix[:, seen:upto]
        met |= (table_keys(a, mean @ fresh, fresh, bits) == table_keys(b, mean @ fresh, fresh, bits)).any(axis=1)
        seen = upto
        if seen and min(met[:kinds].mean(), met[kinds:].mean()) >= recall:
            return mean @ matrix, matrix, bits
        if seen >= 2 * need:
            free = np.random.default_rng(13).normal(size=(width, need))
            return np.r_[mean @ matrix[:, :seen], np.zeros(need)], np.hstack([matrix[:, :seen], free]), bits
        matrix = np.hstack([matrix, train(sample, max(1, bits // width), seed=7 + matrix.shape[1])[1]])


def table_keys(unit: np.ndarray, offset: np.ndarray, matrix: np.ndarray, bits: int) -> np.ndarray:
    """Key of every row in every table: consecutive groups of ``bits`` sign bits; without bits all rows share one."""
    if not bits:
        return np.zeros((len(unit), 1), dtype=np.int64)
    signs = unit @ matrix >= offset
    tables = signs.shape[1] // bits
    grouped = signs[:, : tables * bits].reshape(len(unit), tables, bits)
    return grouped @ (1 << np.arange(bits, dtype=np.int64))


def _units(rows: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit rows in double precision, which rows are usable)."""
    out, good = np.zeros((len(rows), width)), np.zeros(len(rows), dtype=bool)
    for i, v in enumerate(rows):
        if v is None or len(v) != width:
            continue
        v = np.asarray(v, dtype=np.float64)
        if np.isfinite(v).all() and (scale := np.abs(v).max(initial=0.0)) > 0:
            v = v / scale
            out[i], good[i] = v / math.sqrt(float(v @ v)), True
    return out, good


def _usable(vec: str):
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def _key_udf(shared):
    @F.pandas_udf("array<int>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        offset, matrix, length, width = shared.value
        for rows in batches:
            yield pd.Series(list(table_keys(_units(rows, width)[0], offset, matrix, length).astype(np.int32)))

    return keys


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, sample_rows: int = 4096, rotations: int = 4, bits: int | None = None, vec_id: str = "vec_id", vec: str = "embedding", recall: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Links are pairs of vectors of equal length with cosine >= ``threshold``
    among those that share a table; none below it.  Null, empty or zero vectors
    and vectors with null or non-finite components link with nothing; so does a
    row without id, whose component is null.  Rows with one id are one node,
    but each repeated row counts as another vector in n_links.  Other columns
    are not read.  ``sample_rows`` bounds what the rotations are learnt from;
    every vector is indexed.  ``bits`` defaults to the logarithm of the number
    of vectors (8 to 30), so buckets stay small as the table grows.  A pair at
    ``threshold`` shares a table with probability ``recall`` at every number of
    vectors, a closer one with more: ``rotations`` is the least number and rises
    with the bits, and keys get shorter where more than MAX_TABLES were needed.
    """
    spark = vectors.sparkSession
    base = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec).cast("array<double>").alias("v"))
    good = base.filter(_usable("v") & F.col("vec_id").isNotNull())
    # equal vectors are one, with their number
    same = good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("times"))
    same = land(same.withColumns({"width": F.size("v"), "row": F.monotonically_increasing_id()}), "distinct")
    sizes = [(r.width, r["count"]) for r in same.groupBy("width").count().orderBy("width").collect()]
    parts = []
    for width, count in sizes:
        own = same.filter(F.col("width") == width)
        last = own.select(F.xxhash64("id").alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
        drawn = own.filter(F.xxhash64("id") <= last).select("v").limit(2 * sample_rows).toArrow().to_pandas()["v"]
        length = min(30, bits or max(8, math.ceil(math.log2(count + 1))))
        offset, matrix, length = learn(_units(drawn, width)[0], threshold, length, recall, rotations)
        keys = _key_udf(spark.sparkContext.broadcast((offset, matrix, length, width)))
        parts.append(own.select("row", "times", "width", "v", keys("v").alias("k")))
    links = None
    if parts:
        coded = parts[0]
        for p in parts[1:]:
            coded = coded.union(p)
        links = land(_compare(land(coded, "codes"), threshold), "links")
        named = same.select("row", "id", "times")
        near = links.filter("b is null").groupBy("a").agg(F.sum("n").alias("near"))
        counted = named.join(near.select(F.col("a").alias("row"), "near"), "row", "left")
        edges = links.filter("b is not null").select("a", "b").distinct()
        ends = edges.join(named.select(F.col("row").alias("a"), F.col("id").alias("x")), "a").join(named.select(F.col("row").alias("b"), F.col("id").alias("y")), "b")
        found = land(counted.join(same.select("row", "v"), "row").select("v", "id", (F.coalesce("near", F.lit(0)) + F.col("times") - 1).cast("long").alias("n_links")), "counted")
        # rows of one id and rows of one vector are tied together
        ties = good.select("vec_id", "v").join(found.select("v", "id"), "v").filter(F.col("vec_id") != F.col("id")).select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
        comps = land(graph.components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).union(ties)), "components")
        out = base.join(found.select("v", "n_links"), "v", "left").join(comps.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        links_of = F.when(_usable("v") & F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0)
        component = F.coalesce("component", "vec_id")
    else:
        out, links_of, component = base, F.lit(0), F.col("vec_id")
    return out.select("vec_id", links_of.cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _compare(coded: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): partial link counts (b null) and links that span the local components (n null)."""
    spread = coded.select("row", "width", F.posexplode("k").alias("t", "key"))
    many = land(spread.groupBy("width", "t", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "buckets")
    met = spread.join(many, ["width", "t", "key"])
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    met = met.select("row", "width", "t", "key", blocks.alias("nb"), F.pmod(F.xxhash64("row", "t"), blocks).cast("int").alias("blk"))
    both = met.select("row", "width", "t", "key", "blk", F.explode(F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(F.least("blk", o).alias("i"), F.greatest("blk", o).alias("j")))).alias("p"))
    cell = F.xxhash64("width", "t", "key", "p.i", "p.j")
    # 0: a block with itself, else 1 or 2 for the first or second block
    side = F.when(F.col("p.i") == F.col("p.j"), 0).when(F.col("blk") == F.col("p.i"), 1).otherwise(2)
    rows = both.select("row", "t", side.alias("side"), cell.alias("cell")).join(coded.select("row", "times", "v", "k"), "row")
    ready = rows.repartition("cell").sortWithinPartitions("cell", "row")
    return ready.mapInPandas(_judge(threshold), "a long, b long, n long")


def _judge(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            if rest is not None and len(rest):
                pdf = pd.concat([rest, pdf], ignore_index=True)
            cells = pdf["cell"].to_numpy()
            cut = int(np.searchsorted(cells, cells[-1], side="left")) if len(cells) else 0
            rest = pdf.iloc[cut:]
            if cut:
                yield from judge_cells(pdf.iloc[:cut], threshold)
        if rest is not None and len(rest):
            yield from judge_cells(rest, threshold)

    return run


def judge_cells(pdf: pd.DataFrame, threshold: float) -> Iterator[pd.DataFrame]:
    """Links within whole cells; rows of the second block meet only those of the first."""
    for _, part in pdf.groupby(pdf["v"].str.len(), sort=False):
        cells, ids, table, side, times = (part[c].to_numpy() for c in ("cell", "row", "t", "side", "times"))
        keys = np.stack(part["k"].to_numpy())
        unit, _ = _units(part["v"], len(part["v"].iloc[0]))
        first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        ends = np.r_[first[1:], len(cells)]
        # every row meets the later rows of its cell
        meets = np.repeat(ends, ends - first) - np.arange(len(cells)) - 1
        found_a, found_b, begin = [], [], 0
        while begin < len(cells):
            stop = max(begin + 1, int(np.searchsorted(np.cumsum(meets[begin:]), PAIRS)) + begin)
            n = meets[begin:stop]
            a = np.repeat(np.arange(begin, stop), n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            use = (side[a] == 0) | (side[a] != side[b])
            a, b = a[use], b[use]
            early = keys[a] == keys[b]
            use = early.argmax(axis=1) == table[a] if len(a) else np.zeros(0, bool)
            a, b = a[use], b[use]
            use = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            found_a.append(a[use])
            found_b.append(b[use])
            begin = stop
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if not len(a):
            continue
        uniq, back = np.unique(ids, return_inverse=True)
        x, y = back[a], back[b]
        n = (np.bincount(x, weights=times[b], minlength=len(uniq)) + np.bincount(y, weights=times[a], minlength=len(uniq))).astype(np.int64)
        label = graph.local_labels(x, y, len(uniq))
        has = np.flatnonzero(n)
        moved = np.flatnonzero(label != np.arange(len(uniq)))
        yield pd.DataFrame({"a": uniq[has], "b": pd.array([None] * len(has), dtype="Int64"), "n": pd.array(n[has], dtype="Int64")})
        yield pd.DataFrame({"a": uniq[moved], "b": pd.array(uniq[label[moved]], dtype="Int64"), "n": pd.array([None] * len(moved), dtype="Int64")})
