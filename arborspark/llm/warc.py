"""Merkle fixity audit of replicated web archives.

A store lists records with offset and digest.  The primary is cut into ordered
offset ranges; the first record of every range bounds a key range, and both
stores' records are hashed into the leaf their key falls in, leaves by
``fanout`` into a tree.  A replica may so have a layout of its own: a record of
another length moves every later offset, but changes one leaf.  Both trees are
built side by side, one small table per level.  The audit compares the roots
and goes down only where two nodes differ, so it compares the records of
broken ranges alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborspark.operators.ordering import prefix_sums
from arborspark.session import land


def record(url: Column, body: Column) -> Column:
    """A response record as text; a null url or body counts as empty."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"))
    return F.concat(head, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def lay_out(records: DataFrame) -> DataFrame:
    """Add ``offset`` to (record_id, n_bytes, digest, ...): the archive in order of id, digest and row.

    Any share of equal ids spreads over tasks; null ids come first.
    """
    rows = records.withColumn("_row", F.monotonically_increasing_id())
    laid = prefix_sums(land(rows, "records"), [], ["record_id", "digest", "_row"], {"_upto": F.col("n_bytes")})
    return laid.select(*records.columns, (F.col("_upto") - F.col("n_bytes")).alias("offset"))


def place(primary: DataFrame, replica: DataFrame, leaf_bytes: int) -> DataFrame:
    """(side, record_id, digest, n, offset, node): both stores' distinct records with their count and leaf.

    A leaf begins at the first record of an offset range of the primary.  The
    number of range starts up to a record is a running sum over both stores in
    key order, so no range meets all records and a hot id spreads over tasks.
    """
    sides = [s.select(F.lit(name).alias("side"), "record_id", "digest", "offset") for name, s in (("a", primary), ("b", replica))]
    rows = sides[0].union(sides[1]).groupBy("side", "record_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("offset"))
    first = primary.filter("offset is not null").groupBy(F.floor(F.col("offset") / leaf_bytes).alias("at")).agg(F.min(F.struct("record_id", "digest")).alias("f"))
    edges = first.select("f.*").distinct().select(F.lit("").alias("side"), "record_id", "digest", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("offset"))
    begun = prefix_sums(rows.union(edges), [], ["record_id", "digest", "side"], {"_begun": F.when(F.col("side") == "", 1).otherwise(0).cast("long")})
    return begun.filter("side <> ''").select("side", "record_id", "digest", "n", "offset", F.greatest(F.col("_begun") - 1, F.lit(0)).cast("long").alias("node"))


def _leaf(entry: Column, mine: Column) -> Column:
    """Hash of a set of entries' SHA-256 digests, summed in eight lanes of 32 bits; null without any.

    Sums need no list, so a leaf may hold any number of records.
    """
    lanes = [F.sum(F.when(mine, F.conv(F.substring(entry, 8 * i + 1, 8), 16, 10).cast("long"))).cast("string") for i in range(8)]
    return F.when(F.count_if(mine) > 0, F.sha2(F.concat_ws(",", F.count_if(mine).cast("string"), *lanes), 256))


def _node(entries: Column) -> Column:
    """Hash of at most ``fanout`` (place, digest) entries in order; null without any."""
    listed = F.sort_array(entries)
    return F.when(F.size(listed) > 0, F.sha2(F.array_join(F.transform(listed, lambda e: F.concat(e["place"].cast("string"), F.lit(":"), e["digest"])), ","), 256))


def tree(placed: DataFrame, fanout: int) -> list[DataFrame]:
    """Levels from leaves to root of both trees: (node, a, b), a null where a side is empty."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("record_id", "digest")]
    entry = F.sha2(F.concat_ws("|", *shown, F.col("record_id").isNull().cast("string"), F.col("digest").isNull().cast("string"), F.col("n").cast("string")), 256)
    hashed = placed.select("node", "side", entry.alias("entry"))
    levels = [land(hashed.groupBy("node").agg(*[_leaf(F.col("entry"), F.col("side") == s).alias(s) for s in ("a", "b")]), "leaves")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top > 0:
        below = levels[-1].select(F.floor(F.col("node") / fanout).cast("long").alias("up"), "node", "a", "b")
        part = lambda s: F.when(F.col(s).isNotNull(), F.struct(F.col("node").alias("place"), F.col(s).alias("digest")))
        levels.append(land(below.groupBy(F.col("up").alias("node")).agg(*[_node(F.collect_list(part(s))).alias(s) for s in ("a", "b")]), "level"))
        top //= fanout
    return levels


def broken_leaves(levels: list[DataFrame], fanout: int) -> DataFrame:
    """Leaves below differing nodes, found from the root down."""
    found = None
    for level in reversed(levels):
        differ = level.filter(~F.col("a").eqNullSafe(F.col("b"))).select("node", F.floor(F.col("node") / fanout).cast("long").alias("up"))
        if found is not None:
            differ = differ.join(found.select(F.col("node").alias("up")), "up", "left_semi")
        found = land(differ.select("node"), "broken")
        if found.isEmpty():
            break
    return found


def audit(primary: DataFrame, replica: DataFrame, leaf_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Records that differ between two stores (record_id, offset, digest).

    Returns (record_id, offset, leaf, status, digest_a, digest_b); status is
    ``changed``, ``missing`` (only in the primary) or ``extra`` (only in the
    replica).  Rows are matched by record id and digest, nulls equal, wherever
    they lie; of one id the digests that stand on one side alone are paired in
    order as changed.  A row found on both sides in different numbers is listed
    as missing or extra once.  ``offset`` is the primary's, an extra's its own,
    null if it has none; ``leaf`` is the offset range it lies in.
    """
    placed = land(place(primary, replica, leaf_bytes), "placed")
    broken = broken_leaves(tree(placed, fanout), fanout)
    near = placed.join(broken, "node", "left_semi")
    of = lambda s, c: F.when(F.col("side") == s, F.col(c))
    met = near.groupBy("record_id", "digest").agg(*[F.coalesce(F.sum(of(s, "n")), F.lit(0)).alias(s) for s in ("a", "b")], F.min(of("a", "offset")).alias("at_a"), F.min(of("b", "offset")).alias("at_b"))
    differ = met.filter("a <> b").withColumns({"only": F.expr("CASE WHEN b = 0 THEN 'a' WHEN a = 0 THEN 'b' END")})
    counted = differ.filter("only is null").select("record_id", F.coalesce("at_a", "at_b").alias("offset"), F.when(F.col("a") > F.col("b"), "missing").otherwise("extra").alias("status"), F.col("digest").alias("digest_a"), F.col("digest").alias("digest_b"))
    nth = F.row_number().over(Window.partitionBy("record_id", "only").orderBy("digest"))
    lone = differ.filter("only is not null").withColumn("nth", nth)
    pair = lone.groupBy("record_id", "nth").agg(*[F.max(F.when(F.col("only") == s, F.struct(F.col(f"at_{s}").alias("at"), "digest"))).alias(s) for s in ("a", "b")])
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    paired = pair.select("record_id", F.when(F.col("a").isNotNull(), F.col("a.at")).otherwise(F.col("b.at")).alias("offset"), status.alias("status"), F.col("a.digest").alias("digest_a"), F.col("b.digest").alias("digest_b"))
    return counted.union(paired).select("record_id", "offset", F.floor(F.col("offset") / leaf_bytes).cast("long").alias("leaf"), "status", "digest_a", "digest_b")
