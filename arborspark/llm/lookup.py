"""Joins with a table that is usually small: broadcast behind a measured bound, a shuffled join beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 8 << 20


def measured_bytes(small: DataFrame) -> int:
    texts = [c for c, kind in small.dtypes if kind in ("string", "binary")]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(16 * len(small.columns)))
    return small.agg(F.sum(size.cast("long"))).first()[0] or 0


def within_bound(small: DataFrame) -> DataFrame:
    """``small`` (a landed table), marked for broadcast if it is within ``BROADCAST_BYTES``."""
    return F.broadcast(small) if measured_bytes(small) <= BROADCAST_BYTES else small


def lookup(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """``df`` joined with ``small`` on ``on``, nulls equal; ``small`` should be a landed table.

    A hot key costs nothing while ``small`` is within ``BROADCAST_BYTES``;
    beyond, the adaptive join splits it.
    """
    renamed = within_bound(small.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in small.columns]))
    same = [df[c].eqNullSafe(renamed[f"_on_{c}"]) for c in on]
    joined = df.join(renamed, same, how)
    return joined.drop(*[f"_on_{c}" for c in on])


SALTS = 16


def spread_join(df: DataFrame, small: DataFrame, on: Sequence[str], by: str) -> DataFrame:
    """Inner join of ``df`` with ``small`` (landed, unique on ``on``), whose keys may be hot in ``df``.

    Broadcast within ``BROADCAST_BYTES``; beyond, a key's rows are dealt over
    ``SALTS`` tasks by their ``by`` and ``small`` is repeated for each.
    """
    if measured_bytes(small) <= BROADCAST_BYTES:
        return df.join(F.broadcast(small), list(on))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "_salt"]).drop("_salt")
