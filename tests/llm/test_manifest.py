import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from arborspark.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def said(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """Root of a list of nodes and each one's siblings, level by level."""
    at, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, p in enumerate(at):
            lo = p // 16 * 16
            proofs[i].append((nodes[lo:p], nodes[p + 1 : lo + 16]))
            at[i] = p // 16
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], proofs


def by_hand(rows):
    first = lambda r: (r[3] is not None, (r[3] or "").encode())
    leaf = lambda r, text: said((r[0], r[3], r[2], r[4], text))
    groups = {}
    for r in sorted(rows, key=lambda r: (first(r), r[0] is not None, r[0] or 0, leaf(r, r[1]))):
        groups.setdefault(first(r), []).append(r)
    subs = [climb([leaf(r, r[1]) for r in part]) for part in groups.values()]
    root, tops = climb([s for s, _ in subs]) if subs else (None, [])
    out = []
    for part, (sub, proofs), top in zip(groups.values(), subs, tops):
        for r, proof in zip(part, proofs):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            low = r[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            folded = leaf(r, low if bad else r[1])
            for before, behind in proof + top:
                folded = digest(*before, folded, *behind)
            shown = digest(*[d for before, behind in proof + top for d in before + behind])
            out.append((r[0], leaf(r, r[1]), sub, root, shown, folded, folded == root))
    return out


def in_spark(spark, rows, block_rows, keep=None):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit("clash")).withColumn("tree", F.lit("clash"))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = manifest.number_leaves(manifest.digests(df, "source", "doc_id", fields, [*fields[:4], low], F.crc32(F.col("doc_id").cast("string")) % 5 == 0))
    nodes, root = manifest.build(leaves)
    wanted = leaves if keep is None else leaves.filter(keep)
    return [tuple(r) for r in manifest.prove(wanted, nodes, root, block_rows).collect()]


def order(rows):
    return sorted(rows, key=str)


def sample():
    rows = [(i, f"Text Ünï {i} ABC" * (i % 4), ("en", None)[i % 2], ("hot" if i % 3 == 0 else f"s{i % 40:02d}"), i) for i in range(1500)]
    rows += [(i, "Null Source", None, None, None) for i in range(5000, 5033)]
    rows += [(None, None, None, None, None), (7, "Twice", "en", "hot", 5), (7, "Twice", "en", "hot", 5), (2**53 + 1, "", "", "", 0), (9000, "x" * 300_000 + "A", "de", "long", 1), (9001, "A", "de", "\U0001f600", 1), (9002, "A", "de", "￮", 1)]
    return rows


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_equals_trees_made_by_hand(spark, block_rows):
    rows = sample()
    got = in_spark(spark, rows, block_rows)
    assert order(got) == order(by_hand(rows))
    assert {r[-1] for r in got} == {True, False}


def test_some_leaves_only(spark):
    rows = sample()
    want = [r for r in by_hand(rows) if r[0] is not None and r[0] % 11 == 0]
    assert order(in_spark(spark, rows, 50, "key % 11 = 0")) == order(want)


@pytest.mark.parametrize("rows", [[], [(1, "Only", "en", "s", 4)], [(i, "A", None, "s", None) for i in range(16)], [(i, "A", None, f"{i:03d}", None) for i in range(17)]])
def test_small_tables(spark, rows):
    assert order(in_spark(spark, rows, 4096)) == order(by_hand(rows))


def test_missing_nodes_are_the_least():
    import numpy as np

    asked = {level: idx.tolist() for level, idx in manifest.missing(np.array([17, 18, 40]), 300)}
    assert asked == {0: [16, *range(19, 40), *range(41, 48)], 1: [0, *range(3, 16)], 2: [1]}
