import numpy as np
import pytest

from arborspark.llm import graph, vectors


def brute(rows, threshold):
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                links[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    return links


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    centres = r.normal(size=(40, 24))
    out = [(100 + i, (centres[i % 40] + r.normal(size=24) * (0.05 + 0.002 * (i % 7))).tolist()) for i in range(240)]
    hot = r.normal(size=24)
    out += [(1000 + i, (hot + r.normal(size=24) * 0.06).tolist()) for i in range(600)]
    out += [(5, None), (6, []), (7, [0.0] * 24), (8, [float("nan")] * 24), (9, [1.0, None]), (10, [1.0, 2.0]), (11, [2.0, 4.0]), (12, [float("inf")] + [1.0] * 23), (13, out[0][1]), (14, out[0][1])]
    return out


def test_recall_and_components(spark, rows):
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, n_links string")
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    links = brute(rows, 0.95)
    ids = np.array([i for i, _ in rows])
    found = sum(got[i].n_links for i in ids)
    assert len(got) == len(rows) and 0.97 * links.sum() <= found <= links.sum()
    assert all(got[i].n_links <= links[k].sum() for k, i in enumerate(ids))
    label = np.arange(len(rows))
    a, b = np.nonzero(links)
    order = np.argsort(ids)
    at = np.empty(len(ids), int)
    at[order] = np.arange(len(ids))
    label = graph.local_labels(at[a], at[b], len(ids))
    same = sum(got[i].component_id == ids[order[label[at[k]]]] for k, i in enumerate(ids))
    assert same >= 0.99 * len(ids)
    for i in (5, 6, 7, 8, 9, 12):
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert got[10].component_id == got[11].component_id == 10 and not got[11].kept
    assert {got[13].component_id, got[14].component_id, got[100].component_id} == {13}


def test_given_table_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    links = brute(rows, 0.95)
    found = sum(r.n_links for r in vectors.near_duplicates(df).collect())
    assert 0.9 * links.sum() <= found <= links.sum()
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1001), (None, 3), (2000, 1500), (1500, 2000)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000, 1500: 1500, 2000: 1500}


def pairs_at(r, n, width, low, high):
    a = r.normal(size=(n, width))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = r.normal(size=a.shape)
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    c = r.uniform(low, high, size=n)[:, None]
    return a, c * a + np.sqrt(1 - c * c) * b


@pytest.mark.parametrize("bits", [20, 27])
def test_recall_just_above_the_threshold_at_the_bits_of_large_tables(spark, bits):
    a, b = pairs_at(np.random.default_rng(bits), 1000, 64, 0.9501, 0.96)
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([a, b]))]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), bits=bits)
    assert 0.93 * len(a) <= found.filter("n_links > 0").count() / 2 <= len(a)


@pytest.mark.parametrize("width, shift, cosine, bits", [(64, 3.0, 0.95, 24), (2, 0.0, 0.95, 14), (16, 0.0, 0.8, 30), (64, 0.0, 0.95, 30)])
def test_learnt_tables_keep_the_stated_recall(width, shift, cosine, bits):
    r = np.random.default_rng(2)
    sample = r.normal(size=(1000, width)) + shift
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    offset, matrix, length = vectors.learn(sample, cosine, bits, 0.95, 4)
    other = r.normal(size=(2000, width)) + shift
    other /= np.linalg.norm(other, axis=1)[:, None]
    a, b = vectors.planted(other, cosine, seed=3)
    met = (vectors.table_keys(a, offset, matrix, length) == vectors.table_keys(b, offset, matrix, length)).any(axis=1)
    assert met.mean() >= 0.93 and matrix.shape[1] // length <= 3 * vectors.MAX_TABLES + 1


def test_a_threshold_that_no_key_can_serve_compares_all():
    assert vectors.tables_needed(1.0, 30, 0.95) == 1 and vectors.learn(np.eye(4), -1.0, 20, 0.95, 4)[2] == 0
