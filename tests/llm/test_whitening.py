import numpy as np
import pytest

from arborspark.llm import whitening

INF, NAN = float("inf"), float("nan")


def by_hand(vectors, k):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return ((n * x - sums) ** 2).sum(axis=1), centred @ u / np.sqrt(e), e / np.trace(v)


def in_spark(spark, rows, parts=4, k=32):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, whitened string, component int").repartition(parts)
    out = {}
    for r in whitening.whitened_rows(df, components=k).collect():
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


def test_equals_numpy_whatever_the_partitions(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (700, 40)) @ rng.normal(0, 1, (40, 40))
    vectors[3:6] = vectors[2]
    vectors[8, 0] = 40_000
    rows = [(i, v.tolist(), 1, "x", 2) for i, v in enumerate(vectors)]
    odd = [None, [], [1.0] * 39 + [None], [NAN] * 40, [INF] + [0.0] * 39, [1.0, 2.0], [1e30] + [0.0] * 39]
    rows += [(1000 + i, v, None, None, None) for i, v in enumerate(odd)]
    one, many = in_spark(spark, rows, 1), in_spark(spark, rows, 7)
    deviation, white, explained = by_hand(vectors, 32)
    assert set(one) == set(range(700)) and all(set(c) == set(range(1, 33)) for c in one.values())
    got = np.array([[one[i][c]["whitened"] for c in range(1, 33)] for i in range(700)])
    again = np.array([[many[i][c]["whitened"] for c in range(1, 33)] for i in range(700)])
    np.testing.assert_allclose(got, again, atol=1e-13)  # one model; block products round by block size
    sign = np.sign((got * white).sum(axis=0))
    np.testing.assert_allclose(got * sign, white, atol=1e-9)
    assert [one[i][1]["deviation"] for i in range(700)] == deviation.tolist()
    np.testing.assert_allclose([one[0][c]["explained"] for c in range(1, 33)], explained, rtol=1e-12)
    assert {r["explained"] for c in one.values() for r in c.values()} == {r["explained"] for c in many.values() for r in c.values()}
    assert one[0][1]["n"] == 700 and one[0][1]["identity_error"] < 1e-9


def test_no_rows_one_row_and_no_variance(spark):
    assert in_spark(spark, []) == {}
    assert in_spark(spark, [(1, None, 1, "a", 1)]) == {}
    one = in_spark(spark, [(1, [1.0, 2.0], 1, "a", 1)])
    assert [(c, r["whitened"], r["deviation"], r["identity_error"]) for c, r in sorted(one[1].items())] == [(1, None, 0, None), (2, None, 0, None)]
    flat = in_spark(spark, [(i, [float(i), 2.0 * i, 7.0], 1, "a", 1) for i in range(50)])
    assert [flat[0][c]["whitened"] is None for c in (1, 2, 3)] == [False, True, True]
    assert flat[0][1]["identity_error"] < 1e-9


def orthogonal(n, seed):
    x = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(4):
        x = x @ (1.5 * np.eye(n) - 0.5 * x.T @ x)
    return x


@pytest.mark.parametrize("gap", [1e-3, 1e-7, 1e-10])
def test_clustered_eigenvalues_are_told_apart(gap):
    n = 24
    u = orthogonal(n, 1)
    values = np.array([9.0, 5.0, 5.0 - gap, 5.0 - 3 * gap, *np.linspace(4, 1, n - 5), 1.0 - gap], dtype=np.longdouble)
    a = (u * values) @ u.T
    a = (a + a.T) / 2
    e, x = whitening.eigenpairs(a)
    np.testing.assert_allclose(e, values.astype(float), rtol=1e-15)
    reached = np.abs((u.T @ x).astype(float)).diagonal()
    np.testing.assert_allclose(reached, 1, atol=1e-14)
    across = np.abs((u.T @ x - np.diag(np.diag(u.T @ x))).astype(float)).max()
    assert across < 100 * np.finfo(np.longdouble).eps / gap + 1e-15


def test_equal_eigenvalues_keep_an_orthonormal_basis():
    u = orthogonal(12, 2)
    values = np.array([3.0] * 5 + [2.0] * 4 + [0.0] * 3, dtype=np.longdouble)
    e, x = whitening.eigenpairs((u * values) @ u.T)
    np.testing.assert_allclose(e, values.astype(float), atol=1e-15)
    np.testing.assert_allclose(x.T @ x, np.eye(12), atol=1e-15)
    np.testing.assert_allclose(((u * values) @ u.T).astype(float) @ x, x * e, atol=2e-15)


def test_products_of_large_integers_are_exact():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(-50, 50, (200, 3)), rng.integers(-(2**53), 2**53, (50, 3))])
    want = [[sum(int(a) * int(b) for a, b in zip(rows[:, i], rows[:, j])) for j in range(3)] for i in range(3)]
    assert whitening.exact_gram(rows).tolist() == want
    assert whitening.exact_sum(rows).tolist() == [sum(map(int, rows[:, i])) for i in range(3)]
