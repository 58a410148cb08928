import numpy as np
import pytest

from heddle.llm import whitening as w


def table(spark, vectors, ids=None, kind="float"):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, component string")


def sample(n=700, dim=12, seed=3):
    chance = np.random.default_rng(seed)
    return (chance.standard_normal((n, dim)) @ (chance.standard_normal((dim, dim)) * np.linspace(0.02, 0.3, dim))).astype(np.float32)


@pytest.mark.parametrize("dim", [1, 2, 3, 12, 64])
def test_eigen_solve(dim):
    chance = np.random.default_rng(dim)
    for a in (chance.standard_normal((dim, dim)), np.zeros((dim, dim)), np.eye(dim), np.ones((dim, dim)), np.diag(np.arange(dim) * 1e6), 1e-200 * chance.standard_normal((dim, dim))):
        a = a @ a.T if np.abs(a).max() > 1e-100 else (a + a.T) / 2
        values, vectors = w.symmetric_eigen(a)
        top = max(np.abs(values).max(), 1e-300)
        assert np.allclose(values / top, np.linalg.eigvalsh(a)[::-1] / top, atol=1e-12)
        assert np.abs(vectors.T @ vectors - np.eye(dim)).max() < 1e-12
        assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * top * dim


def test_updates_and_merges_keep_digits_far_from_zero():
    rows = np.random.default_rng(0).integers(-40, 40, (5000, 5)) + 10**9
    exact = rows.astype(object)
    parts = []
    for some in np.array_split(rows, [1, 2, 700, 700, 3111]):
        held = w.Moments.none(5)
        for few in np.array_split(some, 7):
            held.update(few)
        parts.append(held)
    told = parts[0]
    for part in parts[1:]:
        told = told.merge(part)
    n, sums = 5000, exact.sum(axis=0)
    products = np.array([[int(n * (exact[:, i] * exact[:, j]).sum() - sums[i] * sums[j]) for j in range(5)] for i in range(5)]) / n
    assert told.n == n and told.sums == list(sums)
    assert np.allclose(told.mean, (sums / n).astype(float), rtol=1e-15)
    assert np.abs(told.products - products).max() < 1e-9 * np.abs(products).max()


ODD = [None, [None] + [0.1] * 11, [float("nan")] + [0.1] * 11, [float("inf")] * 12, [], [1e300] * 12]


def test_query_against_plain_arithmetic(spark, monkeypatch):
    monkeypatch.setattr(w, "FAN_IN", 2)
    vectors = sample()
    df = table(spark, [*vectors.tolist(), *ODD, vectors[4].tolist()], [*range(len(vectors)), *range(9000, 9000 + len(ODD)), None]).repartition(7)
    found = w.whiten(df, scale=1024, shift=100_000).collect()
    x = np.floor(1024 * np.concatenate((vectors, vectors[4:5])).astype(np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    assert len(found) == n * 8 and {r["n"] for r in found} == {n}
    assert {r["vec_id"] for r in found} == {*range(len(vectors)), None}
    white = centred @ components[:, :8] / np.sqrt(values[:8])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    got = {(r["vec_id"], r["component"]): r for r in found}
    signs = [np.sign(got[0, k + 1]["whitened"] * white[0, k]) for k in range(8)]
    for i in [*range(len(vectors)), None]:
        at = n - 1 if i is None else i
        for k in range(8):
            r = got[i, k + 1]
            assert r["deviation"] == deviation[at]
            assert abs(r["whitened"] - signs[k] * white[at, k]) < 1e-8
            assert abs(r["explained"] - values[k] / values.sum()) < 1e-9
    assert len({r["identity_error"] for r in found}) == 1 and 0 <= found[0]["identity_error"] < 1e-9


def test_lengths_and_components_without_spread(spark):
    """One row, equal rows, fewer components than asked for, and lengths by themselves."""
    df = table(spark, [[0.5, 0.25, 1.0], [0.5, 0.75, 1.0], [0.5, 0.25, 1.0], [3.0], [2.0, 2.0], [2.0, 2.0]], [1, 2, 3, 4, 5, 5], "double")
    found = {}
    for r in w.whiten(df, scale=1024).collect():
        found.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert sorted((k, len(v)) for k, v in found.items()) == [((1, 1), 1), ((1, 2), 1), ((1, 3), 1), ((2, 1), 1), ((2, 2), 1), ((2, 3), 1), ((3, 1), 1), ((3, 2), 1), ((3, 3), 1), ((4, 1), 1), ((5, 1), 2), ((5, 2), 2)]
    r = found[2, 1][0]
    assert abs(abs(r["whitened"]) - 2**0.5) < 1e-12 and r["explained"] == 1 and r["identity_error"] < 1e-12 and r["deviation"] == (3 * 768 - 1280) ** 2
    assert found[2, 2][0]["whitened"] is None and found[2, 2][0]["explained"] == 0
    one = found[4, 1][0]
    assert (one["whitened"], one["explained"], one["identity_error"], one["deviation"], one["n"]) == (None, None, None, 0, 1)


def test_deviation_beyond_a_long_and_without_steps(spark):
    df = table(spark, [[0.0], [1e15], [-1e15]], kind="double")
    assert [r["deviation"] for r in w.whiten(df, scale=1024).orderBy("vec_id").collect()] == [0, None, None]
    plain = w.whiten(table(spark, sample().tolist())).collect()
    assert len(plain) == 700 * 8 and plain[0]["deviation"] is None and plain[0]["identity_error"] < 1e-9


def test_empty_table(spark):
    assert w.whiten(table(spark, [])).count() == 0
    assert w.whiten(table(spark, [None])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_registered_query(spark):
    found = w.op12_whitening(spark, "/root/testdata/sf0.001").toPandas()
    assert found.groupby("component").whitened.std(ddof=0).sub(1).abs().max() < 1e-9
    assert found.groupby("component").whitened.mean().abs().max() < 1e-9
