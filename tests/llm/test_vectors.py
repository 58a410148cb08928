import numpy as np
import pytest
from pyspark.sql import functions as F

from heddle.llm import ann, forest, vecdup


def table(spark, vectors, ids=None):
    rows = [(i, v if v is None else [None if x is None else float(x) for x in v], "label") for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, key string")


def sample(n=900, dim=16, seed=1):
    chance = np.random.default_rng(seed)
    base = chance.standard_normal((n, dim))
    near = base[:60].repeat(4, axis=0) + 0.08 * chance.standard_normal((240, dim))
    dense = base[70] + 0.02 * chance.standard_normal((150, dim))
    copies = base[80:90].repeat(3, axis=0)
    return np.concatenate((base, near, dense, copies)).astype(np.float32)


ODD = [None, [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0] * 7, []]


def test_duplicates_against_brute_force(spark):
    vectors = sample()
    order = np.random.default_rng(0).permutation(len(vectors)).tolist()
    df = table(spark, [*vectors.tolist(), *ODD, vectors[3].tolist()], [*order, *range(5000, 5000 + len(ODD)), None])
    found = {r["vec_id"]: r for r in vecdup.vector_duplicates(df, leaf_rows=128).collect()}
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    wanted = linked.sum()
    got = sum(found[i]["n_links"] for i in order)
    assert 0.97 * wanted <= got <= wanted
    assert all(found[order[i]]["n_links"] <= linked[i].sum() for i in range(len(order)))
    label = np.array(order)
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], 1 << 60).min(axis=1))
        if (low == label).all():
            break
        label = low
    assert np.mean([found[order[i]]["component_id"] == label[i] for i in range(len(order))]) > 0.99
    for i in range(5000, 5000 + len(ODD)):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert found[None]["n_links"] == 0 and found[None]["kept"] is None


@pytest.mark.parametrize("block_rows", [4096, 150])
def test_links_of_one_leaf_are_exact(spark, block_rows):
    """In one group, and in pairs of blocks."""
    vectors = sample()
    found = {r["vec_id"]: r["n_links"] for r in vecdup.vector_duplicates(table(spark, vectors.tolist()), leaf_rows=4096, block_rows=block_rows).collect()}
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert [found[i] for i in range(len(vectors))] == ((unit @ unit.T >= 0.9).sum(axis=1) - 1).tolist()


def test_duplicates_of_empty_and_repeated_rows(spark):
    assert vecdup.vector_duplicates(table(spark, [])).count() == 0
    assert vecdup.vector_duplicates(table(spark, ODD[:2])).count() == 2
    found = vecdup.vector_duplicates(table(spark, [[1.0, 0.0]] * 3, [4, 4, 6])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(4, 2, 4), (4, 2, 4), (6, 2, 4)]
    mixed = vecdup.vector_duplicates(table(spark, [[1.0, 0.0], [2.0, 0.0], [1.0, 0.0, 0.0], [3.0, 0.0, 0.0]])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in mixed) == [(0, 1, 0), (1, 1, 0), (2, 1, 2), (3, 1, 2)]


def test_dense_clusters_are_dealt_to_few_leaves():
    """Two fifths of the vectors near one another: splits pass beside them."""
    chance = np.random.default_rng(5)
    centre = chance.standard_normal(64)
    rows = np.concatenate((chance.standard_normal((12_000, 64)), centre + 0.15 * chance.standard_normal((8_000, 64))))
    rows = forest.unit_rows(chance.permutation(rows))
    for seed in range(vecdup.TREES):
        tree = forest.fit_tree(rows, len(rows), 256, seed, vecdup.SPILL / 8)
        copies = np.bincount(tree.route(rows, vecdup.SPILL / 8)[0], minlength=len(rows))
        assert copies.min() >= 1 and copies.mean() < 7.5 and copies.max() < 120


def test_repeated_rows_at_registered_parameters(spark):
    """Copies, a dense group and noise, by cosine 0.9, and the nearest, all at the queries' own parameters."""
    chance = np.random.default_rng(12)
    base = chance.standard_normal((3000, 64))
    vectors = np.concatenate((base, base[:400] + 0.25 * chance.standard_normal((400, 64)), base[7] + 0.1 * chance.standard_normal((200, 64)), base[20:40]))
    vectors = forest.unit_rows(vectors).astype(np.float32)
    df = table(spark, vectors.tolist())
    exact = vectors.astype(np.float64)
    unit = forest.unit_rows(exact)
    found = {r["vec_id"]: r["n_links"] for r in vecdup.vector_duplicates(df).collect()}
    wanted = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = np.array([found[i] for i in range(len(vectors))])
    assert (got <= wanted).all() and got.sum() >= 0.995 * wanted.sum()
    answers: dict = {}
    for r in ann.nearest(df).collect():
        answers.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = [len(set(answers[q]) & {i for _, i in brute_nearest(vectors, range(len(vectors)), q, 20)}) / 20 for q in range(0, len(vectors), 20)]
    assert len(answers) == len(hits) and np.mean(hits) >= 0.9


def brute_nearest(vectors, ids, query, k):
    scores = (vectors.astype(np.float64)[query] * vectors.astype(np.float64)).sum(axis=1)
    return sorted((-s, i) for s, i in zip(scores, ids) if i != ids[query])[:k]


def check_nearest(spark, vectors, scale=None):
    ids = list(range(len(vectors)))
    df = table(spark, [*vectors.tolist(), *ODD], [*ids, *range(5000, 5000 + len(ODD))])
    found = ann.nearest(df, k=10, leaf_rows=32).collect()
    hits = total = 0
    for q in ids[::20]:
        mine = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all((a["score"], -a["vec_id"]) >= (b["score"], -b["vec_id"]) for a, b in zip(mine, mine[1:]))
        truth = brute_nearest(vectors, ids, q, 10)
        assert all(abs(r["score"] - float(vectors[q].astype(np.float64) @ vectors[r["vec_id"]].astype(np.float64))) < 1e-9 for r in mine)
        hits += len({r["vec_id"] for r in mine} & {i for _, i in truth})
        total += 10
    assert hits / total >= 0.9
    assert {r["query_id"] for r in found} == set(ids[::20])


def test_nearest_against_brute_force(spark):
    vectors = sample()
    check_nearest(spark, (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32))


def test_nearest_by_products_of_unequal_norms(spark):
    check_nearest(spark, sample() * np.random.default_rng(3).uniform(0.5, 3, (1320, 1)).astype(np.float32))


def test_distinct_vectors_of_equal_product(spark):
    """Vectors of zeros and ones that share one component with the query: ties go to the smaller id, not to chance."""
    chance = np.random.default_rng(9)
    ones = np.unique(chance.integers(0, 2, (900, 14)), axis=0)
    vectors = np.column_stack((np.ones(len(ones)), ones)).astype(np.float32)
    vectors[0, 1:] = 0
    ids = chance.permutation(np.arange(1, len(vectors))).tolist()
    found = {}
    for r in ann.nearest(table(spark, vectors.tolist(), [0, *ids]), recall=1.0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert [i for _, i in sorted(found[0])] == list(range(1, 21))
    exact = vectors.astype(np.float64)
    for q, row in [(0, 0), *((i, ids.index(i) + 1) for i in found if i)]:
        order = sorted((-float(exact[row] @ v), i) for v, i in zip(exact, [0, *ids]) if i != q)
        assert [i for _, i in sorted(found[q])] == [i for _, i in order[:20]]


def test_stored_vectors_are_sent_once_for_each_tree(spark):
    """Whatever the number of queries: one exchange, whose stored rows are the vectors times the trees."""
    for every in (1, 20):
        df = table(spark, sample().tolist())
        points = df.select(F.col("vec_id").alias("node"), F.col("embedding").alias("v"))
        found = ann._search_all(points, points.where(f"node % {every} = 0"), 5, 3, 64, 0.9)
        dealt = found._jdf.queryExecution().executedPlan().toString()
        assert dealt.count("Exchange hashpartitioning") == 1 and "asks" in dealt[dealt.index("Sort [") :].split("\n")[0]
    chance = np.random.default_rng(1)
    stored = ann.Stored(sample().astype(float), np.arange(1320), chance.integers(0, 64, 1320))
    whole = list(stored.best(sample()[:300].astype(float), np.full(300, (1 << 64) - 1, dtype=np.uint64), 7))
    parts = [x for start in range(0, 300, 50) for x in stored.best(sample()[start : start + 50].astype(float), np.full(50, (1 << 64) - 1, dtype=np.uint64), 7)]
    assert [x[2].tolist() for x in whole] == [x[2].tolist() for x in parts]


def test_nearest_ties_and_few_rows(spark):
    found = ann.nearest(table(spark, [[1.0, 0.0]] * 60 + [[0.0, 1.0]])).collect()
    assert [r["vec_id"] for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])) if r["query_id"] == 20] == list(range(20))
    twins = ann.nearest(table(spark, [[1.0, 0.0], [1.0, 0.0], [0.9, 0.1], [0.9, 0.1], [0.5, 0.5]], [20, 20, 7, 7, 8])).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in twins) == [(1, 20), (1, 20), (2, 7), (2, 7), (3, 7), (3, 7), (4, 8), (4, 8)]
    mixed = ann.nearest(table(spark, [[1.0, 0.0], [0.5, 0.5], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]], [20, 21, 40, 41])).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in mixed) == [(20, 21), (40, 41)]
    few = ann.nearest(table(spark, [[1.0, 0.0], [0.5, 0.5]])).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in few] == [(0, 1, 1, 0.5)]
    assert ann.nearest(table(spark, [])).count() == 0 and ann.nearest(table(spark, ODD)).count() == 0
