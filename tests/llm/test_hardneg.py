import numpy as np
import pytest
from pyspark.sql import functions as F

from heddle.llm import hardneg as h


def table(spark, vectors, labels, ids=None):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], label, "x") for i, v, label in zip(ids if ids is not None else range(len(vectors)), vectors, labels)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rank string")


def mined(df, **sizes):
    found = h.hard_negatives(df, F.col("label"), F.col("vec_id") % 5 == 0, **sizes)
    return sorted(tuple(r) for r in found.collect())


def by_hand(vectors, labels, ids):
    x = np.floor(256 * np.asarray(vectors, dtype=np.float64)).astype(np.int64).astype(object)
    score = x @ x.T
    out = []
    for a in range(len(ids)):
        if ids[a] % 5:
            continue
        order = sorted((i for i in range(len(ids)) if i != a), key=lambda i: (-score[a, i], ids[i]))
        positives = [i for i in order if labels[i] == labels[a]][:5]
        for p in positives:
            negatives = [i for i in order if labels[i] != labels[a] and 50 * score[a, p] <= 100 * score[a, i] <= 95 * score[a, p]][:3]
            out += [(ids[a], ids[p], k + 1, ids[i], int(score[a, p]), int(score[a, i])) for k, i in enumerate(negatives)]
    return sorted(out)


def sample(n, dim, seed, centres=6):
    """Clusters, some rows met often, and components in few steps, so that many scores tie."""
    chance = np.random.default_rng(seed)
    base = chance.standard_normal((centres, dim))
    vectors = base[chance.integers(0, centres, n)] + 0.3 * chance.standard_normal((n, dim))
    vectors = np.round(vectors * 4) / 4
    vectors[n // 3 : n // 2] = vectors[0]
    vectors[-3:] = 0
    return vectors, chance.integers(0, 4, n).tolist()


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "block_rows": 25}])
def test_against_all_pairs(spark, monkeypatch, sizes):
    monkeypatch.setattr(h, "LEAF_ROWS", 16)
    monkeypatch.setattr(h, "LEAF_ANCHORS", 4)
    vectors, labels = sample(400, 8, 1)
    ids = np.random.default_rng(2).permutation(1000)[:400].tolist()
    odd = [None, [None] + [1.0] * 7, [float("nan")] * 8, [float("inf")] * 8, [], [1e200] * 8]
    df = table(spark, [*vectors.tolist(), *odd, vectors[1].tolist(), vectors[1].tolist()], [*labels, *([1] * len(odd)), None, 2], [*ids, *range(2000, 2000 + 5 * len(odd), 5), 3000, None])
    assert mined(df, **sizes) == by_hand(vectors, labels, ids)


def test_far_clusters_one_label_and_lengths(spark):
    vectors, labels = sample(120, 8, 3)
    one = mined(table(spark, vectors.tolist(), [1] * 120))
    assert one == []
    few, few_labels = sample(60, 3, 4)
    ids = [*range(120), *range(200, 260)]
    df = table(spark, [*vectors.tolist(), *few.tolist()], [*labels, *few_labels], ids)
    assert mined(df) == sorted(by_hand(vectors, labels, ids[:120]) + by_hand(few, few_labels, ids[120:]))


def test_repeated_rows_are_rows_of_their_own(spark):
    vectors, labels = sample(60, 4, 5)
    ids = list(range(60))
    again = [0, 0, 10, 7]  # anchors twice more and once more, and another row
    every = [*vectors.tolist(), *(vectors[i].tolist() for i in again)]
    assert mined(table(spark, every, labels + [labels[i] for i in again], ids + again)) == by_hand(every, labels + [labels[i] for i in again], ids + again)


def test_scores_beyond_what_doubles_hold(spark):
    chance = np.random.default_rng(6)
    vectors, labels = chance.integers(-(10**6), 10**6, (80, 3)) * 5 + 1.0, chance.integers(0, 3, 80).tolist()
    assert mined(table(spark, vectors.tolist(), labels)) == by_hand(vectors, labels, list(range(80)))


def test_empty_tables(spark):
    for df in (table(spark, [], []), table(spark, [[1.0], [2.0]], [1, 2], [1, 2]), table(spark, [None], [1], [5])):
        found = h.hard_negatives(df, F.col("label"), F.col("vec_id") % 5 == 0)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and found.count() == 0


def test_balls_hold_their_rows_and_bound_products():
    chance = np.random.default_rng(7)
    rows, others = chance.standard_normal((500, 6)) * 100, chance.standard_normal((300, 6)) + 50
    a, b = h.Balls(rows, 16), h.Balls(others, 16)
    assert sorted(np.concatenate(a.leaf_rows).tolist()) == list(range(500)) and max(map(len, a.leaf_rows)) <= 16
    for i in range(0, len(a.radii), 7):
        for j in range(0, len(b.radii), 7):
            if a.leaf_of[i] >= 0 and b.leaf_of[j] >= 0:
                x, y = rows[a.leaf_rows[a.leaf_of[i]]], others[b.leaf_rows[b.leaf_of[j]]]
                low, high = h.interval(a.centres[i] @ b.centres[j], a.norms[i], a.radii[i], b.norms[j], b.radii[j])
                assert low <= (x @ y.T).min() and (x @ y.T).max() <= high


def test_node_pairs_prune_whole_groups(monkeypatch):
    """In clustered vectors few of all products are computed."""
    monkeypatch.setattr(h, "LEAF_ROWS", 64)
    monkeypatch.setattr(h, "LEAF_ANCHORS", 8)
    chance = np.random.default_rng(8)
    centres = chance.standard_normal((40, 16)) * 300
    rows = np.floor(centres[chance.integers(0, 40, 8000)] + 20 * chance.standard_normal((8000, 16))).astype(np.int64)
    labels, ids = chance.integers(0, 10, 8000), np.arange(8000)
    block = h.Block(ids, labels, rows, True)
    asks = np.arange(0, 8000, 20)
    wishes = h.Wishes(np.full((len(asks), 1), h.NONE_LOW), np.full((len(asks), 1), h.NONE_HIGH), 5)
    assert block.answer(ids[asks], labels[asks], rows[asks], wishes, True) < 0.2 * len(asks) * 8000
    score = rows[asks] @ rows.T
    score[labels[asks][:, None] != labels[None, :]] = h.NONE_LOW
    score[np.arange(len(asks)), asks] = h.NONE_LOW
    assert (np.sort(score, axis=1)[:, :-6:-1] == wishes.scores[:, 0]).all()


def test_candidates_are_sent_once_and_stay_sorted(spark):
    """One exchange and one sort hold a block's candidates ahead of all its anchors."""
    vectors, labels = sample(200, 4, 9)
    rows = table(spark, vectors.tolist(), labels).select("vec_id", F.col("label").cast("long").alias("label"), h._whole(F.col("embedding"), 256).alias("v"))
    scratch = h.Scratch(spark, "test")
    anchors = scratch.keep(rows.where("vec_id % 5 = 0").withColumn("node", F.col("vec_id")), "anchors").select("node", "vec_id", "label", "v")
    search = h.Search(rows, anchors, scratch, 40, 25)
    asks = anchors.withColumn("lows", F.array(F.lit(0).cast("long"))).withColumn("highs", F.array(F.lit(9).cast("long"))).withColumn("home", F.lit(0).cast("long"))
    plan = search._meet(asks, True, 5, None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "asks" in plan[plan.index("Sort [") :].split("\n")[0]
