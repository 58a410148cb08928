import itertools

import numpy as np
import pytest
import xxhash

from heddle.llm import simhash
from heddle.plans.durable import Scratch


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in words).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """id → least id reachable, for {id: fingerprint}."""
    root = {k: k for k in prints}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in prints}


def test_fingerprints():
    texts = ["", None, " \t\n", "One", "one TWO three", "A b\x0bc\x1cd e", "É È ÉÈ x", "w " * 9000, "the quick brown fox jumps over the lazy dog " * 3]
    for t in texts:
        assert simhash.fingerprint((t or "").encode()) % (1 << 64) == slow_fingerprint(t)


@pytest.mark.parametrize("spread", [64, 12])
def test_tree_links_against_brute_force(spread):
    chance = np.random.default_rng(spread)
    base = chance.integers(0, 1 << 63, 40, dtype=np.uint64)
    points = [int(b) for b in base]
    for _ in range(1200):
        p = points[chance.integers(len(points))]
        for bit in chance.choice(64, chance.integers(0, 7), replace=False):
            p ^= 1 << int(bit) % spread
        points.append(p)
    points = np.array(sorted(set(points)), dtype=np.uint64)
    truth = brute_components(dict(enumerate(map(int, points))))
    roots = simhash.shard_links(points, np.ones(len(points), dtype=bool))
    assert roots.tolist() == [truth[i] for i in range(len(points))]


@pytest.mark.parametrize("visitors", [1 << 20, 60])
def test_shards_lose_no_pair(spark, visitors):
    chance = np.random.default_rng(2)
    points = chance.integers(-(1 << 62), 1 << 62, 700)
    points = sorted({*points.tolist(), *(int(p) ^ 5 for p in points[:200]), *(int(p) ^ (1 << 40) for p in points[100:150]), *(int(points[0]) ^ k for k in range(300))})
    df = spark.createDataFrame([(p, i) for i, p in enumerate(points)], "fp long, node long")
    scratch = Scratch(spark, "test")
    edges = simhash.simhash_links(df, scratch, shard_points=50, fit_points=200, visitors=visitors)
    from heddle.plans.components import connected_components

    found = {r["node"]: r["component"] for r in connected_components(edges, scratch).collect()}
    truth = brute_components({i: p % (1 << 64) for i, p in enumerate(points)})
    assert {i: found.get(i, i) for i in truth} == truth


def test_near_duplicates_with_odd_rows(spark):
    words = [f"word{i}" for i in range(300)]
    rows = [(5, " ".join(words)), (3, " ".join(words).upper()), (9, " ".join(words[:-1])), (2, ""), (7, None), (7, None), (8, "other text altogether here now"), (None, " ".join(words)), (None, "alone and without any id at all"), (4, "x" * 200_000)]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, fp int, component_id string")
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    prints = {i: slow_fingerprint(t) for i, t in rows if i is not None}
    truth = brute_components(prints)
    for r in found:
        if r["doc_id"] is not None:
            assert (int(r["fingerprint"], 16), r["component_id"]) == (prints[r["doc_id"]], truth[r["doc_id"]])
    assert sorted(str(r["component_id"]) for r in found if r["doc_id"] is None) == ["3", "None"]
    kept = [r["doc_id"] for r in simhash.keep_one(df).collect()]
    assert sorted(map(str, kept)) == sorted(["2", "3", "4", "8", "None", "None"])


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
