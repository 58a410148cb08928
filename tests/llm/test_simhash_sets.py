import itertools
import random

import numpy as np

import corpus_pipeline
from heddle.llm import simhash_sets


def slow_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def brute_kept(rows):
    root = {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for (i, s), (j, t) in itertools.combinations([(i, slow_set(t)) for i, t in rows], 2):
        if 5 * len(s & t) >= 4 * len(s | t):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return sorted(i for i in root if find(i) == i)


def test_stage_keeps_one_of_texts_from_a_similarity_of_0_8(spark):
    chance = random.Random(4)
    phrase, texts = [f"common{i}" for i in range(30)], ["", " \n", "A b c", "a B c", "a b", "one two three four five"]
    for n in (12, 40, 60, 100, 200, 400) * 4:
        base = [f"w{chance.randrange(10**6)}" for _ in range(n)] + phrase * chance.randrange(2)
        for changes in (0, 0, 1, 1, 2, 3, 4, 6, 9):
            words = list(base)
            for at in chance.sample(range(len(words)), min(changes, len(words))):
                words[at] = f"new{chance.randrange(10**6)}"
            texts.append(" ".join(words))
    # a large group of near copies
    base = [f"g{i}" for i in range(150)]
    texts += [" ".join(base[:k] + [f"x{k}"] + base[k:]) for k in range(120)]
    rows = list(enumerate(texts))
    chance.shuffle(rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept(sorted(rows))


def test_blocks_and_crowds_lose_no_pair(spark, monkeypatch):
    """Bands cut into small blocks, and few candidates given at first."""
    monkeypatch.setattr(simhash_sets, "BLOCK_POINTS", (7, 9))
    monkeypatch.setattr(simhash_sets, "FEW", 1)
    chance = random.Random(9)
    texts = []
    for family in range(6):
        base = [f"f{family}x{i}" for i in range(90)]
        for _ in range(25):
            words = list(base)
            for at in chance.sample(range(90), chance.randrange(5)):
                words[at] = f"n{chance.randrange(10**6)}"
            texts.append(" ".join(words[: chance.choice([90, 90, 84])]))
    rows = list(enumerate(texts))
    kept = simhash_sets.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept(rows)


def test_odd_rows(spark):
    words = [f"word{i}" for i in range(60)]
    rows = [(5, " ".join(words)), (3, " ".join(words).upper()), (2, ""), (7, None), (7, None), (None, " ".join(words)), (None, "x"), (5, "other text of the same document"), (8, "other text of the same document")]
    kept = simhash_sets.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "None", "None"]
    assert simhash_sets.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def family(chance, n, shared, own):
    """Sets of shingles, as hashes, that have ``shared`` in common and ``own`` by themselves."""
    common = chance.integers(0, 1 << 63, shared, dtype=np.uint64)
    return [np.unique(np.r_[common, chance.integers(0, 1 << 63, own, dtype=np.uint64)]) for _ in range(n)]


def met(sets, parts):
    prints = np.array([simhash_sets.set_print(s) for s in sets])
    wide = np.array([simhash_sets.set_print(s, simhash_sets.WIDE) for s in sets])
    sizes, home = np.array([len(s) for s in sets]), np.ones(len(sets), dtype=bool)
    return simhash_sets.near_sets(prints, sizes, home, True, 80, np.asarray(parts), wide, sets)


def test_texts_of_one_template_just_too_far_apart_give_no_rows():
    """At a similarity of 0.77 all pairs are candidates, and none leaves the group."""
    chance = np.random.default_rng(5)
    for n in (200, 600):
        a, b = met(family(chance, n, 174, 26), np.arange(n))
        assert len(a) == len(b) == 0


def test_a_group_gives_a_row_for_each_joining():
    """Families at 0.85, and their components so far: joined by as few links as connect them, the rest by none."""
    chance = np.random.default_rng(6)
    sets = family(chance, 150, 184, 16) + family(chance, 100, 174, 26) + family(chance, 50, 190, 10)
    a, b = met(sets, np.r_[np.arange(150) // 50, np.arange(1000, 1100), np.full(50, 7)])
    assert len(a) == 2 and max(a.max(), b.max()) < 150
    assert all(simhash_sets.similar(sets[i], sets[j]) for i, j in zip(a, b))


def test_rows_of_a_template_follow_the_texts(spark, monkeypatch):
    """All rows that the stage writes for texts of one template at 0.75 to 0.79, counted at two sizes."""
    written = {}
    keep = simhash_sets.Scratch.keep

    def counted(self, df, name="t"):
        kept = keep(self, df, name)
        written[name] = kept.count()
        return kept

    monkeypatch.setattr(simhash_sets.Scratch, "keep", counted)
    chance, totals = random.Random(7), []
    for n in (150, 600):
        base = [f"word{i}" for i in range(200)]
        texts = []
        for _ in range(n):
            words = list(base)
            for at in chance.sample(range(0, 200, 7), 5):
                words[at] = f"new{chance.randrange(10**9)}"
            texts.append(" ".join(words))
        written.clear()
        kept = simhash_sets.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept(list(enumerate(texts))) if n < 200 else kept.count() <= n
        assert written["more"] <= n
        totals.append(sum(written.values()))
    assert totals[1] < 5 * totals[0]
