"""SimHash near-duplicates at a set similarity: pairs with a Jaccard similarity of 0.8 or more of their word shingles.

The same operator as ``simhash``, for a wider radius. A text is its set of
five-word shingles; its fingerprint has 128 bits, as at a similarity of 0.8 two
fingerprints lie about 19 bits apart and those of unrelated texts 64, and with 64
bits the two would overlap. Candidates lie within a radius that holds all but a
few in a hundred thousand pairs of that similarity, and each is confirmed on the
whole sets.

Points are dealt to shards by the triangle bound to one vantage point, the empty
set: its distance to a set is the set's size, and sizes that differ by more than
the similarity allows can't pair. So shards are bands of sizes, bands of many
points are cut into blocks, and each pair of blocks that may hold a pair meets in
one group, where a vantage-point tree over the one answers the other.

A group gives each point's few nearest and most central candidates. Points with
more are crowded: they meet once more among themselves, once the first links are
confirmed, and bring their sets. Pairs in different components that fingerprints of
4096 bits leave open are confirmed there, and a link unites its components at once.
So a group gives at most a row for each component that it joins to another, whether
texts are near copies or just too far apart, and no candidate is lost.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from heddle.llm.batches import give_back
from heddle.llm.simhash import VantageTree
from heddle.plans.components import connected_components
from heddle.plans.durable import Scratch
from heddle.plans.joins import sent_if_small

SHINGLE = 5
#: The least Jaccard similarity of near-duplicates, in percent.
PERCENT = 80
#: Bits that fingerprints of near-duplicates differ in at most, and that their first 64 do.
RADIUS = 38
FIRST_RADIUS = 24
#: 64-bit words of the crowded points' fingerprints, and bits that near-duplicates of
#: SMALL or more shingles differ in at most there: 4.5 deviations above their mean.
WIDE = 64
WIDE_RADIUS = 725
SMALL = 8
#: Ratio of sizes in a band, and points of a block, about: the larger number where a point
#: would go to more than so many groups otherwise. A group holds two blocks.
BAND = 1.1
BLOCK_POINTS = (16_384, 131_072)
MEETINGS = 64
#: Nearest and central candidates of a point that a group gives in the first round.
FEW = 3
#: Points of a leaf of the trees, and points that ask at once.
LEAF_POINTS = 512
QUERY_POINTS = 128
#: Bytes of sets in a block of the second round, about.
BLOCK_BYTES = 32 << 20
#: Shingles compared at once.
COMPARED = 1 << 20
#: Words whose hashes a worker keeps.
KEPT_WORDS = 200_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(SHINGLE)], dtype=np.uint64)


def _stirred(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KEPT_WORDS:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


_WORDS = _WordHashes()


def word_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles: A-Z lowered, words between ASCII blanks; a shorter text is one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - SHINGLE + 1)
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(min(SHINGLE, len(words))):
        mixed += hashes[k : k + n] * _ODD[k]
    return np.unique(_stirred(mixed + np.uint64(min(SHINGLE, len(words)))))


def set_name(grams: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def set_print(grams: np.ndarray, words: int = 2) -> np.ndarray:
    """The SimHash of a set of shingles, as 64-bit words; a bit is 1 if set in over half the hashes."""
    ones = np.zeros(64 * words, dtype=np.int64)
    salts = np.arange(1, words, dtype=np.uint64) * _GOLDEN
    for at in range(0, len(grams), 255):  # so many bits are counted in a byte
        some = grams[at : at + 255, None]
        every = np.concatenate((some, _stirred(some + salts)), axis=1)
        ones += np.add.reduce(np.unpackbits(every.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(grams), bitorder="little").view("<u8")


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared * 100 >= (len(a) + len(b) - shared) * percent


def _candidates(asked: np.ndarray, tree: VantageTree, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of all points of the tree near the queries (first and second words)."""
    parts = []
    # each part is at most a leaf's points times the queries
    for leaf, at in tree.visits(asked[:, 0], FIRST_RADIUS):
        there = tree.leaves[leaf]
        first = np.bitwise_count(asked[at, 0][:, None] ^ tree.points[there][None, :])
        q, c = np.divmod(np.flatnonzero(first <= FIRST_RADIUS), len(there))
        d = first[q, c] + np.bitwise_count(asked[at[q], 1] ^ second[there[c]])
        near = d <= RADIUS
        parts.append((at[q[near]], there[c[near]], d[near]))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, dtype=np.int64),) * 3


def _fitting(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of two points whose sizes allow the similarity."""
    return (a != b) & (100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b]))


def near_points(points: np.ndarray, sizes: np.ndarray, home: np.ndarray, within: bool, percent: int, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates of a group: (a, b) as indices, and whether each point is crowded.

    ``points`` has two words a row; own points (``home``) are asked by visitors,
    or by each other if ``within``. ``few`` bounds the candidates that a query
    gives: its nearest, and as many again of the most central, to which the group's
    candidates lie nearest on the whole, as a family's nearest are chance but its
    centre is not. Points of pairs left out are crowded.
    """
    own, asking = np.flatnonzero(home), np.flatnonzero(home if within else ~home)
    crowded, found, central = np.zeros(len(points), dtype=bool), [], np.zeros(len(points))
    if not len(own) or not len(asking):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), crowded
    tree, second = VantageTree(points[own, 0], leaf=LEAF_POINTS), points[own, 1]

    def pairs(some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, c, d = _candidates(points[some], tree, second)
        a, b = some[q], own[c]
        good = _fitting(a, b, sizes, percent)
        return a[good], b[good], d[good]

    def split(a: np.ndarray, b: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(a, b) of each query's ``few`` of least cost, and of the others; costs are below 65,536."""
        if not len(a):
            return a, b, a, b
        queries, which = np.unique(a, return_inverse=True)
        keys = (which.astype(np.uint64) << np.uint64(48)) | (cost.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        keys.sort()
        which = (keys >> np.uint64(48)).astype(np.int64)
        b, a = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), queries[which]
        taken = np.arange(len(keys)) - np.searchsorted(which, np.arange(len(queries)))[which] < few
        return a[taken], b[taken], a[~taken], b[~taken]

    def blocks(queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The candidates of some queries at once, fewer of them amid many candidates."""
        start, step = 0, QUERY_POINTS // 8
        while start < len(queries):
            found = pairs(queries[start : start + step])
            start += step
            step = QUERY_POINTS if len(found[0]) < 1000 * step else QUERY_POINTS // 8
            yield found

    for a, b, d in blocks(asking):
        central += np.bincount(b, weights=RADIUS + 1.0 - d, minlength=len(points))
        a, b, *left = split(a, b, d)
        for rest in left:
            crowded[rest] = True
        found.append((a, b))
    many = asking[crowded[asking]]
    rank = np.minimum(np.argsort(np.argsort(-central, kind="stable")), 65_535)
    for a, b, _ in blocks(many):
        found.append(split(a, b, rank[b])[:2])
    a, b = (np.concatenate(x) for x in zip(*found))
    return a, b, crowded


def near_sets(
    points: np.ndarray, sizes: np.ndarray, home: np.ndarray, within: bool, percent: int, parts: np.ndarray, wide: np.ndarray, sets: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of a group that join its points' components: all that pairs of the group join, with one link for each joining.

    ``points``, ``home`` and ``within`` as in ``near_points``; ``parts`` are the
    points' components so far, ``wide`` their longer fingerprints, ``sets`` their
    shingles, on which each link is confirmed.
    """
    own, asking = np.flatnonzero(home), np.flatnonzero(home if within else ~home)
    if not len(own) or not len(asking):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    tree, second, links = VantageTree(points[own, 0], leaf=LEAF_POINTS), points[own, 1], []
    _, label = np.unique(parts, return_inverse=True)  # of each point, changed as components are joined

    def confirmed(a: int, others: np.ndarray) -> np.ndarray:
        """Which of some points are similar to ``a``."""
        mine, counts = sets[a], np.array([len(sets[b]) for b in others])
        every = np.concatenate([sets[b] for b in others])
        at = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
        ends = np.cumsum(counts)
        shared = np.diff(np.concatenate(([0], np.cumsum(mine[at] == every)[ends - 1])))
        return 100 * shared >= percent * (len(mine) + counts - shared)

    step = QUERY_POINTS // 8
    for start in range(0, len(asking), step):
        some = asking[start : start + step]
        q, c, _ = _candidates(points[some], tree, second)
        a, b = some[q], own[c]
        good = _fitting(a, b, sizes, percent) & (label[a] != label[b])
        a, b = a[good], b[good]
        open_ = np.minimum(sizes[a], sizes[b]) < SMALL
        for k in range(0, len(a), 50_000):
            far = np.bitwise_count(wide[a[k : k + 50_000]] ^ wide[b[k : k + 50_000]]).sum(axis=1, dtype=np.int64)
            open_[k : k + 50_000] |= far <= WIDE_RADIUS
        a, b = a[open_], b[open_]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        begins = np.flatnonzero(np.diff(a, prepend=-1))
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(a)]):
            one = int(a[begin])
            left, many = b[begin:end], max(1, COMPARED // max(1, len(sets[one])))
            while len(left):
                left = left[label[left] != label[one]]  # those joined meanwhile need no link
                now, left = left[:many], left[many:]
                if not len(now):
                    break
                for other in now[confirmed(one, now)].tolist():
                    if label[other] != label[one]:
                        links.append((one, other))
                        label[label == label[other]] = label[one]
    a, b = np.array(links, dtype=np.int64).reshape(-1, 2).T
    return a, b


def block_points(bands: list[tuple[int, int, int, int]]) -> int:
    """Points of a block for these bands; sizes within a quarter hold about a tenth of all."""
    least, most = BLOCK_POINTS
    return max(least, min(most, sum(n for _, n, *_ in bands) // (10 * MEETINGS)))


def _band(n: Column) -> Column:
    return F.floor(F.log(n) / float(np.log(BAND))).cast("int")


def _meetings(points: DataFrame, bands: list[tuple[int, int, int, int]], percent: int, few: int | None) -> DataFrame:
    """(a, b, crowded): set ids of candidates, and (a, null) for a crowded point.

    Without ``few`` the points have components, longer fingerprints and sets, and
    the pairs are confirmed links. ``bands`` is a row for each band of sizes, so it
    grows with the logarithm of the longest text. A point visits the blocks that its
    own may pair with, from its own upward.
    """
    size = block_points(bands)
    # with their sets, points come in blocks of bounded bytes
    counts = {band: max(1, -(-n // size if few is not None else -(-8 * n * high // BLOCK_BYTES))) for band, n, _, high in bands}
    firsts = dict(zip(counts, np.cumsum([0, *counts.values()]).tolist()))
    near = {band: [b for b, _, low, _ in bands if b >= band and 100 * high >= percent * low] for band, _, _, high in bands}
    numbers = lambda some: np.concatenate([np.arange(firsts[b], firsts[b] + counts[b]) for b in some])
    ahead = {band: numbers(some) for band, some in near.items()}
    back = {band: numbers([b for b in near if b <= band and band in near[b]]) for band in near}
    labelled = few is None

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            of, names, parts = batch["band"].to_numpy(), batch["set_id"].to_numpy(), []
            for band in np.unique(of):
                at = np.flatnonzero(of == band)
                mine = firsts[band] + names[at] % counts[band]
                # a visitor of the blocks behind its own, an owner of its own for all blocks up to it
                r, c = np.nonzero(mine[:, None] < ahead[band])
                parts.append((at[r], mine[r], ahead[band][c], np.zeros(len(r), dtype=bool)))
                r, c = np.nonzero(mine[:, None] >= back[band])
                parts.append((at[r], back[band][c], mine[r], np.ones(len(r), dtype=bool)))
            if parts:
                rows, low, high, home = (np.concatenate(x) for x in zip(*parts))
                yield batch.iloc[rows].assign(low=low, high=high, home=home)
        give_back()

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        words = group[["f0", "f1"]].to_numpy(np.int64).view(np.uint64)
        names, sizes, home = group["set_id"].to_numpy(), group["n"].to_numpy(np.int64), group["home"].to_numpy(bool)
        within = bool((group["low"] == group["high"]).all())
        if labelled:
            wide = np.frombuffer(b"".join(group["wide"]), np.uint64).reshape(-1, WIDE)
            a, b = near_sets(words, sizes, home, within, percent, group["component"].to_numpy(), wide, [np.frombuffer(g, np.uint64) for g in group["grams"]])
            alone = names[:0]
        else:
            a, b, crowded = near_points(words, sizes, home, within, percent, few)
            alone = names[crowded]
        low, high = np.minimum(names[a], names[b]), np.maximum(names[a], names[b])
        give_back()
        return pd.DataFrame({"a": np.r_[low, alone], "b": pd.array(np.r_[high, alone], dtype="Int64").copy(), "crowded": np.r_[np.zeros(len(a), dtype=bool), np.ones(len(alone), dtype=bool)]})

    fields = "set_id long, n int, f0 long, f1 long, band int" + (", component long, wide binary, grams binary" if labelled else "")
    dealt = points.select(*(f.split()[0] for f in fields.split(", "))).mapInPandas(deal, f"{fields}, low long, high long, home boolean")
    return dealt.groupBy("low", "high").applyInPandas(meet, "a long, b long, crowded boolean").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(node, component) of the ids that have a near-duplicate, component the least id reachable.

    Documents are linked when their sets of five-word shingles have a Jaccard
    similarity of ``percent`` / 100 or more. The radius is that of 80 or more.
    Null texts are empty and, like all texts without words, equal. Rows that
    repeat an id are one document. Rows without an id are left out.
    """
    if percent < PERCENT:
        raise ValueError(f"the fingerprints' radius holds similarities of {PERCENT} percent or more")
    scratch = scratch or Scratch(docs.sparkSession, "simhash_sets")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("doc_id is not null")

    @F.pandas_udf("set_id long, n int, f0 long, f1 long")
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = np.zeros((len(texts), 4), dtype=np.int64)
            for row, text in zip(rows, texts):
                made = word_set(text)
                row[:2] = set_name(made), len(made)
                row[2:] = set_print(made).view(np.int64)
            yield pd.DataFrame(rows, columns=["set_id", "n", "f0", "f1"])
        _WORDS.clear()
        give_back()

    hashed = F.xxhash64("text").alias("text_hash")
    prints = scratch.keep(docs.select("doc_id", hashed, printed("text").alias("p")).select("doc_id", "text_hash", "p.*"), "prints")
    owners = prints.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash", "n", "f0", "f1")).alias("own"))
    owners = scratch.keep(owners.select("set_id", "own.*", _band(F.greatest(F.col("own.n"), F.lit(1))).alias("band")), "owners")
    points = owners.where("n > 0")
    bands = [tuple(r) for r in points.groupBy("band").agg(F.count("*"), F.min("n"), F.max("n")).orderBy("band").collect()]

    @F.pandas_udf("binary")
    def grams(texts: pd.Series) -> pd.Series:
        return pd.Series([word_set(t).tobytes() for t in texts])

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(a, b)], dtype=bool)

    @F.pandas_udf("binary")
    def widely(sets: pd.Series) -> pd.Series:
        return sets.map(lambda s: set_print(np.frombuffer(s, np.uint64), WIDE).tobytes())

    met = scratch.keep(_meetings(points, bands, percent, FEW), "met")
    wanted = owners.join(met.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), "set_id", "left_semi").select("set_id", "doc_id", "text_hash")
    wanted = scratch.keep(wanted, "wanted")
    known = wanted.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "set_id")
    texts = docs.join(sent_if_small(known), (docs["doc_id"] == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")))
    sets = scratch.keep(texts.select("set_id", grams("text").alias("grams")).dropDuplicates(["set_id"]), "sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("grams").alias("grams_a")), "a")
        both = both.join(sets.select(F.col("set_id").alias("b"), F.col("grams").alias("grams_b")), "b")
        return scratch.keep(both.where(alike("grams_a", "grams_b")).select(F.col("a").alias("src"), F.col("b").alias("dst")), name)

    links = confirmed(met.where("not crowded").select("a", "b"), "links")
    crowd = points.join(met.where("crowded").select(F.col("a").alias("set_id")).distinct(), "set_id", "left_semi")
    parts = connected_components(links, scratch)
    crowd = crowd.join(parts.select(F.col("node").alias("set_id"), "component"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    crowd = scratch.keep(crowd.join(sets.select("set_id", "grams", widely("grams").alias("wide")), "set_id"), "crowd")
    crowds = [tuple(r) for r in crowd.groupBy("band").agg(F.count("*"), F.min("n"), F.max("n")).orderBy("band").collect()]
    more = scratch.keep(_meetings(crowd, crowds, percent, None).select(F.col("a").alias("src"), F.col("b").alias("dst")), "more")
    # rows that repeat an id tie their texts together
    twice = prints.groupBy("doc_id").agg(F.min("set_id").alias("src"), F.max("set_id").alias("last")).where("src <> last").select("doc_id", "src")
    tied = prints.join(twice, "doc_id").where("set_id <> src").select("src", F.col("set_id").alias("dst"))
    members = connected_components(links.unionByName(more).unionByName(tied), scratch)
    named = owners.select("set_id", "doc_id").join(members.select(F.col("node").alias("set_id"), "component"), "set_id", "left")
    named = named.withColumn("component", F.coalesce("component", "set_id"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    named = named.join(least, "component").select("set_id", "least")
    found = prints.select("doc_id", "set_id").join(named, "set_id").groupBy("doc_id").agg(F.min("least").alias("least"))
    return found.where("doc_id <> least").select(F.col("doc_id").alias("node"), F.col("least").alias("component"))


def keep_one(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that a component's least id stands for; rows with a null id stay."""
    scratch = Scratch(docs.sparkSession, "simhash_sets")
    found = near_duplicates(docs.select(id_col, text_col), percent, id_col, text_col, scratch)
    dropped = Scratch(docs.sparkSession, "dropped").keep(found.select(F.col("node").alias("_dropped")), "ids")
    scratch.clear()
    return docs.join(sent_if_small(dropped), docs[id_col] == dropped["_dropped"], "left_anti")
