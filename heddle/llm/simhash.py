"""SimHash near-duplicates, paired exactly by vantage-point trees.

Fingerprints are 64-bit majority votes over hashed word shingles. Equal
fingerprints collapse to one point first, so copies cost nothing further. The
points are dealt to shards by the leaves of a vantage-point tree fitted on a
bounded sample: at each node, distance to the node's vantage point decides the
side. A point whose ball of the link radius crosses a boundary also visits the
other side, so by the triangle inequality every pair within the radius meets in
one shard. Inside a shard a tree over its own points answers all visitors at
once, and a union-find turns links into one edge for each point.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.llm.batches import text_batches
from heddle.plans.components import connected_components
from heddle.plans.durable import Scratch
from heddle.sources import table

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Points that a shard should own at most, and the levels that are split in any case.
#: Visits grow with the levels, so shards are as large as a task can well hold.
SHARD_POINTS = 65_536
LEAST_LEVELS = 4
#: Visitors that a group of a shard holds, about.
VISITORS = 262_144
#: Fingerprints that the sharding tree is fitted on, at most.
FIT_POINTS = 20_000
#: Points of a leaf of the trees inside shards.
LEAF_POINTS = 64


def fingerprint(data: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of UTF-8 text: A-Z lowered, words between ASCII blanks."""
    import xxhash

    words = (data or b"").lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(min(shingle, len(words)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 255):  # so many bits are counted in a byte
        some = hashes[at : at + 255]
        ones += np.add.reduce(np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as (doc_id, fp), fp the signed 64-bit fingerprint of the whole text."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), simhash(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("fp"))


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


class VantageTree:
    """A vantage-point tree over unsigned 64-bit words under Hamming distance.

    ``nodes`` are (vantage point, radius, near child, far child) and ``leaves``
    index arrays; children below zero are leaves. Points at most the radius away
    lie near. A node whose points all have one distance becomes a leaf.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF_POINTS, depth: int = 64, seed: int = 7):
        self.points, self.nodes, self.leaves = points, [], []
        chance = np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(points)), leaf, depth, chance)

    def _grow(self, at: np.ndarray, leaf: int, depth: int, chance) -> int:
        if len(at) > leaf and depth:
            # of a few vantage points, the one whose distances spread most
            best = None
            for pick in chance.choice(at, min(4, len(at)), replace=False):
                d = _distance(self.points[at], self.points[pick])
                if best is None or d.var() > best[0]:
                    best = (d.var(), pick, d)
            _, pick, d = best
            radius = int(np.median(d))
            near = d <= radius
            if near.all():
                radius -= 1
                near = d <= radius
            if near.any() and not near.all():
                node = len(self.nodes)
                self.nodes.append(None)
                low = self._grow(at[near], leaf, depth - 1, chance)
                high = self._grow(at[~near], leaf, depth - 1, chance)
                self.nodes[node] = (self.points[pick], radius, low, high)
                return node
        self.leaves.append(at)
        return -len(self.leaves)

    def visits(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf number, indices of the queries whose ball of ``radius`` may meet it)."""
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if node < 0:
                yield -node - 1, at
                continue
            vantage, bound, low, high = self.nodes[node]
            d = _distance(queries[at], vantage).astype(np.int64)
            stack.append((low, at[d - radius <= bound]))
            stack.append((high, at[d + radius > bound]))


class LinkedSets:
    """Components of links between numbered points, held as one link for each point."""

    def __init__(self, n: int, most: int = 1_000_000):
        self.parent, self.most, self.held, self.a, self.b = np.arange(n), most, 0, [], []

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > self.most:
            self.roots()

    def roots(self) -> np.ndarray:
        if self.a:
            a, b, p = np.concatenate(self.a), np.concatenate(self.b), self.parent
            while True:
                x, y = p[a], p[b]
                apart = x != y
                if not apart.any():
                    break
                a, b = a[apart], b[apart]
                np.minimum.at(p, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
                while (p[p] != p).any():
                    p = p[p]
            self.parent, self.a, self.b, self.held = p, [], [], 0
        return self.parent


def shard_links(points: np.ndarray, home: np.ndarray, radius: int = RADIUS, block: int = 1 << 20, asking: np.ndarray | None = None) -> np.ndarray:
    """For each point the least index it is linked with, directly or by others.

    ``points`` hold a shard's own points (``home``) and visitors. Links join an
    own point with any point, or any of ``asking``, at most ``radius`` bits away.
    """
    own, asking = np.flatnonzero(home), np.arange(len(points)) if asking is None else np.flatnonzero(asking)
    sets = LinkedSets(len(points))
    if len(own):
        tree = VantageTree(points[own])
        for leaf, at in tree.visits(points[asking], radius):
            there, at = own[tree.leaves[leaf]], asking[at]
            step = max(1, block // len(there))
            for k in range(0, len(at), step):
                some = at[k : k + step]
                q, c = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[there][None, :]) <= radius)
                sets.link(some[q], there[c])
    return sets.roots()


def simhash_links(
    classes: DataFrame, scratch: Scratch, radius: int = RADIUS, shard_points: int = SHARD_POINTS, fit_points: int = FIT_POINTS, visitors: int = VISITORS
) -> DataFrame:
    """Edges (src, dst) that connect all points at most ``radius`` bits apart.

    ``classes`` has distinct (fp, node). Not every pair becomes an edge: a shard
    gives each linked point one edge, to its set's representative there. A shard's
    visitors come in blocks, each to a copy of the shard's own points, so a group
    holds about ``shard_points`` and ``visitors``.
    """
    n = classes.count()
    if not n:
        return classes.select(F.col("node").alias("src"), F.col("node").alias("dst"))
    depth = max(LEAST_LEVELS, int(np.ceil(np.log2(n / shard_points))))
    fraction = min(1.0, 1.2 * fit_points / n)
    sample = [r.fp for r in classes.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(1_000_000)) < int(fraction * 1_000_000)).limit(fit_points).collect()]
    sample = np.array(sample or [0], dtype=np.int64).view(np.uint64)
    top = VantageTree(sample, leaf=8, depth=depth)
    blocks = np.ones(len(top.leaves), dtype=np.int64)
    for leaf, at in top.visits(sample, radius):
        blocks[leaf] = max(1, -(-len(at) * n // (len(sample) * visitors)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints, nodes = batch["fp"].to_numpy(), batch["node"].to_numpy()
            points = prints.astype(np.int64).view(np.uint64)
            home = np.empty(len(points), dtype=np.int64)
            for leaf, at in top.visits(points, 0):
                home[at] = leaf
            for leaf, at in top.visits(points, radius):
                at = at[home[at] <= leaf]  # a pair meets in the later of its two homes
                own = home[at] == leaf
                for block in range(blocks[leaf]):
                    # a shard's own points ask in its first block alone
                    here = at[own | (points[at] % np.uint64(blocks[leaf]) == block)]
                    yield pd.DataFrame({"shard": leaf, "block": block, "fp": prints[here], "node": nodes[here], "home": home[here] == leaf})

    def link(shard: pd.DataFrame) -> pd.DataFrame:
        home = shard["home"].to_numpy(bool)
        asking = None if shard["block"].iloc[0] == 0 else ~home
        roots = shard_links(shard["fp"].to_numpy(np.int64).view(np.uint64), home, radius, asking=asking)
        nodes = shard["node"].to_numpy()
        joined = roots != np.arange(len(roots))
        return pd.DataFrame({"src": nodes[joined], "dst": nodes[roots[joined]]})

    dealt = classes.mapInPandas(deal, "shard long, block long, fp long, node long, home boolean")
    return dealt.groupBy("shard", "block").applyInPandas(link, "src long, dst long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Documents are linked when their fingerprints differ in at most ``radius``
    bits; ``component_id`` is the smallest doc_id reachable. Null texts are empty
    and, like texts without words, have fingerprint zero. A row with a null id
    belongs to its fingerprint's component but never names it (null if no row
    there has an id). Repeated rows and ids stay; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.keep(fingerprints(docs, id_col, text_col), "prints")
    classes = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    edges = simhash_links(classes.where("node is not null"), scratch, radius)
    members = connected_components(edges, scratch)
    labelled = classes.join(members, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(labelled, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that a component's least id stands for.

    Rows with a null id have no name to be dropped by and stay, and rows that
    repeat an id are one document: they stay or go together.
    """
    found = near_duplicates(docs.select(id_col, text_col), radius, id_col, text_col)
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs[id_col] == dropped["_dropped"], "left_anti")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at 4 differing bits or fewer."""
    text_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op2_simhash": op2_simhash}
ORACLE_SQL: dict[str, str] = {}
